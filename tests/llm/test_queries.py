"""Registered queries against their SQL, and the pipeline against its stages applied one by one."""

import re

import compare
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lapwise.llm.queries import ORACLES, QUERIES
from test_ngram_jaccard import brute


@pytest.fixture(scope="module")
def connection(sf_dir):
    return compare.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, sf_dir, connection, name):
    columns, rows = compare.spark_rows(QUERIES[name](spark, sf_dir))
    expected_columns, expected_rows = compare.sql_rows(connection, ORACLES[name])
    assert columns == expected_columns
    assert rows == expected_rows


def test_thirteen_operators():
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES) == list(range(1, 14))


def test_stages(spark, sf_dir, sf_documents):
    """Near duplicates and leaks by brute force, scores by the queries, packing by what it was given."""
    docs = sf_documents
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        out = stage(spark, docs, sf_dir)
        rows = out.collect()
        if name == "best-fit packing":
            assert {r.doc_id for r in rows} == set(before)
            break
        assert out.columns == docs.columns
        after = {r.doc_id: r for r in rows}
        assert len(after) == len(rows) and all(before[i] == r for i, r in after.items())
        if name == "n-gram Jaccard join":
            expected = {i for i, _, root in brute([(r.doc_id, r.text) for r in before.values()], 5, 80) if i == root}
            assert set(after) == expected
        elif name == "benchmark decontamination":
            bench = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
            holds = {i for i, r in before.items() if any(words(b) in words(r.text) for b in bench)}
            assert holds.isdisjoint(after) and len(after) >= len(before) - len(holds) - 0.01 * len(before)
        else:
            labels = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
            label, keep = ("toxic", 0) if name == "toxicity" else ("quality", 1)
            right = [(r.doc_id in after) == (r[label] == keep) for r in labels if r.doc_id in before]
            assert sum(right) >= 0.85 * len(right)
        docs = spark.createDataFrame(rows, docs.schema)


def words(text):
    return " " + " ".join(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower())) + " "


def test_run_applies_the_stages(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.columns[:3] == ["doc_id", "piece", "start"]
    total = out.agg(F.sum("length"), F.countDistinct("sequence_id")).first()
    assert total[1] <= 1.02 * total[0] / 2048 + 1


@pytest.mark.parametrize(("toxic", "quality"), [(None, None), (1, 0), (0, 1)])
def test_stages_without_both_labels_keep_all(spark, tmp_path, toxic, quality):
    docs = spark.createDataFrame([(i, f"a plain text number {i}", "en", "s", 20) for i in range(12)], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, toxic, quality) for i in range(12 if toxic is not None else 0)], "doc_id long, toxic int, quality int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for stage in (corpus_pipeline.toxicity, corpus_pipeline.quality):
        assert sorted(stage(spark, docs, str(tmp_path)).collect()) == sorted(docs.collect())


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None), (1, None, "en", None, 3), (None, "a b", None, "s", 1), (2, "x " * 20_000, "en", "s", 1)]])
def test_stages_take_odd_tables(spark, sf_dir, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        assert name == "best-fit packing" or out.columns == docs.columns
        assert out.count() >= 0
