"""Pipeline from raw documents to packed training sequences; each stage is one operator of ``lapwise.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapwise.llm.decontaminate import decontaminated, find_leaks
from lapwise.llm.jobs import without_ids, written
from lapwise.llm.ngram_jaccard import ngram_jaccard
from lapwise.llm.packing import Capacity, pack
from lapwise.llm.quality import fit_quality, score_quality
from lapwise.llm.queries import table, tokenizer_path, training_labels
from lapwise.llm.toxicity import fit_toxicity, score_toxicity

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
TOXIC_FROM = 0.3
GOOD_FROM = 0.7

#: No SQL for trained classifiers; the tests compare run() with the stages applied one by one by brute force.
ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents whose restored text scores as toxic; none without labelled documents of both kinds."""
    model = fit_toxicity(docs, training_labels(spark, sf_dir))
    if not model.fitted:
        return docs.select(*COLUMNS)
    scored = score_toxicity(docs, model, keep=COLUMNS[1:], spans=False)
    return scored.where(F.col("score") < TOXIC_FROM).select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that score as of low quality; none without labelled documents of both kinds."""
    model = fit_quality(docs, training_labels(spark, sf_dir))
    if model is None or not model.fitted:
        return docs.select(*COLUMNS)
    scored = score_quality(docs, model, keep=COLUMNS[1:])
    return scored.where(F.col("score") >= GOOD_FROM).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near duplicates (5 words, similarity 0.8)."""
    found = ngram_jaccard(docs, width=5, percent=80)
    copies = found.where("component_id <> doc_id").select("doc_id")
    return without_ids(docs, copies, "doc_id").select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that hold a passage of the benchmark."""
    return decontaminated(docs, find_leaks(docs, table(spark, sf_dir, "benchmark"))).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where the pieces of each document stand in sequences of 2048 tokens."""
    return pack(docs, tokenizer_path(), Capacity(tokens=2048))


STAGES = (
    ("toxicity", toxicity),
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", packing),
)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each hands on is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage-{k + 1}")
    return docs
