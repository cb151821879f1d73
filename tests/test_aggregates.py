"""Medians, counts and quality gates."""

import random
import statistics
import struct

import pytest
from pyspark.sql import functions as F

from lapwise.operators import aggregates, quality
from lapwise.operators.aggregates import grouped_median, grouped_summary
from lapwise.operators.quality import QualityError


@pytest.mark.parametrize("max_rows, broadcast", [(None, 10), (10**6, 10), (50, 10), (50, 0)])
def test_median_against_python(spark, monkeypatch, max_rows, broadcast):
    monkeypatch.setattr(aggregates, "MAX_BROADCAST_GROUPS", broadcast)
    generator = random.Random(11)
    groups = {"odd": 2001, "even": 4000, "tiny": 3, "one": 1, None: 1500}
    rows = [(k, generator.gauss(80, 5)) for k, n in groups.items() for _ in range(n)]
    rows += [("copies", 7.25)] * 3000 + [("copies", 9.0)] * 10 + [("odd", None)] * 5 + [("empty", None)] * 3
    df = spark.createDataFrame(rows, "k string, v double").repartition(8)
    summary = aggregates.grouped_summary(df, ["k"], {"rows": F.count("*")}, {"median": "v"}, max_rows)
    assert summary.columns == ["k", "rows", "median"]
    got = {r["k"]: (r["rows"], r["median"]) for r in summary.collect()}
    for key in {k for k, _ in rows}:
        values = [v for k, v in rows if k == key and v is not None]
        total = sum(1 for k, _ in rows if k == key)
        expected = statistics.median(values) if values else None
        assert got[key] == (total, pytest.approx(expected, rel=1e-12) if values else None)


def test_large_group_shuffles_little(spark):
    df = spark.range(200_000).select(F.lit("k").alias("k"), F.rand(3).alias("v"))
    exact = df.agg(F.median("v")).first()[0]
    assert aggregates.grouped_median(df, ["k"], "v", "m", max_rows=1000).first()["m"] == pytest.approx(exact, rel=1e-12)


def test_median_of_a_wide_bracket_is_narrowed(spark, monkeypatch):
    monkeypatch.setattr(aggregates, "BRACKET", (0.2, 0.9))
    generator = random.Random(13)
    groups = {"odd": 9001, "even": 20_000, "steps": 5000}
    rows = [(k, float(generator.randint(0, 9)) if k == "steps" else generator.expovariate(1)) for k, n in groups.items() for _ in range(n)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(8)
    got = {r["k"]: r["m"] for r in aggregates.grouped_median(df, ["k"], "v", "m", max_rows=1000).collect()}
    for key in groups:
        assert got[key] == pytest.approx(statistics.median(v for k, v in rows if k == key), rel=1e-12)


@pytest.mark.parametrize("max_rows", [10**6, 20])
def test_median_of_infinite_values(spark, max_rows):
    infinity = float("inf")
    rows = [("a", infinity)] * 30 + [("a", 1.0)] * 10 + [("b", -infinity)] * 3 + [("c", 2.0), ("c", infinity)]
    df = spark.createDataFrame(rows, "k string, v double")
    summary = aggregates.grouped_summary(df, ["k"], {}, {"m": "v"}, max_rows)
    assert {r["k"]: r["m"] for r in summary.collect()} == {"a": infinity, "b": -infinity, "c": infinity}


def test_both_medians_agree_bit_for_bit(spark):
    rng = random.Random(9)
    rows = [(k, rng.choice([rng.uniform(-1e9, 1e9), rng.random(), float(rng.randrange(9))])) for k in range(300) for _ in range(rng.randrange(1, 40))]
    df = spark.createDataFrame(rows, "k int, v double")
    small = {r.k: struct.pack("d", r.m) for r in grouped_summary(df, ["k"], {}, {"m": "v"}, max_rows=None).collect()}
    large = {r.k: struct.pack("d", r.m) for r in grouped_median(df, ["k"], "v", "m", max_rows=1).collect()}
    assert small == large


@pytest.mark.parametrize("max_rows", [None, 0])
def test_medians_of_other_types_are_refused_either_way(spark, max_rows):
    df = spark.sql("SELECT 1 AS k, INTERVAL '1' DAY AS v")
    with pytest.raises(TypeError, match="numbers"):
        grouped_summary(df, ["k"], {}, {"m": "v"}, max_rows=max_rows)


def test_distinct_keys_skip_unknown_parts(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, None), (2, 1)], "a int, b int")
    assert df.agg(aggregates.distinct_keys("a", "b")).first()[0] == 2


def test_surplus_counts_nulls_as_equal(spark):
    df = spark.createDataFrame([(None,), (None,), (1,), (1,), (1,), (2,)], "a int")
    assert aggregates.surplus_rows(df, ["a"]).first()[0] == 3
    assert aggregates.surplus_rows(df.where("false"), ["a"]).first()[0] == 0


def test_filtered_counts_split_unknown(spark):
    df = spark.createDataFrame([(True,), (False,), (False,), (None,)], "f boolean")
    row = aggregates.filtered_counts(df, aggregates.truth_counts("f", "f"), total="rows").first()
    assert row.asDict() == {"rows": 4, "f_true": 1, "f_false": 2, "f_unknown": 1}


def laps(spark, rows):
    return spark.createDataFrame(rows, "session int, lap int")


def test_key_gate_passes_clean_data(spark):
    report = quality.require_key(laps(spark, [(1, 1), (1, 2)]), ["session", "lap"], "laps", {"below_1": F.col("lap") < 1})
    assert report == {"rows": 2, "duplicate_rows": 0, "null_session": 0, "null_lap": 0, "below_1": 0}


@pytest.mark.parametrize(
    "rows, message",
    [
        ([(1, 1), (1, 1), (1, 1)], "duplicate_rows = 2"),
        ([(1, None), (1, 2)], "null_lap = 1"),
        ([(None, None), (None, None)], "duplicate_rows = 1, null_session = 2, null_lap = 2"),
        ([(1, 0), (1, 1)], "below_1 = 1"),
    ],
)
def test_key_gate_raises(spark, rows, message):
    with pytest.raises(QualityError, match=f"laps: {message}"):
        quality.require_key(laps(spark, rows), ["session", "lap"], "laps", {"below_1": F.col("lap") < 1})


def test_empty_table_passes(spark):
    assert quality.require_key(laps(spark, []), ["session"], "laps")["rows"] == 0


def test_grain_gate(spark):
    quality.require_grain(laps(spark, [(1, 1), (1, 2)]), ["session", "lap"], "mart")
    with pytest.raises(QualityError, match="'lap': 2"):
        quality.require_grain(laps(spark, [(1, 1), (1, 2), (1, 2)]), ["session", "lap"], "mart")


def test_period_gate(spark):
    periods = spark.createDataFrame([(1, 2), (2, 3), (3, None)], "s int, e int")
    quality.require_periods(periods, "s", "e", "status")
    with pytest.raises(QualityError, match="2 periods"):
        quality.require_periods(periods.union(spark.createDataFrame([(4, 4), (5, 1)], "s int, e int")), "s", "e", "status")


def test_profile(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a bigint, b string")
    assert [tuple(r) for r in quality.profile(df).collect()] == [
        (0, "a", "bigint", 2, 0),
        (1, "b", "string", 2, 1),
    ]
    assert quality.null_counts(df).first().asDict() == {"a": 0, "b": 1}
