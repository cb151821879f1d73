"""Equality, range and next-ordinal joins against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from lapwise.operators.joins import _blocks, lookup_join, next_ordinal_join, range_join


def test_lookup_join_tells_hits_from_null_values(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(1, None), (None, "x")], "k int, name string")
    rows = lookup_join(left, right, ["k"], ["name"], hit="found").orderBy("k").collect()
    assert [(r["k"], r["name"], r["found"]) for r in rows] == [(None, None, False), (1, None, True), (2, None, False)]


EDGES = [(1, 3, "low"), (3, 5, "high"), (None, 9, "no start"), (7, None, "no end"), (9, 8, "reversed"), (-4, -2, "negative")]


@pytest.mark.parametrize("max_ranges", [64, 0])
def test_range_join_edges(spark, max_ranges):
    ranges = spark.createDataFrame([("d", *r) for r in EDGES], "k string, low long, high long, name string")
    laps = spark.createDataFrame([("d", n) for n in [-5, -4, -2, 0, 1, 3, 5, 8, None]] + [("e", 3), (None, 3)], "k string, n long")
    joined = range_join(laps, ranges, ["k"], "n", "low", "high", ["name"], max_ranges)
    assert joined.columns == ["k", "n", "name"]
    got = sorted(map(tuple, joined.collect()), key=str)
    expected = [("d", -5, None), ("d", -4, "negative"), ("d", -2, "negative"), ("d", 0, None), ("d", 1, "low")]
    expected += [("d", 3, "low"), ("d", 3, "high"), ("d", 5, "high"), ("d", 8, None), ("d", None, None)]
    expected += [("e", 3, None), (None, 3, None)]
    assert got == sorted(expected, key=str)


@pytest.mark.parametrize("max_ranges", [10**6, 0])
def test_range_join_against_brute_force(spark, max_ranges):
    generator = random.Random(5)
    points = [(generator.choice("aab"), generator.randint(-50, 300)) for _ in range(400)]
    ranges = []
    for i in range(120):
        low = generator.randint(-60, 300)
        ranges.append((generator.choice("aab"), low, low + generator.choice([0, 1, 7, 64, 250]), i))
    joined = range_join(
        spark.createDataFrame(points, "k string, n int"),
        spark.createDataFrame(ranges, "k string, low int, high int, id int"),
        ["k"],
        "n",
        "low",
        "high",
        ["id"],
        max_ranges,
    )
    expected = []
    for k, n in points:
        hits = [i for rk, low, high, i in ranges if rk == k and low <= n <= high]
        expected += [(k, n, i) for i in hits] or [(k, n, None)]
    assert sorted(map(tuple, joined.collect()), key=str) == sorted(expected, key=str)


LOWEST, HIGHEST = -(2**63), 2**63 - 1


@pytest.mark.parametrize("more", [0, 100])
def test_range_join_over_all_numbers(spark, more):
    """With one range or with a hundred on the key, whichever way they are looked up."""
    wide = [(0, 2**62), (0, 2**62 - 1), (LOWEST, HIGHEST), (LOWEST, LOWEST), (HIGHEST, HIGHEST), (5, HIGHEST), (LOWEST, -3)]
    points = [LOWEST, LOWEST + 1, -4, -3, -2, -1, 0, 1, 5, 7, 2**62 - 1, 2**62, HIGHEST - 1, HIGHEST]
    laps = spark.createDataFrame([("d", n) for n in points], "k string, n long")
    for low, high in wide:
        ranges = [("d", low, high, -1)] + [("d", 10**6 + 10 * i, 10**6 + 10 * i + 3, i) for i in range(more)]
        joined = range_join(
            laps, spark.createDataFrame(ranges, "k string, low long, high long, id int"), ["k"], "n", "low", "high", ["id"]
        )
        expected = {(n, -1 if low <= n <= high else None) for n in points}
        assert {(r.n, r.id) for r in joined.collect()} == expected


@pytest.mark.parametrize("max_ranges", [64, 0])
def test_range_join_refuses_what_is_not_whole(spark, max_ranges):
    whole = spark.createDataFrame([("d", 3, 3, 1)], "k string, low long, high long, id int")
    half = spark.createDataFrame([("d", 3.5)], "k string, n double")
    with pytest.raises(TypeError, match="integral"):
        range_join(half, whole, ["k"], "n", "low", "high", ["id"], max_ranges)
    with pytest.raises(TypeError, match="integral"):
        range_join(
            half.withColumn("n", F.lit(3)), whole.withColumn("high", F.lit(3.5)), ["k"], "n", "low", "high", ["id"], max_ranges
        )


def test_range_join_without_ranges(spark):
    laps = spark.createDataFrame([("d", 1)], "k string, n long")
    none = spark.createDataFrame([], "k string, low long, high long, name string")
    for max_ranges in (64, -1):
        assert range_join(laps, none, ["k"], "n", "low", "high", ["name"], max_ranges).collect()[0]["name"] is None


def test_blocks_cover_each_ordinal_once(spark):
    generator = random.Random(9)
    ranges = [(low, low + generator.randint(0, 90)) for low in (generator.randint(-100, 100) for _ in range(60))]
    ranges.append((0, 2**40))
    df = spark.createDataFrame(ranges, "low long, high long")
    for row in df.withColumn("blocks", _blocks(F.col("low"), F.col("high"))).collect():
        pieces = sorted((b["number"] << b["level"], (b["number"] + 1) << b["level"]) for b in row["blocks"])
        assert pieces[0][0] == row["low"] and pieces[-1][1] == row["high"] + 1
        assert all(a[1] == b[0] for a, b in zip(pieces, pieces[1:]))
        assert len(pieces) <= 2 * (row["high"] + 1 - row["low"]).bit_length()


def test_next_ordinal_join_respects_gaps(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 4, "z"), ("b", 3, "w")], "k string, n int, v string")
    paired = next_ordinal_join(rows.where("v <> 'y'"), rows, ["k"], "n", {"v": "next_v"}).orderBy("k", "n").collect()
    assert [(r["k"], r["n"], r["next_v"]) for r in paired] == [("a", 1, "y"), ("a", 4, None), ("b", 3, None)]
