"""Line dedup against brute force; the index forgets what is removed."""

import random

import numpy as np
import pytest
from pyspark.errors import PySparkException

from lapwise.llm.line_dedup import CuckooFilter, buckets_for, drop_lines, line_counts, line_index

SCHEMA = "doc_id long, text string, id string, key string, row int, shard string, kept int"
SPACE = " \t\n\v\f\r"
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def table(spark, rows):
    return spark.createDataFrame([(i, t, "x", None, 1, "s", None) for i, t in rows], SCHEMA)


def brute(rows, least, least_chars=1, counted=None):
    held = {}
    for _, text in rows if counted is None else counted:
        for key in {line.strip(SPACE).translate(LOWER) for line in (text or "").split("\n")}:
            held[key] = held.get(key, 0) + 1
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        keys = [line.strip(SPACE).translate(LOWER) for line in lines]
        kept = [line for line, key in zip(lines, keys) if len(key) < least_chars or held.get(key, 0) < least]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def random_rows(seed, n=60):
    rng = random.Random(seed)
    lines = ["Same line", " same LINE\t", "ÄÖ same", "äö same", "", " ", " x", "x", "a\r", "é", *[f"line {i}" for i in range(40)]]
    rows = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 8)))) for i in range(n)]
    # Null and empty texts, only empty lines, repeated rows and ids, null ids, one very long text.
    return rows + [(n, None), (n + 1, ""), (n + 2, "\n\n"), rows[0], rows[0], (None, "x\nsame line"), (None, None), (n + 3, "x\n" * 50_000 + "y")]


@pytest.mark.parametrize("most_bytes", [1 << 26, 500, 0], ids=["all sent", "filters sent", "nothing sent"])
@pytest.mark.parametrize("least_chars", [1, 2])
def test_agrees_with_brute_force(spark, most_bytes, least_chars):
    rows = random_rows(1)
    docs = table(spark, rows)
    index = line_index(spark, 4, least_chars, shards=8).insert(docs)
    out = drop_lines(docs, index, most_bytes=most_bytes)
    assert out.columns == ["doc_id", "n_lines", "n_dropped", "kept"]
    assert sorted(map(tuple, out.collect()), key=str) == brute(rows, 4, least_chars)


def state(index):
    """Exact counts, and which frequent keys the filters hold besides how many fingerprints there are."""
    counts = {(r["shard"], bytes(r["key"])): r["documents"] for r in index.counts.collect()}
    held = {r["shard"]: np.frombuffer(r["slots"], dtype=np.uint16) for r in index.filters.collect()}
    prints = {s: sorted(f[f > 0].tolist()) for s, f in held.items() if (f > 0).any()}
    return counts, prints


def test_removal_undoes_insertion(spark):
    a, b = table(spark, random_rows(2)), table(spark, random_rows(3))
    one = line_index(spark, 4, shards=4).insert(a)
    back = one.insert(b).remove(b)
    assert state(back) == state(one)
    both = line_index(spark, 4, shards=4).insert(a.unionByName(b))
    assert state(both) == state(one.insert(b))
    none = one.remove(a)
    assert state(none) == ({}, {})
    out = drop_lines(a, none)
    assert out.agg({"n_dropped": "sum"}).first()[0] == 0


def test_documents_need_not_be_those_of_the_index(spark):
    counted, rows = random_rows(4), random_rows(5)
    index = line_index(spark, 3, shards=4).insert(table(spark, counted))
    assert sorted(map(tuple, drop_lines(table(spark, rows), index).collect()), key=str) == brute(rows, 3, counted=counted)


def test_many_updates_are_merged(spark):
    rows = random_rows(6, 12)
    index = line_index(spark, 5, shards=2)
    for k in range(0, len(rows), 2):
        index = index.insert(table(spark, rows[k : k + 2]))
    assert len(index.generations) <= 8
    assert state(index) == state(line_index(spark, 5, shards=2).insert(table(spark, rows)))


def test_removing_what_was_never_inserted_fails(spark):
    index = line_index(spark, 2, shards=2).insert(table(spark, [(1, "a")]))
    with pytest.raises(PySparkException, match="never inserted"):
        index.remove(table(spark, [(2, "b")]))


def test_empty_table(spark):
    docs = table(spark, [])
    index = line_index(spark).insert(docs)
    assert drop_lines(docs, index).collect() == [] and index.counts.count() == 0
    rows = [(1, "a\nb"), (2, None)]
    assert sorted(map(tuple, drop_lines(table(spark, rows), index).collect())) == brute(rows, 10)


def test_counts_are_of_documents(spark):
    rows = [(1, "a\nA\n a"), (1, "a"), (2, "b\n")]
    found = line_counts(table(spark, rows), "text", 1, 4).collect()
    assert sorted(r["documents"] for r in found) == [1, 2]


def test_filter_holds_all_it_was_given_and_forgets_what_goes():
    rng = np.random.default_rng(7)
    keys = rng.integers(0, 2**64, size=(20_000, 2), dtype=np.uint64)
    made = CuckooFilter.of(keys[:10_000], buckets_for(10_000))
    assert made.holds(keys[:10_000]).all()
    assert made.holds(keys[10_000:]).mean() < 0.002
    made.discard(keys[:5_000])
    assert made.holds(keys[5_000:10_000]).all()
    assert made.holds(keys[:5_000]).mean() < 0.002
    assert made.add(keys[:5_000]) and made.holds(keys[:10_000]).all()
    made.discard(keys[:10_000])
    assert not made.slots.any()


def test_filter_that_is_full_says_so():
    keys = np.random.default_rng(8).integers(0, 2**64, size=(100, 2), dtype=np.uint64)
    assert not CuckooFilter.empty(8).add(keys)
    assert CuckooFilter.of(keys, 8).holds(keys).all()
