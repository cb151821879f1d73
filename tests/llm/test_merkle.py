"""The Merkle manifest against trees built node by node in Python."""

import hashlib

import pytest
from pyspark.sql import functions as F

from lapwise.llm import merkle

SCHEMA = "doc_id long, grp string, digest string, extra string, idx int"


def digest_of(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([digest_of(*last[i : i + 3]) for i in range(0, len(last), 3)])
    return levels


def beside(levels, i):
    out = []
    for level in levels[:-1]:
        first = i - i % 3
        out.append(("".join(level[first:i]), "".join(level[i + 1 : first + 3])))
        i //= 3
    return out


def brute(rows):
    """(doc_id, group, digest, subroot, root, proof) of every row."""
    groups = {}
    for doc_id, group, digest, *_ in rows:
        groups.setdefault(group, []).append((doc_id is not None, doc_id or 0, digest, doc_id))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([r[2] for r in sorted(groups[g], key=lambda r: r[:3])]) for g in order}
    top = tree([trees[g][-1][0] for g in order])
    out = []
    for j, g in enumerate(order):
        for i, row in enumerate(sorted(groups[g], key=lambda r: r[:3])):
            out.append((row[3], g, row[2], trees[g][-1][0], top[-1][0], beside(trees[g], i) + beside(top, j)))
    return out


def found(spark, rows, stride):
    df = spark.createDataFrame(rows, SCHEMA)
    made = merkle.manifest(df, "grp", "doc_id", "digest", keep=("extra",), stride=stride)
    out = merkle.proofs(made)
    folded = out.withColumn("folded", merkle.fold(F.col("digest"), F.col("proof"))).collect()
    assert all(r.folded == r.root for r in folded)
    return made, [(r.doc_id, r.grp, r.digest, r.subroot, r.root, [tuple(s) for s in r.proof]) for r in folded]


def by_text(rows):
    return sorted(rows, key=str)


@pytest.mark.parametrize("stride", [1, 2, 4])
def test_proofs_agree_with_whole_trees(spark, stride):
    """Groups of many sizes around powers of three, a null group, null and repeated ids, repeated rows."""
    rows = []
    for group, size in {None: 5, "": 1, "a": 2, "b": 3, "ä": 4, "z": 9, "hot": 100, "y": 28, "x": 27, "Z": 10}.items():
        rows += [(i // 2 if group == "z" else i, group, digest_of(str(group), str(i)), "kept", 7) for i in range(size)]
    rows += [(None, "hot", digest_of("n"), None, None)] * 3 + [(None, "hot", digest_of("m"), None, None)]
    made, proofs = found(spark, rows, stride)
    assert by_text(proofs) == by_text(brute(rows))
    assert [r.digest for r in made.root.collect()] == [brute(rows)[0][4]]
    assert {r.grp for r in made.subroots.collect()} == {g for _, g, *_ in rows}


def test_only_every_few_levels_are_stored(spark):
    rows = [(i, "g", digest_of(str(i)), "", 0) for i in range(90)]
    made, _ = found(spark, rows, 2)
    # 90 leaves, 30, 10, 4, 2, 1 nodes above: stored are the leaves, 10, 2 and, at the top, 1.
    assert [s.count() for s in made.strata] == [90, 10, 2, 1]


def test_a_lone_leaf_is_the_root(spark):
    _, proofs = found(spark, [(1, "g", digest_of("x"), "", 0)], 4)
    assert proofs == [(1, "g", digest_of("x"), digest_of("x"), digest_of("x"), [])]


def test_empty_table(spark):
    made, proofs = found(spark, [], 4)
    assert proofs == [] and made.root.count() == 0


def test_leaf_fields_can_not_run_into_each_other(spark):
    rows = spark.createDataFrame([("a", None), ("", "-"), ("ä\n", "1:x"), (None, None)], "a string, b string")
    got = [r[0] for r in rows.select(merkle.leaf(F.col("a"), F.col("b"))).collect()]
    assert got == [digest_of("1:a", "-"), digest_of("0:", "1:-"), digest_of("3:ä\n", "3:1:x"), digest_of("-", "-")]
    assert len(set(got)) == 4


def test_a_change_of_one_leaf_is_noticed(spark):
    rows = [(i, "g" if i % 3 else "h", digest_of(str(i)), "", 0) for i in range(40)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = merkle.proofs(merkle.manifest(df, "grp", "doc_id", "digest"))
    changed = out.withColumn("digest", F.when(F.col("doc_id") == 17, F.sha2("digest", 256)).otherwise(F.col("digest")))
    bad = changed.where(merkle.fold(F.col("digest"), F.col("proof")) != F.col("root")).collect()
    assert [r.doc_id for r in bad] == [17]
