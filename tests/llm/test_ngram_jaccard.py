"""The n-gram Jaccard join against all pairs."""

import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lapwise.llm import ngram_jaccard as module
from lapwise.llm.components import components
from lapwise.llm.ngram_jaccard import Members, Shingling, ngram_jaccard, tree_pairs

SCHEMA = "doc_id long, text string, node string, n int, key long"


def brute(rows, width, percent):
    """{row index: (n, component)}; rows that share an id are one document."""
    sets = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        grams = {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} or ({tuple(words)} if words else set())
        sets.append(grams)
    group = {i: i for i, _ in rows if i is not None}

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for (a, x), (b, y) in itertools.combinations(range(len(rows)) and list(enumerate(sets)), 2):
        i, j = rows[a][0], rows[b][0]
        if i is not None and j is not None and x and y and 100 * len(x & y) >= percent * len(x | y):
            p, q = sorted((root(i), root(j)))
            group[q] = p
    return sorted(((i, len(s), None if i is None else root(i)) for (i, _), s in zip(rows, sets, strict=True)), key=str)


def found(spark, rows, width, percent):
    df = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], SCHEMA).repartition(3)
    out = ngram_jaccard(df, width=width, percent=percent).collect()
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out), key=str)


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def corpus(seed):
    """Families of near copies around the threshold, shared passages, short texts, exact copies, nulls."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    rows, n = [], 0
    for _ in range(5):
        base = [rng.choice(vocabulary) for _ in range(rng.randrange(30, 260))]
        for _ in range(rng.randrange(2, 9)):
            rows.append((n, edited(rng, base, rng.randrange(0, 4 + len(base) // 40))))
            n += 1
        for _ in range(3):
            rows.append((n, " ".join([*passage, *(rng.choice(vocabulary) for _ in range(rng.randrange(1, 40)))])))
            n += 1
    rows += [(n, "One"), (n + 1, "one"), (n + 2, " "), (n + 3, ""), (n + 4, None), (n + 5, "a b"), (n + 6, "A  B\n"), (n + 7, "a b c")]
    rows += [(n + 8, "word " * 3000), (n + 9, "word " * 2500), (n + 10, rows[0][1]), (n + 10, rows[0][1]), (None, rows[0][1])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("width", "percent", "seed"), [(3, 90, 1), (5, 80, 2), (2, 70, 3), (1, 50, 4)])
def test_agrees_with_all_pairs(spark, width, percent, seed):
    rows = corpus(seed)
    assert found(spark, rows, width, percent) == brute(rows, width, percent)


@pytest.mark.parametrize(("width", "percent", "n"), [(3, 90, 9), (5, 80, 4), (2, 75, 3), (2, 70, 3)])
def test_sets_with_one_key_link_with_larger_ones(spark, width, percent, n):
    assert Shingling(width, percent).prefix(n) == 1
    rows = []
    for k in range(6):
        words = [f"f{k}w{i}" for i in range(n + width - 1)]
        # Any shingle may come first in the order of hashes: one more at the end, or at the beginning.
        rows += [(10 * k, " ".join(words)), (10 * k + 1, " ".join([*words, "end"])), (10 * k + 2, " ".join(["begin", *words]))]
        rows.append((10 * k + 3, " ".join(words[:-1])))
    expected = brute(rows, width, percent)
    assert all(component == i - i % 10 for i, _, component in expected if i % 10 < 3)
    assert found(spark, rows, width, percent) == expected


def test_large_blocks_cut_by_size_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(module, "LARGE_BLOCK", 2)
    monkeypatch.setattr(module, "FREQUENT_ROWS", 3)
    rows = corpus(5)
    assert found(spark, rows, 3, 90) == brute(rows, 3, 90)


def unlinked_family(count):
    """Copies of one text with a few edits each, mostly just below the threshold to each other."""
    rng = random.Random(8)
    base = [f"w{i}" for i in range(120)]
    return [(k, edited(rng, base, rng.randrange(1, 5))) for k in range(count)]


def test_large_blocks_are_dealt_to_tasks(spark, monkeypatch):
    monkeypatch.setattr(module, "BLOCK_MEMBERS", 8)
    most = []
    whole = module._candidates

    def watched(blocks, rule):
        most.append(blocks.groupBy("key", "band", "low", "high").count().agg(F.max("count")).first()[0])
        return whole(blocks, rule)

    monkeypatch.setattr(module, "_candidates", watched)
    rows = unlinked_family(60) + [(i + 1000, t) for i, t in corpus(6) if i is not None]
    assert found(spark, rows, 3, 90) == brute(rows, 3, 90)
    # Two chunks each; dealt by hash they differ in size.
    assert 8 < most[0] <= 3 * 8


@pytest.mark.parametrize("frequent", [3, 10**6])
def test_a_pair_is_handed_on_by_one_block(spark, monkeypatch, frequent):
    monkeypatch.setattr(module, "FREQUENT_ROWS", frequent)
    made = []
    whole = module._candidates

    def watched(blocks, rule):
        out = whole(blocks, rule)
        made.append((out.count(), out.distinct().count()))
        return out

    monkeypatch.setattr(module, "_candidates", watched)
    rng = random.Random(4)
    base = [f"w{i}" for i in range(600)]
    # Copies of one text that share most keys, but not enough of them with the first to be of its group.
    rows = [(k, edited(rng, base, 22)) for k in range(40)]
    assert found(spark, rows, 1, 90) == brute(rows, 1, 90)
    rows_made, pairs = made[0]
    assert pairs and rows_made <= 1.1 * pairs


def test_sides_are_compared_with_each_other_only():
    rng = random.Random(9)
    rule = Shingling(1, 80)
    base = [rng.randrange(2**64) for _ in range(345)]
    arrays = [np.array(sorted(base[: 300 + k % 45]), dtype=np.uint64) for k in range(100)]
    shown, following, bitmaps = zip(*(module.signature(a, rule) for a in arrays), strict=True)
    ids = np.arange(100)
    members = Members(np.array([len(a) for a in arrays]), ids, ids, np.array(shown), np.array(following), list(bitmaps), ids % 2)
    pairs = list(tree_pairs(members, rule))
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {(a, b) for a, b in itertools.combinations(range(100), 2) if a % 2 != b % 2}


def test_chains_are_one_component(spark):
    # Each is linked with the next only.
    words = [f"w{i}" for i in range(140)]
    rows = [(100 - k, " ".join(words[4 * k : 4 * k + 100])) for k in range(10)]
    expected = brute(rows, 1, 90)
    assert {c for _, _, c in expected} == {91}
    assert found(spark, rows, 1, 90) == expected


def test_repeated_id_joins_what_links_to_either(spark):
    a, b = " ".join(f"a{i}" for i in range(50)), " ".join(f"b{i}" for i in range(50))
    rows = [(7, a), (7, b), (3, a + " x"), (9, b + " x")]
    assert {c for _, _, c in found(spark, rows, 3, 90)} == {3}


def test_empty_table(spark):
    assert found(spark, [], 3, 90) == []


def test_rejects_nonsense():
    with pytest.raises(ValueError):
        Shingling(width=0)
    with pytest.raises(ValueError):
        Shingling(percent=0)


@pytest.mark.parametrize("percent", [40, 80, 90])
def test_tree_keeps_every_pair_that_links(percent):
    rng = random.Random(percent)
    rule = Shingling(1, percent)
    universe = [rng.randrange(2**64) for _ in range(5000)]
    sets = []
    for size in [*(rng.randrange(1, 900) for _ in range(60)), 168, 170, 172, 340, 342, 345, 680, 700, 1355, 1370, 2700, 2750]:
        base = rng.sample(universe, size)
        sets += [set(base)] + [set(base[rng.randrange(1 + len(base) // 8) :]) | {rng.randrange(2**64)} for _ in range(3)]
    arrays = [np.array(sorted(s), dtype=np.uint64) for s in sets]
    signed = [module.signature(a, rule) for a in arrays]
    ids = np.arange(len(sets))
    members = Members(
        np.array([len(a) for a in arrays]),
        ids,
        ids % 40,
        np.array([s for s, _, _ in signed]),
        np.array([f for _, f, _ in signed]),
        [b for _, _, b in signed],
    )
    pairs = set(tree_pairs(members, rule))
    links = 0
    for i, j in itertools.combinations(range(len(sets)), 2):
        if rule.linked(len(sets[i] & sets[j]), len(sets[i]), len(sets[j])) and i % 40 != j % 40:
            assert (i, j) in pairs
            links += 1
    # It rules out most of the rest.
    assert links > 50 and (percent == 40 or len(pairs) < len(sets) ** 2 / 20)


@pytest.mark.parametrize(("percent", "size", "changed"), [(90, 700, 60), (90, 5000, 400), (80, 700, 120), (80, 3000, 500)])
def test_unlinked_copies_of_one_text_are_no_candidates(percent, size, changed):
    """Variants with the same kind of edits: every two of them are below the threshold, but share most shingles."""
    rng = random.Random(size)
    rule = Shingling(1, percent)
    base = [rng.randrange(2**64) for _ in range(size)]
    sets = [{*rng.sample(base, size - changed), *(rng.randrange(2**64) for _ in range(changed))} for _ in range(70)]
    linked = [{*sets[k], rng.randrange(2**64)} for k in range(10)]
    arrays = [np.array(sorted(x), dtype=np.uint64) for x in sets + linked]
    shown, following, bitmaps = zip(*(module.signature(a, rule) for a in arrays), strict=True)
    ids = np.arange(len(arrays))
    members = Members(np.array([len(a) for a in arrays]), ids, ids, np.array(shown), np.array(following), list(bitmaps))
    pairs = set(tree_pairs(members, rule))
    assert {(k, 70 + k) for k in range(10)} <= pairs
    assert not any(rule.linked(len(a & b), len(a), len(b)) for a, b in itertools.combinations(sets, 2))
    assert len(pairs) < 0.02 * len(arrays) ** 2 / 2


def test_bitmaps_differ_in_no_more_places_than_sets():
    rng = random.Random(12)
    rule = Shingling(1, 90)
    for n in (1, 30, 150, 200, 700, 3000):
        base = [rng.randrange(2**64) for _ in range(n)]
        for extra in (0, 1, 5, n // 10, n):
            one, other = base[extra // 2 :], base[: n - extra // 2] + [rng.randrange(2**64) for _ in range(extra // 3)]
            bits = []
            for x in (one, other):
                marks, halved, bitmap = module.signature(np.array(sorted(x), dtype=np.uint64), rule)
                bits.append(np.unpackbits(np.frombuffer(bitmap, dtype=np.uint8), bitorder="little"))
                assert marks == bits[-1].sum() and halved == (bits[-1][: len(bits[-1]) // 2] ^ bits[-1][len(bits[-1]) // 2 :]).sum()
            short, long = sorted(bits, key=len)
            while len(long) > len(short):
                long = long[: len(long) // 2] ^ long[len(long) // 2 :]
            assert (short ^ long).sum() <= len(set(one) ^ set(other))


@pytest.mark.parametrize("task_links", [10**6, 20])
def test_components(spark, task_links):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(5, 5), (500, 501)] + [(k, k + 1) for k in range(1000, 1100)]
    group = {x: x for pair in links for x in pair}

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for a, b in links:
        p, q = sorted((root(a), root(b)))
        group[q] = p
    out = components(spark.createDataFrame(links, "a long, b long"), "a", "b", task_links)
    assert {(r.v, r.root) for r in out.collect()} == {(x, root(x)) for x in group if root(x) != x}
    none = spark.createDataFrame([], "a long, b long")
    assert components(none, "a", "b").where(F.lit(True)).collect() == []
