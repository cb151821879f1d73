"""Decontamination, license scans and exact top-k search against brute force."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lapwise.llm.decontaminate import Items, Walks, best_alignment, decontaminated, find_leaks, passages
from lapwise.llm.licenses import LEAST_PERCENT, TEMPLATES, Index, license_scan
from lapwise.llm.texts import mix
from lapwise.llm.topk import exact_top_k, products, select

VOCABULARY = mix(np.arange(2000, dtype=np.uint64) + np.uint64(5))


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[-1] + 1))
        row = new
    return row[-1]


def with_edits(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        k, at = rng.integers(3), rng.integers(len(words))
        if k == 0:
            words[at] = rng.choice(VOCABULARY)
        elif k == 1:
            del words[at]
        else:
            words.insert(at, rng.choice(VOCABULARY))
    return np.array(words, dtype=np.uint64)


@pytest.mark.parametrize("size", [8, 25, 60, 150])
def test_recall_at_the_full_distance(size):
    rng = np.random.default_rng(size)
    items = Items(list(range(60)), [rng.choice(VOCABULARY, size) for _ in range(60)], Walks())
    hits = 0
    for i in range(60):
        copy = with_edits(rng, items.words[i], items.walks.edits(size))
        text = np.concatenate([rng.choice(VOCABULARY, 40), copy, rng.choice(VOCABULARY, 40)])
        for row, item, (first, n, length, edits) in passages(items, text, np.array([0, len(text)])):
            assert row == 0 and length == size and edits <= items.walks.edits(size)
            assert edits == edit_distance(items.words[item].tolist(), text[first : first + n].tolist())
            hits += item == i
    assert hits >= 55


def test_exact_copies_are_all_found():
    rng = np.random.default_rng(1)
    items = Items([4, 5, 6], [rng.choice(VOCABULARY, n) for n in (1, 19, 200)], Walks())
    noise = rng.choice(mix(np.arange(9000, 9900, dtype=np.uint64)), 50)
    text = np.concatenate([noise, *(w for own in items.words for w in (own, noise, own, noise))])
    bounds = np.array([0, 0, len(text)])
    got = sorted((i, first) for row, i, (first, *_ ) in passages(items, text, bounds))
    at, expected = 50, []
    for i, own in enumerate(items.words):
        expected += [(i, at), (i, at + len(own) + 50)]
        at += 2 * (len(own) + 50)
    assert got == sorted(expected)
    assert best_alignment(items.words[1], text)[0] == 0


def test_leaks_with_odd_rows(spark):
    item = "The quick brown fox jumps over the lazy dog near the old river bank today"
    words = item.split()
    near = " ".join([*words[:4], "LEAPS", *words[5:]])
    docs = spark.createDataFrame(
        [(1, f"x {item.upper()}! y", 0), (2, f"{near}", 0), (3, " ".join(words[:7]), 0), (4, None, 0), (5, "", 0), (None, item, 0), (1, "y " * 20_000 + item, 0)],
        "doc_id long, text string, item long",
    )
    bench = spark.createDataFrame([(9, item, 1), (9, item, 1), (8, None, 1), (7, "..", 1)], "item_id long, text string, doc_id long")
    got = {(r.doc_id, r.item_id, r.first_word, r.n_words, r.item_words, r.edits) for r in find_leaks(docs, bench).collect()}
    assert got == {(1, 9, 1, 15, 15, 0), (2, 9, 0, 15, 15, 1), (None, 9, 0, 15, 15, 0), (1, 9, 20_000, 15, 15, 0)}
    kept = decontaminated(docs, find_leaks(docs, bench, walks=Walks(), block_items=1))
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["3", "4", "5", "None"]
    assert kept.columns == docs.columns
    assert find_leaks(docs.limit(0), bench).count() == 0
    assert find_leaks(docs, bench.limit(0)).count() == 0


WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_in(text):
    return re.findall(WORD, re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def licenses_by_trying(text):
    """Every template laid at every place of the text."""
    index = Index()
    weight = {w: int(index.weights[n]) for t, own in zip(TEMPLATES, index.numbered, strict=True) for w, n in zip(t.words, own.tolist(), strict=True)}
    words = words_in(text)
    present, matches, base = set(words), [], []
    for t in TEMPLATES:
        n, slack, total = len(t.words), t.slack, sum(weight[w] for w in t.words)
        if sum(weight[w] for w in t.words if w in present) * 100 < t.percent * total:
            continue
        good = []
        for s in range(-n - slack, len(words) + slack):
            lined = sum(weight[w] for i, w in enumerate(t.words) if w in words[max(s + i - slack, 0) : max(s + i + slack + 1, 0)])
            stands = all(
                any(
                    tuple(words[p : p + len(phrase)]) == phrase
                    for phrase in group
                    for o in range(n)
                    if t.words[o : o + len(phrase)] == phrase
                    for p in range(max(s + o - slack, 0), max(s + o + slack + 1, 0))
                )
                for group in t.mandatory
            )
            if lined * 100 >= t.percent * total and stands:
                straight = sum(weight[w] for i, w in enumerate(t.words) if 0 <= s + i < len(words) and words[s + i] == w)
                good.append((-lined, -straight, s))
        kept = []
        for lined, _, s in sorted(good):
            if not slack or all(abs(s - k) >= n for k, _ in kept):
                kept.append((s, -lined / total))
        matches += [(t.label, max(s, 0), n, share) for s, share in kept]
        base += [(s, t.label) for s, _ in kept if t.base]
    starts = [s for s, _ in base]
    return (
        len(words), len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted({b for _, b in base})),
        ",".join(sorted({m[0] for m in matches})), max((m[3] for m in matches), default=0.0), sorted(matches),
    )


def scanned(row):
    return (row.n_words, row.n_base, row.first_word, row.last_word, row.base_labels, row.labels, row.score, sorted(tuple(m) for m in row.matches))


def edited(words, rng, percent, kinds=("swap", "drop", "put")):
    """So many of a hundred words swapped, dropped or put in."""
    out = list(words)
    for at in sorted(rng.sample(range(len(words)), len(words) * percent // 100), reverse=True):
        kind = rng.choice(kinds)
        out[at : at + 1] = {"swap": ["zq"], "drop": [], "put": [out[at], "zq"]}[kind]
    return out


def test_license_scan(spark, sf_documents):
    odd = [
        (10**9, "MIT license", ""),
        (10**9 + 1, "mit-License, apache\nLICENSE. General (public) license mit license", ""),
        (10**9 + 2, None, ""),
        (10**9 + 3, "license mit", ""),
        (10**9 + 3, "Released under the MIT Licence; permission is hereby granted, free of charge, to any person", ""),
        (None, "x " * 100_000 + "Licensed under the Apache License, Version 2.0 éé", ""),
        (10**9 + 4, "", ""),
    ]
    docs = sf_documents.select("doc_id", "text", F.lit("").alias("labels")).unionAll(
        spark.createDataFrame(odd, "doc_id long, text string, labels string")
    )
    texts = {(r.doc_id, r.text) for r in docs.collect()}
    out = license_scan(docs).collect()
    assert len(out) == docs.count()
    assert {str((r.doc_id, *scanned(r))) for r in out} == {str((i, *licenses_by_trying(t))) for i, t in texts}
    by_id = {r.doc_id: r for r in out}
    assert by_id[None].labels == "apache,apache-2.0" and by_id[None].first_word == 100_003 and by_id[None].score == 1.0
    assert by_id[10**9 + 2].labels == "" and by_id[10**9 + 2].score == 0.0
    assert all(set(r.base_labels.split(",")) <= set(r.labels.split(",")) for r in out if r.base_labels)
    assert license_scan(docs.limit(0)).count() == 0


def test_notices_with_edits(spark):
    """Matches equal those of trying every place; of notices with a tenth of the words edited nine in ten are found."""
    rng = random.Random(5)
    notices = [t for t in TEMPLATES if t.percent == LEAST_PERCENT]
    prose = sorted({w for t in TEMPLATES for w in t.words}) + ["zq"] * 50
    rows, sought = [], {}
    for n, t in enumerate(notices):
        for trial in range(20):
            before = rng.choices(prose, k=rng.choice([0, 3, 40]))
            copies = [edited(t.words, rng, 10) for _ in range(1 + trial % 2)]
            text = [*before, *copies[0], *rng.choices(prose, k=5), *(copies[1] if len(copies) > 1 else [])]
            rows.append((100 * n + trial, " ".join(text)))
            sought[100 * n + trial] = (t, len(before))
        # Cut off at the front, and half a notice.
        rows.append((100 * n + 50, " ".join(t.words[2:])))
        rows.append((100 * n + 51, " ".join(t.words[: len(t.words) // 2])))
    out = {r.doc_id: r for r in license_scan(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert {i: scanned(out[i]) for i, _ in rows} == {i: licenses_by_trying(text) for i, text in rows}
    found = [
        any(m.label == t.label and m.n_words == len(t.words) and abs(m.first_word - at) <= t.slack for m in out[i].matches)
        for i, (t, at) in sought.items()
    ]
    assert sum(found) >= 0.9 * len(found), sum(found) / len(found)
    for n, t in enumerate(notices):
        assert t.label not in {m.label for m in out[100 * n + 51].matches if m.n_words == len(t.words)}


def test_every_match_has_a_rare_word():
    index = Index()
    for t, words in enumerate(index.numbered):
        rare = index.rare_template == t
        held = index.weights[index.rare_word[rare]].sum()
        assert index.weights[words].sum() - held < index.least[t]


def best_by_sorting(vectors, k):
    scaled = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in vectors if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, a in scaled:
        if q % 10 == 0:
            ranked = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in scaled if i != q and len(b) == len(a))
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(ranked[:k])]
    return sorted(out)


@pytest.mark.parametrize("block", [1, 3, 100])
def test_top_k(spark, block):
    rng = random.Random(block)
    common = [0.5, -0.25, 1.0]
    vectors = [(i, common if i % 3 else [rng.uniform(-1, 1) for _ in range(3)]) for i in range(90)]
    vectors += [(200, None), (210, [1.0, None, 0.0]), (220, [float("nan")] * 3), (230, [float("inf")] * 3), (None, common), (41, common), (240, [1.0])]
    df = spark.createDataFrame([(i, v, 0) for i, v in vectors], "vec_id long, embedding array<float>, rank int").repartition(4)
    single = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in vectors]
    out = exact_top_k(df, F.col("vec_id") % 10 == 0, k=10, query_block=block)
    assert sorted(tuple(r) for r in out.collect()) == best_by_sorting(single, 10)
    assert dict(out.dtypes)["rank"] == "int"


def test_top_k_of_few(spark):
    df = spark.createDataFrame([(10, [1.0]), (11, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in exact_top_k(df, F.col("vec_id") == 10).collect()] == [(10, 1, 11, 1024 * 2048)]
    assert exact_top_k(df.limit(0), F.lit(True)).collect() == []
    assert exact_top_k(df, F.lit(False)).collect() == []


def test_selection_and_products():
    rng = np.random.default_rng(0)
    score = rng.integers(0, 4, (20, 50))
    ids = np.stack([rng.permutation(50) for _ in range(20)])
    real = rng.random((20, 50)) < 0.7
    s, i, r = select(score, ids, real, 8)
    for q in range(20):
        expected = sorted((-score[q, j], ids[q, j]) for j in range(50) if real[q, j])[:8]
        assert sorted((-a, b) for a, b, c in zip(s[q], i[q], r[q]) if c) == expected
    big = np.array([[2**40, -(2**20)]])
    assert products(big, big)[0, 0] == 2**63 - 1
    assert products(np.array([[2**28, 1]]), np.array([[2**28, 3]]))[0, 0] == 2**56 + 3
