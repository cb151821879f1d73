"""Language identification, quality and toxicity: known answers, odd rows, held-out accuracy."""

import math
import random
from itertools import product

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lapwise.llm import langid, quality, toxicity
from lapwise.llm.queries import QUERIES
from lapwise.llm.samples import bounded_sample, labelled_sample, remainder
from lapwise.llm.texts import texts_of

ODD = [(1, None), (2, ""), (3, "12 + 3!"), (4, "\n\n"), (5, "a"), (5, "a"), (None, "the end"), (7, "é"), (8, "word " * 50_000)]


def frame(spark, rows):
    """Odd rows with columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, 1, 2, "z") for i, t in rows], "doc_id long, text string, id int, score int, lang_pred string")


def test_remainder(spark):
    import zlib

    got = spark.range(50).select("id", remainder("id", 3).alias("r")).collect()
    assert all(r.r == zlib.crc32(str(r.id).encode()) % 3 for r in got)


def test_samples(spark):
    rows = spark.range(20_000).select("id", (F.col("id") % 2).alias("label"))
    sample = bounded_sample(rows, "label", 500, "id")
    n = sample.count()
    assert 700 < n < 1_300
    assert sample.exceptAll(bounded_sample(rows.repartition(7), "label", 500, "id")).count() == 0
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (3, None), (None, "d"), (5, "e")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, 0), (3, 1), (None, 1), (5, 7), (9, 1)], "doc_id long, toxic int")
    got = {(r.id, r.label, r.text) for r in labelled_sample(docs, labels, "doc_id", "text", "toxic", 100).collect()}
    assert got == {(1, 1, "a"), (2, 0, "b"), (2, 0, "c")}


def test_language_counts_agree_with_plain_python():
    rows = ["Ab  é1b", "", None, "ab"]
    row, bucket, times = langid.gram_counts(texts_of(pa.array(rows)), 1 << 14, (1, 2))
    totals = np.bincount(row, weights=times, minlength=4).tolist()
    # "ab éb" after folding (a digit is a space): letters a b é b; pairs ab, b_, _é, é_, _b.
    assert totals == [4 + 5, 0, 0, 2 + 1]


def test_language_of_odd_rows(spark):
    train = spark.createDataFrame(
        [(i, "the house and the dog", "en") for i in range(5)] + [(9, "das haus und der hund", "de"), (10, "x", None), (11, None, "fr")],
        "doc_id long, text string, lang string",
    )
    model = langid.fit_language_model(train)
    assert model.languages == ("de", "en")
    docs = frame(spark, [*ODD, (20, "THE DOG and"), (21, "der hund")])
    got = {(r.doc_id, r.lang_pred) for r in langid.identify_language(docs, model).collect()}
    assert {(1, "und"), (2, "und"), (3, "und"), (4, "und"), (20, "en"), (21, "de")} <= got
    out = langid.identify_language(docs, model)
    assert out.columns == ["doc_id", "lang_pred", "score"] and out.count() == len(ODD) + 2
    assert out.where("score < 0 OR score > 1 OR score IS NULL").count() == 0
    nothing = langid.fit_language_model(train.limit(0))
    assert {r.lang_pred for r in langid.identify_language(docs, nothing).collect()} == {"und"}
    assert langid.identify_language(docs.limit(0), model).count() == 0


def test_held_out_languages(spark, sf_dir, sf_documents):
    out = QUERIES["op5_language_id"](spark, sf_dir).join(sf_documents.select("doc_id", "lang"), "doc_id")
    held = out.where("held_out")
    assert held.where("lang = lang_pred").count() >= 0.97 * held.count()


def test_passages_of_a_text():
    text = " ".join(f"w{i}" for i in range(100))
    features, bounds = quality.passage_features(texts_of(pa.array([text, None, "!!! !!!", text])), width=40)
    assert bounds.tolist() == [0, 3, 4, 5, 8]
    assert np.isfinite(features).all() and features[3, -1] == 1 and features[3, :-1].sum() == 0
    assert np.allclose(features[:3], features[5:])
    repeated, _ = quality.passage_features(texts_of(pa.array(["a a a a"])))
    assert repeated[0, len(quality._CLASSES) + 1] == 0.75


def test_gradient_is_that_of_the_loss():
    rng = np.random.default_rng(2)
    features, bounds, labels = rng.normal(size=(9, quality.FEATURES)), np.array([0, 4, 5, 9]), np.array([1.0, 0.0, 1.0])
    model = quality.fit_bags(features, bounds, labels)

    def loss(weights):
        score, _ = quality.QualityModel(weights).score(features, bounds)
        return -np.mean(labels * np.log(score) + (1 - labels) * np.log(1 - score))

    start = {k: rng.normal(size=v.shape) * 0.3 if k not in ("mean", "scale") else v for k, v in model.weights.items()}
    gradient = quality._gradient(quality.QualityModel(start), features, bounds, labels)
    for name, g in gradient.items():
        at = tuple(0 for _ in g.shape)
        up, down = ({k: v.copy() for k, v in start.items()} for _ in range(2))
        up[name][at] += 1e-5
        down[name][at] -= 1e-5
        assert abs((loss(up) - loss(down)) / 2e-5 - g[at]) < 1e-6


def test_attention_finds_the_telling_passage():
    rng = np.random.default_rng(3)
    bags, labels = [], []
    for k in range(300):
        bag = rng.normal(size=(6, quality.FEATURES))
        bag[:, 0] = 0
        if k % 2:
            bag[rng.integers(6), 0] = 4
        bags.append(bag)
        labels.append(float(k % 2))
    bounds = np.arange(0, 6 * 301, 6)
    model = quality.fit_bags(np.concatenate(bags), bounds, np.array(labels))
    score, attention = model.score(np.concatenate(bags), bounds)
    assert np.mean((score > 0.5) == (np.array(labels) > 0.5)) > 0.97
    told = [np.argmax(attention[6 * k : 6 * k + 6]) == np.argmax(bags[k][:, 0]) for k in range(1, 300, 2)]
    assert np.mean(told) > 0.8
    assert np.allclose(np.add.reduceat(attention, bounds[:-1]), 1)


def test_posterior_agrees_with_brute_force(spark):
    """Naive Bayes spelled out n-gram by n-gram, over words for all of the documents."""
    rng = random.Random(12)
    vocabulary = {"aa": ["the", "and", "Ünit", "on"], "bb": ["der", "und", "über", "ein"], "cc": ["le", "et", "la", "été"]}
    train = [(i, " ".join(rng.choices(vocabulary[lang], k=rng.randint(1, 9))), lang) for i, lang in enumerate(rng.choices(sorted(vocabulary), [5, 3, 1], k=60))]
    probes = [(100 + i, " ".join(rng.choices(sum(vocabulary.values(), []), k=rng.randint(1, 5)))) for i in range(30)] + [(1, "x 1"), (2, "THE  the\n")]
    schema = "doc_id long, text string, lang string"
    model = langid.fit_language_model(spark.createDataFrame(train, schema).repartition(3), buckets=64)
    out = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify_language(frame(spark, probes), model).collect()}

    def grams(text):
        row, bucket, times = langid.gram_counts(texts_of(pa.array([text])), 64)
        return [int(b) for b, t in zip(bucket, times) for _ in range(t)]

    counts, rows = {}, {}
    for _, text, lang in train:
        rows[lang] = rows.get(lang, 0) + 1
        for b in grams(text):
            counts.setdefault(lang, [0.5] * 64)[b] += 1
    for doc_id, text in probes:
        logs = {
            lang: math.log(rows[lang] / len(train)) + sum(math.log(counts[lang][b] / sum(counts[lang])) for b in grams(text)) for lang in rows
        }
        best = max(sorted(logs), key=logs.get)
        share = 1 / sum(math.exp(v - logs[best]) for v in logs.values())
        assert out[doc_id][0] == best and out[doc_id][1] == pytest.approx(share)


@pytest.mark.parametrize(("text", "letter"), [("²", False), ("½ ① Ⅷ 12 _", False), ("² é", True), ("٣", False), ("字", True), ("", False)])
def test_numerals_are_no_letters(text, letter):
    assert langid.has_letter(text) is letter


@pytest.mark.parametrize(("name", "label", "least"), [("op8_quality", "quality", 0.9), ("op9_toxicity", "toxic", 0.85)])
def test_held_out_labels(spark, sf_dir, name, label, least):
    out = QUERIES[name](spark, sf_dir)
    assert out.where("score IS NULL OR score < 0 OR score > 1").count() == 0
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    for part in (out, out.where("held_out")):
        judged = part.join(labels, "doc_id")
        assert judged.where(f"predicted = {label}").count() >= least * judged.count()


def test_quality_of_odd_rows(spark):
    docs, labels = frame(spark, ODD), spark.createDataFrame([(1, 1), (8, 0), (7, 1)], "doc_id long, quality int")
    out = quality.score_quality(docs, quality.fit_quality(docs, labels), keep=["score", "lang_pred"][1:])
    assert out.count() == len(ODD) and out.where("score IS NULL").count() == 0
    assert out.columns == ["doc_id", "score", "passages", "attended", "lang_pred"]
    none = quality.fit_quality(docs, labels.limit(0))
    assert none is None and {r.score for r in quality.score_quality(docs, none).collect()} == {0.5}
    assert quality.score_quality(docs.limit(0), none).count() == 0


@pytest.fixture(scope="module")
def costs(spark):
    words = "you are such an idiot and a moron said the little dog to the stupid cat with trash in its stuff".split()
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices(words, k=40))) for i in range(60)]
    return toxicity.fit_characters(frame(spark, rows))


def restored(costs, rows):
    """(row, token, word) of what is restored."""
    texts = texts_of(pa.array(rows, pa.string()))
    spans = toxicity.Restorer(costs).spans(texts)
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    return [(int(np.searchsorted(texts.offsets, start, side="right")) - 1, token, word) for start, _, token, word in spans]


@pytest.mark.parametrize(
    ("token", "word"),
    [("1d1ot", "idiot"), ("id!ot", "idiot"), ("i.d.i.o.t", "idiot"), ("i d i o t", "idiot"), ("stuuuupid", "stupid"), ("m0r0n", "moron"), ("tr@$h", "trash"), ("m*ron", "moron"), ("st-up-id", "stupid")],
)
def test_restored_words(costs, token, word):
    assert toxicity.restore(token, costs) == word
    rows = [f"say {token}", token, f"said\n{token.upper()}, you", None]
    found = restored(costs, rows)
    assert {(row, got) for row, _, got in found if word in got.split()} == {(0, word), (1, word), (2, word)}


@pytest.mark.parametrize(
    ("token", "word"),
    [
        ("idi07", "idiot"), ("stup1d", "stupid"),
        ("57upid", "stupid"), ("1d1ot", "idiot"),
        ("st....upid", "stupid"), ("m-----oron", "moron"),
        ("i d 1 o t", "idiot"), ("i  d  i  o  t", "idiot"), ("m \t 0 r\u000b0  n", "moron"),
        ("iddiot", "idiot"), ("morron", "moron"), ("stuppid", "stupid"),
        ("id10t", "idiot"), ("1 d 1 0 t", "idiot"), ("11diot", "idiot"), ("111diot", "idiot"), ("$$tupid", "stupid"),
    ],
)
def test_disguises_of_all_forms_are_decoded(costs, token, word):
    rows = [f"say {token}", token, f"said\n{token.upper()} you", None]
    found = restored(costs, rows)
    assert {(row, got) for row, _, got in found if word in got.split()} == {(0, word), (1, word), (2, word)}


def test_stand_ins_at_the_end_of_a_word():
    # Under a model that has seen the words.
    texts = pa.array(["hate ass idiot see the kill all dogs " * 50])
    counts = toxicity.character_counts(pa.RecordBatch.from_arrays([texts], names=["text"]), 0).reshape((28,) * 3) + 0.01
    costs = -np.log(counts / counts.sum(axis=2, keepdims=True))
    for token, word in (("a$$", "ass"), ("h473", "hate"), ("k....ill", "kill"), ("dogs!", "dogs"), ("455hate", "asshate")):
        assert toxicity.restore(token, costs) == word
    spans = restored(costs, ["see all a$$ h473 dogs! 1 2 3 455", "k", "kill"])
    assert spans == [(0, "a$$", "ass"), (0, "h473", "hate")]


def all_readings(token, costs):
    """Words of all paths through the lattice, each with the least cost of those that spell it."""
    found = {}
    for path in product(*toxicity._options(token)):
        word, price = "".join(text for text, _ in path), sum(cost for _, cost in path)
        symbols = [0, 0, *[toxicity._symbol(c) for c in word], 0]
        price += sum(float(costs[x, y, z]) for x, y, z in zip(symbols, symbols[1:], symbols[2:]))
        found[word] = min(price, found.get(word, price))
    return found


def test_decoding_agrees_with_all_readings(costs, monkeypatch):
    rng = random.Random(9)
    for settle in (1, 2, 64):
        monkeypatch.setattr(toxicity, "SETTLE_EVERY", settle)
        for _ in range(150):
            token = "".join(rng.choice("idotsu10$!*. ppéx7") for _ in range(rng.randint(1, 7)))
            readings = all_readings(token, costs)
            assert readings[toxicity.restore(token, costs)] == pytest.approx(min(readings.values())), token


@pytest.mark.parametrize("before", ["x" * 61, "don" * 40, "q1" * 40, "a-" * 5_000])
def test_long_tokens_are_decoded_whole(costs, before):
    assert toxicity.restore(before + "stup1d", costs).endswith("stupid")
    spaced = " ".join("said" * 30) + " s t u p i d"
    assert restored(costs, [spaced])[0][2].replace(" ", "") == "said" * 30 + "stupid"


def test_character_counts_do_not_depend_on_batches():
    rows = ["ab", "cd", None, "", "a b", "é", "x" * 5]
    count = lambda part: toxicity.character_counts(pa.RecordBatch.from_arrays([pa.array(part, pa.string())], names=["text"]), 0)
    assert (count(rows) == sum(count([r]) for r in rows)).all()
    assert count(["ab"]).reshape(28, 28, 28)[0, 0, 1] == 1 and count(["ab", "cd"]).reshape(28, 28, 28)[1, 2, 3] == 0


def test_restored_words_take_the_place_of_their_tokens(costs):
    rows = ["1d1ot, you", None, "", "ä m0r0n, é", "no", "i d i o t", "tr@$h stup1d."]
    texts = texts_of(pa.array(rows))
    out = toxicity.restored_texts(texts, toxicity.Restorer(costs).spans(texts))
    assert [out.raw(i).decode() for i in range(len(out))] == ["idiot, you", "", "", "ä moron, é", "no", "idiot", "trash stupid."]


def test_plain_words_stay(costs):
    rows = ["An idiot, said the dog. See you a b", "x", "", "i", "don't e.g. 12 3.5 -- !", "a\nb\nc"]
    assert not [w for _, t, w in restored(costs, rows) if t.isalpha()]
    assert toxicity.disguised(texts_of(pa.array(["a", "b", "c"]))) == []


def test_restored_text_is_scored(spark):
    rng = random.Random(4)
    words = [f"{a}{b}{c}" for a in "bdfgklmnprst" for b in "aeiou" for c in ("ran", "lem", "dis")]
    rows = [(i, " ".join(rng.choices(words, k=50) + (["idiot"] if i % 3 == 0 else []))) for i in range(300)]
    docs = frame(spark, rows)
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(docs, labels)
    probes = [(1000, "balem idiot"), (1001, "balem 1d1ot"), (1002, "balem i d i o t"), (1003, "balem"), *ODD]
    out = toxicity.score_toxicity(frame(spark, probes), model)
    score = {r.doc_id: r.score for r in out.collect()}
    assert min(score[1000], score[1001], score[1002]) > 0.5 > 0.3 > score[1003]
    assert out.count() == len(probes) and out.where("score IS NULL").count() == 0
    assert [r.restored for r in out.where("doc_id = 1001").collect()][0][0].word == "idiot"


def test_toxicity_without_labels(spark):
    docs = frame(spark, ODD)
    labels = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    for few, expected in ((labels.limit(0), 0.0), (spark.createDataFrame([(5, 1)], "doc_id long, toxic int"), 1.0)):
        model = toxicity.fit_toxicity(docs, few)
        assert {round(r.score, 6) for r in toxicity.score_toxicity(docs, model).collect()} == {expected}
    assert toxicity.score_toxicity(docs.limit(0), model).count() == 0
    empty = toxicity.fit_characters(docs.limit(0))
    assert np.isfinite(empty).all()


def test_logistic_fit_prefers_what_tells():
    rng = np.random.default_rng(5)
    labels = (np.arange(400) % 2).astype(float)
    rows = [np.unique(np.concatenate([rng.integers(1, 50, 10), [0] if y else []])).astype(int) for y in labels]
    weights, bias = toxicity.fit_logistic(rows, labels, 50)
    assert weights.argmax() == 0 and weights[0] > 3 and bias < -1 and (weights[1:] < 1).all()
