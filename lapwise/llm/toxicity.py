"""Toxicity by a noisy channel: restore disguised words, then score the restored text.

A character trigram model is counted over all texts. Tokens that may be disguised (a letter beside digits or marks,
a letter several times in a row, single letters and digits set apart) become lattices: each position offers the letters it may
stand for, or nothing. Viterbi decoding under the character model and the costs of the channel picks the most
likely word, which takes the token's place. All other tokens have one path and stay as they are. The restored text, and nothing
else, is scored by a sparse logistic model over hashed words and word beginnings, fitted on labelled rows.
"""

from __future__ import annotations

import math
import os
from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapwise.llm.jobs import prepare, scored_rows, with_kept, written
from lapwise.llm.samples import labelled_sample
from lapwise.llm.texts import ALPHANUMERIC, LOWER, SPACE, Texts, byte_table, mix, powers, slices, texts_of, to_signed, words_of

#: What a digit or mark may stand for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c",
}
#: Marks that may stand between letters for nothing, or (a star) for any vowel.
FILLERS = "._-*~^`'"
VOWELS = "aeiou"

#: Costs of the channel, as negative log probabilities.
COST_LEET, COST_STAR, COST_REPEAT, COST_JOIN = 0.7, 2.0, 0.3, 0.5
#: Of a letter that is doubled without being meant: most doubled letters are.
COST_TWICE = 8.0
#: Of leaving out a filler, another mark, a digit: a letter left out saves about as much under the character model.
#: Of a stand-in that is written several times for one letter.
COST_STAND_IN_TWICE = 3.0
#: Of a mark or digit that stands for nothing; digits hardly ever do.
COST_DROP, COST_DROP_MARK, COST_DROP_DIGIT = 0.5, 4.0, 12.0
#: Positions of a token after which what all its readings have in common is set down.
SETTLE_EVERY = 64

SYMBOLS = 28
OTHER = 27

#: Labelled rows per label the classifier is fitted on; features it may use; how surely a feature must tell.
SAMPLE_ROWS = 6_000
FEATURES = 20_000
EVIDENCE = 15.0
PREFIXES = (4, 5)

_LETTER = byte_table((0x61, 0x7A), (0x80, 0xFF))
_STAND_IN = np.zeros(256, dtype=bool)
_STAND_IN[[ord(c) for c in (*LEET, *FILLERS)]] = True
#: Marks that may stand before or after any word.
AROUND = ".,;:?\"'#%&"
_AROUND = np.zeros(256, dtype=bool)
_AROUND[[ord(c) for c in AROUND]] = True
_CODE = np.zeros(256, dtype=np.int64)
_CODE[97:123] = np.arange(1, 27)
_CODE[128:] = OTHER


def character_counts(texts: pa.RecordBatch, column: int) -> np.ndarray:
    """Trigram counts of the bytes of a column: letters, one symbol for all beyond ASCII, and 0 for the rest.

    Each text has two zeros before it, as decoding begins, and after it, so that none runs into the next and it does
    not matter which texts come together.
    """
    total = np.zeros(SYMBOLS**3, dtype=np.int64)
    for _, part in slices([texts.select([column]).rename_columns(["text"])], "text"):
        codes = np.insert(_CODE[LOWER[part.data]], np.repeat(part.offsets, 2), 0)
        total += np.bincount(codes[:-2] * SYMBOLS**2 + codes[1:-1] * SYMBOLS + codes[2:], minlength=SYMBOLS**3)
    return total


def fit_characters(docs: DataFrame, text_column: str = "text") -> np.ndarray:
    """Cost of each third symbol after two, from all texts; (28, 28, 28)."""

    def count(batches):
        total = np.zeros(SYMBOLS**3, dtype=np.int64)
        for batch in batches:
            total += character_counts(batch, 0)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["gram", "times"])

    prepare(docs.sparkSession)
    partial = docs.select(F.col(text_column).alias("text")).mapInArrow(count, "gram long, times long")
    table = partial.groupBy("gram").agg(F.sum("times").alias("times")).toPandas()
    counts = np.zeros(SYMBOLS**3)
    counts[table["gram"].to_numpy(dtype=np.int64)] = table["times"].to_numpy(dtype=float)
    counts = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    pairs = counts.sum(axis=0)
    back_off = (pairs + 0.5) / (pairs + 0.5).sum(axis=1, keepdims=True)
    smooth = (counts + 5 * back_off[None]) / (counts.sum(axis=2, keepdims=True) + 5)
    return -np.log(smooth)


def _options(token: str) -> list[list[tuple[str, float]]]:
    """The lattice of a token: per position the strings it may stand for, with their costs."""
    positions: list[list[tuple[str, float]]] = []
    i = 0
    while i < len(token):
        c = token[i]
        run = 1
        while i + run < len(token) and token[i + run] == c:
            run += 1
        if c.isalpha():
            if run >= 3:
                positions.append([(c, COST_REPEAT), (c * 2, 2 * COST_REPEAT)])
            elif run == 2:
                positions.append([(c, COST_TWICE), (c * 2, 0.0)])
            else:
                positions.append([(c, 0.0)])
        elif c in LEET or c in FILLERS:
            # At the end a "!" mostly ends a sentence.
            drop = COST_DROP if c in FILLERS or c == "!" and i + run == len(token) else COST_DROP_DIGIT if c.isdigit() else COST_DROP_MARK
            options = [("", drop * run)]
            options += [(x, COST_LEET + (COST_STAND_IN_TWICE if run > 1 else 0.0)) for x in LEET.get(c, "")]
            if run > 1:
                options += [(x * 2, COST_LEET + (COST_STAND_IN_TWICE if run > 2 else 0.0)) for x in LEET.get(c, "")]
            if c == "*":
                options += [(x, COST_STAR) for x in VOWELS]
            positions.append(options)
        elif c.isspace():
            while i + run < len(token) and token[i + run].isspace():
                run += 1
            positions.append([("", COST_JOIN), (" ", 0.0)])
        else:
            positions.append([("", COST_DROP * run)])
        i += run
    return positions


def _symbol(c: str) -> int:
    return ord(c) - 96 if "a" <= c <= "z" else 0 if c == " " else OTHER


def restore(token: str, costs: np.ndarray) -> str:
    """Most likely word behind a token in lower case (or words, behind letters set apart); ties: first by alphabet.

    Whole tokens are decoded, however long. What all readings begin with is set down now and then, so that the time
    goes with the length of the token.
    """
    states: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}
    settled: list[str] = []
    for i, options in enumerate([*_options(token), None]):
        following: dict[tuple[int, int], tuple[float, str]] = {}
        for (a, b), (cost, word) in states.items():
            if options is None:
                moves = [((a, b), (cost + float(costs[a, b, 0]), word))]
            else:
                moves = []
                for text, price in options:
                    x, y, total = a, b, cost + price
                    for c in text:
                        z = _symbol(c)
                        total += float(costs[x, y, z])
                        x, y = y, z
                    moves.append(((x, y), (total, word + text)))
            for state, value in moves:
                if state not in following or value < following[state]:
                    following[state] = value
        states = following
        if i % SETTLE_EVERY == SETTLE_EVERY - 1:
            common = os.path.commonprefix([word for _, word in states.values()])
            settled.append(common)
            states = {state: (cost, word[len(common) :]) for state, (cost, word) in states.items()}
    return "".join([*settled, min(states.values())[1]])


def disguised(texts: Texts) -> list[tuple[int, int]]:
    """Byte ranges of tokens, or of runs of tokens, that may be disguised words; in order, none within another."""
    data = LOWER[texts.data]
    n = len(data)
    if n < 2:
        return []
    letter, stand_in, space = _LETTER[data], _STAND_IN[data], SPACE[data]
    row_start = np.zeros(n + 1, dtype=bool)
    row_start[texts.offsets] = True
    starts = np.flatnonzero(~space & np.concatenate([[True], space[:-1] | row_start[1:n]]))
    ends = np.flatnonzero(~space & (np.append(space[1:], True) | row_start[1:])) + 1
    if not len(starts):
        return []
    # A stand-in anywhere but among the marks that may stand around any word, in a token with a letter.
    core = np.flatnonzero(~space & ~_AROUND[data])
    first, last = np.searchsorted(core, starts), np.searchsorted(core, ends) - 1
    filled = first <= last
    low, high = starts.copy(), starts.copy()
    low[filled], high[filled] = core[first[filled]], core[last[filled]] + 1
    letters = _counts(letter)
    marked = letters[ends] > letters[starts]
    stand_ins = _counts(stand_in)
    # A letter twice (of one byte each).
    twice = np.zeros(n, dtype=bool)
    twice[1:] = letter[1:] & (data[1:] == data[:-1]) & (data[1:] < 128) & ~row_start[1:n]
    repeats = _counts(twice)
    marked &= (stand_ins[high] > stand_ins[low]) | (repeats[ends] > repeats[starts])
    ranges = {(int(starts[w]), int(ends[w])) for w in np.flatnonzero(marked)}
    # Single letters or stand-ins set apart: runs of three or more such tokens in one row, the last maybe with a mark after it.
    size = ends - starts
    single = (letter[starts] | stand_in[starts]) & ((size == 1) | (size == 2) & ~letter[ends - 1])
    row = np.searchsorted(texts.offsets, starts, side="right")
    joined = single[1:] & single[:-1] & (size[:-1] == 1) & (row[1:] == row[:-1])
    change = np.flatnonzero(np.diff(np.concatenate([[0], joined.astype(np.int8), [0]])))
    for first, last in zip(change[::2], change[1::2], strict=True):
        if last - first >= 2 and letters[ends[last]] - letters[starts[first]] >= 2:
            ranges -= {(int(starts[w]), int(ends[w])) for w in range(first, last + 1)}
            ranges.add((int(starts[first]), int(ends[last])))
    return sorted(ranges)


def _counts(flags: np.ndarray) -> np.ndarray:
    """How many flags are set before each place."""
    return np.concatenate([[0], np.cumsum(flags)])


def _hash_rows(chars: np.ndarray, salt: int) -> np.ndarray:
    """Hash of each row of a byte matrix."""
    weighted = mix(chars.astype(np.uint64) + np.uint64(1)) * powers(chars.shape[1])[None, :]
    return mix(weighted.sum(axis=1, dtype=np.uint64) + np.uint64(salt))


def _word_features(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of each word and of the beginnings of longer words."""
    words = words_of(texts, ALPHANUMERIC)
    row = words.row
    rows, features = [row], [words.hash]
    lowered = LOWER[texts.data]
    for width in PREFIXES:
        longer = np.flatnonzero(words.length > width)
        if len(longer):
            chars = lowered[words.start[longer][:, None] + np.arange(width)[None, :]]
            rows.append(row[longer])
            features.append(_hash_rows(chars, width))
    return np.concatenate(rows), np.concatenate(features)


#: Longer tokens are decoded each time they are met.
REMEMBERED_CHARS = 64


class Restorer:
    """Restores tokens under one character model, remembering those seen often."""

    def __init__(self, costs: np.ndarray, remembered: int = 50_000):
        self.costs = costs
        self.word = lru_cache(remembered)(lambda token: restore(token, costs))

    def spans(self, texts: Texts) -> list[tuple[int, int, str, str]]:
        """(first byte, end, token, restored word) of disguised tokens that are not what they seem, in order."""
        out = []
        for start, end in disguised(texts):
            raw = texts.data[start:end].tobytes().decode("utf-8", "replace").lower()
            token = raw.strip(AROUND)
            word = self.word(token) if len(token) <= REMEMBERED_CHARS else restore(token, self.costs)
            if word and word not in (token, token.strip("*!")):
                before = len(raw) - len(raw.lstrip(AROUND))
                after = len(raw) - len(raw.rstrip(AROUND))
                out.append((start + before, end - after, token, word))  # these marks have one byte each
        return out


def restored_texts(texts: Texts, spans: Sequence[tuple[int, int, str, str]]) -> Texts:
    """The texts with the restored words in place of the tokens."""
    if not spans:
        return texts
    words = [word.encode() for _, _, _, word in spans]
    parts, at = [], 0
    for (start, end, _, _), word in zip(spans, words, strict=True):
        parts += [texts.data[at:start].tobytes(), word]
        at = end
    parts.append(texts.data[at:].tobytes())
    grown = np.cumsum([0, *[len(w) - (end - start) for (start, end, _, _), w in zip(spans, words, strict=True)]])
    # A span lies within one text, so each text's beginning moves by what the spans before it have grown.
    ends = np.array([end for _, end, _, _ in spans])
    offsets = texts.offsets + grown[np.searchsorted(ends, texts.offsets, side="right")]
    return Texts(np.frombuffer(b"".join(parts), dtype=np.uint8), offsets)


def features_of(texts: Texts, restorer: Restorer):
    """(row, feature) pairs of the restored texts, and the restored spans."""
    spans = restorer.spans(texts)
    return *_word_features(restored_texts(texts, spans)), spans


@dataclass(frozen=True)
class ToxicityModel:
    """Character costs, sorted features with their weights, and what is added to their sum. Not ``fitted`` without
    documents of both labels."""

    costs: np.ndarray
    features: np.ndarray
    weights: np.ndarray
    bias: float
    fitted: bool = True

    def score(self, texts: Texts, restorer: Restorer):
        n = len(texts)
        row, feature, spans = features_of(texts, restorer)
        total = np.full(n, self.bias)
        if len(self.features) and len(feature):
            place = np.minimum(np.searchsorted(self.features, feature), len(self.features) - 1)
            hit = self.features[place] == feature
            pairs = np.unique(row[hit] * len(self.features) + place[hit])
            total += np.bincount(pairs // len(self.features), weights=self.weights[pairs % len(self.features)], minlength=n)
        return 1 / (1 + np.exp(-np.clip(total, -500, 500))), spans


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    sample_rows: int = SAMPLE_ROWS,
) -> ToxicityModel:
    """Character model from all of ``docs``, classifier from at most about ``sample_rows`` documents per label.

    ``labels`` has ids and labels 0 or 1; see ``labelled_sample``. Equal texts count once. Without documents of
    both labels the score is 1 or 0, whichever label there is (0 without any).
    """
    spark = docs.sparkSession
    prepare(spark)
    costs = fit_characters(docs, text_column)
    rows = labelled_sample(docs, labels, id_column, text_column, label_column, sample_rows)
    rows = rows.groupBy(F.xxhash64("text").alias("same"), F.sha1("text").alias("digest")).agg(
        F.first("text").alias("text"), F.max("label").alias("label")
    )
    shared = spark.sparkContext.broadcast(costs)

    def extract(batches):
        restorer = Restorer(shared.value)
        for batch, texts in slices(batches, "text"):
            row, feature, _ = features_of(texts, restorer)
            order = np.lexsort((feature, row))
            row, feature = row[order], feature[order]
            first = np.ones(len(row), dtype=bool)
            first[1:] = (row[1:] != row[:-1]) | (feature[1:] != feature[:-1])
            row, feature = row[first], feature[first]
            cut = np.searchsorted(row, np.arange(len(texts) + 1))
            lists = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(to_signed(feature)))
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("label")), lists], names=["label", "features"])

    sample = written(rows.select("label", "text").mapInArrow(extract, "label int, features array<long>"), "toxicity-sample")
    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    none = np.zeros(0, dtype=np.uint64)
    if not toxic or not clean:
        share = 1.0 if toxic else 0.0
        return ToxicityModel(costs, none, np.zeros(0), 500.0 if share else -500.0, fitted=False)
    counted = sample.select("label", F.explode("features").alias("feature")).groupBy("feature").agg(
        F.sum("label").alias("t"), F.sum(1 - F.col("label")).alias("c")
    )
    t, c = F.col("t").cast("double"), F.col("c").cast("double")
    part = lambda seen, total, whole: F.when(seen > 0, seen * F.log(seen * whole / ((t + c) * total))).otherwise(0.0)
    evidence = 2 * (part(t, toxic, toxic + clean) + part(c, clean, toxic + clean))
    chosen = (
        counted.withColumn("evidence", evidence)
        .where((F.col("evidence") >= EVIDENCE) & (t * clean > c * toxic))
        .orderBy(F.desc("evidence"), "feature")
        .limit(FEATURES)
        .select("feature")
        .toPandas()["feature"]
        .to_numpy(dtype=np.int64)
    )
    features = np.sort(chosen.view(np.uint64))
    picked = spark.sparkContext.broadcast(features)

    def reduce_rows(batches):
        kept = picked.value
        for batch in batches:
            lists = batch.column(1)
            cut = lists.offsets.to_numpy()
            values = lists.values.to_numpy()[cut[0] : cut[-1]].view(np.uint64)
            place = np.minimum(np.searchsorted(kept, values), max(len(kept) - 1, 0))
            hit = kept[place] == values if len(kept) else np.zeros(len(values), dtype=bool)
            own = np.cumsum(np.concatenate([[0], hit]))[cut - cut[0]]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(own, pa.int32()), pa.array(place[hit].astype(np.int64)))],
                names=["label", "places"],
            )

    reduced = sample.mapInArrow(reduce_rows, "label int, places array<long>").toPandas()
    weights, bias = fit_logistic(list(reduced["places"]), reduced["label"].to_numpy(dtype=float), len(features))
    return ToxicityModel(costs, features, weights, bias)


def fit_logistic(
    rows: Sequence[np.ndarray], labels: np.ndarray, width: int, sparsity: float = 0.4, steps: int = 300
) -> tuple[np.ndarray, float]:
    """Weights >= 0 and bias of a logistic model over the features present, by accelerated proximal gradient.

    ``sparsity`` is the pull of each weight towards 0, in rows.
    """
    sizes = np.array([len(r) for r in rows], dtype=np.int64)
    row = np.repeat(np.arange(len(rows)), sizes)
    col = np.concatenate([np.asarray(r, dtype=np.int64) for r in rows]) if len(row) else np.zeros(0, dtype=np.int64)
    share = np.clip(labels.mean(), 1e-6, 1 - 1e-6)
    bias, weights = math.log(share / (1 - share)), np.zeros(width)
    step = 4 / (len(rows) * max(1.0, sizes.mean() + 1) ** 0.5 + 1)
    look_w, look_b, t = weights, bias, 1.0

    def loss(w, b):
        z = b + np.bincount(row, weights=w[col], minlength=len(rows))
        return np.logaddexp(0, z).sum() - labels @ z + sparsity * w.sum(), z

    value = loss(weights, bias)[0]
    for _ in range(steps):
        smooth, z = loss(look_w, look_b)
        smooth -= sparsity * look_w.sum()
        error = 1 / (1 + np.exp(-np.clip(z, -500, 500))) - labels
        grad_w, grad_b = np.bincount(col, weights=error[row], minlength=width), error.sum()
        while True:
            new_w = np.maximum(look_w - step * (grad_w + sparsity), 0.0)
            new_b = look_b - step * grad_b
            dw, db = new_w - look_w, new_b - look_b
            new_value = loss(new_w, new_b)[0]
            bound = smooth + grad_w @ dw + grad_b * db + (dw @ dw + db * db) / (2 * step) + sparsity * new_w.sum()
            if new_value <= bound + 1e-9 * abs(bound) or step < 1e-12:
                break
            step /= 2
        if new_value > value:
            t, look_w, look_b = 1.0, weights, bias
            if abs(new_value - value) < 1e-9 * abs(value):
                break
            value = max(value, new_value) if step < 1e-11 else value
            continue
        following = (1 + math.sqrt(1 + 4 * t * t)) / 2
        look_w = new_w + (t - 1) / following * (new_w - weights)
        look_b = new_b + (t - 1) / following * (new_b - bias)
        done = value - new_value < 1e-8 * abs(value)
        weights, bias, value, t = new_w, new_b, new_value, following
        if done:
            break
    return weights, float(bias)


def score_toxicity(
    docs: DataFrame,
    model: ToxicityModel,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep: Sequence[str] = (),
    spans: bool = True,
) -> DataFrame:
    """Per row: its id, ``score`` (0 to 1) of the whole restored text, ``restored`` (array of token and word; not unless
    ``spans``), and the columns named in ``keep``.

    Null and empty texts have no words and get the score of a text without any telling word. Ids may be null or
    repeat; other columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(model)
    pair = pa.list_(pa.struct([("token", pa.string()), ("word", pa.string())]))

    def score(batches):
        m = shared.value
        restorer = Restorer(m.costs)
        for batch, texts in slices(batches, "text"):
            value, restored = m.score(texts, restorer)
            columns = {"score": pa.array(value)}
            if spans:
                found: list[list] = [[] for _ in range(len(texts))]
                for start, _, token, word in restored:
                    found[int(np.searchsorted(texts.offsets, start, side="right")) - 1].append({"token": token, "word": word})
                columns["restored"] = pa.array(found, pair)
            yield with_kept(batch, columns)

    schema = "score double" + (", restored array<struct<token string, word string>>" if spans else "")
    return scored_rows(docs, score, schema, id_column, text_column, keep)
