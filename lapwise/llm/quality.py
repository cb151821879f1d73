"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages, and only the document has a label. Every passage is described by numbers that
need no vocabulary, encoded by a small layer, and weighted by gated attention (a tanh branch times a sigmoid
branch); the weighted sum of the encoded passages gives the score. All of it is learned together from labels.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapwise.llm.jobs import prepare, scored_rows, with_kept
from lapwise.llm.samples import labelled_sample
from lapwise.llm.texts import NOT_SPACE, Texts, byte_table, mix, slices, words_of

PASSAGE_WORDS = 64
#: Labelled rows per label the model is fitted on.
SAMPLE_ROWS = 3_000
HIDDEN, GATE = 16, 8
EPOCHS, BATCH, RATE, DECAY = 30, 128, 0.01, 1e-4

_UPPER = byte_table((0x41, 0x5A))
_LOWER = byte_table((0x61, 0x7A))
_DIGIT = byte_table((0x30, 0x39))
_WIDE = byte_table((0x80, 0xFF))
_MARK = byte_table((0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E))
_USUAL = byte_table((0x2C, 0x2C), (0x2E, 0x2E))
_LINE = byte_table((0x0A, 0x0A))
_CLASSES = np.stack([_UPPER, _LOWER, _DIGIT, _WIDE, _MARK & ~_USUAL, _USUAL, _LINE])

FEATURES = len(_CLASSES) + 8


def passage_features(texts: Texts, width: int = PASSAGE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(passages x FEATURES, bounds of each row's passages). Passages are runs of ``width`` words, the last may be
    shorter; a text without words has one passage, all zero but for the feature that says so."""
    words = words_of(texts, NOT_SPACE, lower=False)
    counts = words.counts
    per_row = np.maximum(-(-counts // width), 1)
    bounds = np.concatenate([[0], np.cumsum(per_row)])
    total = int(bounds[-1])
    out = np.zeros((total, FEATURES))
    empty = np.flatnonzero(counts == 0)
    out[bounds[empty], -1] = 1.0
    n = len(words.hash)
    if not n:
        return out, bounds
    row = words.row
    passage = bounds[row] + (np.arange(n) - words.bounds[row]) // width
    first = np.flatnonzero(np.diff(passage, prepend=-1))
    there = passage[first]
    last = np.append(first[1:], n) - 1
    size = (last - first + 1).astype(float)
    begin, end = words.start[first], words.start[last] + words.length[last]
    span = (end - begin).astype(float)
    for k, table in enumerate(_CLASSES):
        sums = np.concatenate([[0], np.cumsum(table[texts.data], dtype=np.int64)])
        out[there, k] = (sums[end] - sums[begin]) / span
    k = len(_CLASSES)
    data = texts.data
    odd_end = (_MARK & ~_USUAL)[data[words.start + words.length - 1]]
    repeat = np.zeros(n, dtype=bool)
    repeat[1:] = (words.hash[1:] == words.hash[:-1]) & (row[1:] == row[:-1])
    sums = lambda x: np.add.reduceat(x.astype(float), first)
    out[there, k] = sums(odd_end) / size
    out[there, k + 1] = sums(repeat) / size
    out[there, k + 2] = sums(words.length) / size / 10
    out[there, k + 3] = sums(words.length == 1) / size
    key = mix(words.hash + passage.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, example = np.unique(key, return_index=True)
    out[there, k + 4] = np.bincount(passage[example], minlength=total)[there] / size
    # Words that the text has had in an earlier passage.
    in_row = mix(words.hash + row.astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
    _, earliest, which = np.unique(in_row, return_index=True, return_inverse=True)
    out[there, k + 5] = sums(passage[earliest][which] < passage) / size
    out[there, k + 6] = np.log1p(size) / 5
    return out, bounds


@dataclass(frozen=True)
class QualityModel:
    """Weights by name; ``mean`` and ``scale`` of the features come first. Not ``fitted`` on one label only."""

    weights: dict[str, np.ndarray]
    fitted: bool = True

    def encode(self, features: np.ndarray):
        w = self.weights
        x = np.clip((features - w["mean"]) / w["scale"], -8, 8)
        hidden = np.tanh(x @ w["W"] + w["b"])
        t, s = np.tanh(hidden @ w["V"]), 1 / (1 + np.exp(-(hidden @ w["U"])))
        return x, hidden, t, s, (t * s) @ w["a"]

    def attend(self, energy: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Weights of the passages, which add up to 1 for each row."""
        first, sizes = bounds[:-1], np.diff(bounds)
        weight = np.exp(energy - np.repeat(np.maximum.reduceat(energy, first), sizes))
        return weight / np.repeat(np.add.reduceat(weight, first), sizes)

    def score(self, features: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Score of each row, and the attention of its passages."""
        _, hidden, _, _, energy = self.encode(features)
        attention = self.attend(energy, bounds)
        bag = np.add.reduceat(hidden * attention[:, None], bounds[:-1], axis=0)
        return 1 / (1 + np.exp(-np.clip(bag @ self.weights["c"] + self.weights["d"][0], -500, 500))), attention


def fit_bags(features: np.ndarray, bounds: np.ndarray, labels: np.ndarray, seed: int = 7) -> QualityModel:
    """Fit by stochastic gradient steps (Adam) on bags; needs at least one bag."""
    rng = np.random.default_rng(seed)
    width = features.shape[1]
    scale = features.std(axis=0)
    w = {
        "mean": features.mean(axis=0),
        "scale": np.where(scale > 1e-6, scale, 1.0),
        "W": rng.normal(0, width**-0.5, (width, HIDDEN)),
        "b": np.zeros(HIDDEN),
        "V": rng.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)),
        "U": rng.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)),
        "a": rng.normal(0, GATE**-0.5, GATE),
        "c": rng.normal(0, HIDDEN**-0.5, HIDDEN),
        "d": np.zeros(1),
    }
    learned = [k for k in w if k not in ("mean", "scale")]
    m1, m2 = ({k: np.zeros_like(w[k]) for k in learned} for _ in range(2))
    step, sizes = 0, np.diff(bounds)
    for epoch in range(EPOCHS):
        order = rng.permutation(len(labels))
        for chunk in np.array_split(order, max(1, len(order) // BATCH)):
            own = np.concatenate([np.arange(bounds[i], bounds[i + 1]) for i in chunk])
            cut = np.concatenate([[0], np.cumsum(sizes[chunk])])
            gradient = _gradient(QualityModel(w), features[own], cut, labels[chunk])
            step += 1
            for k in learned:
                g = gradient[k] + DECAY * w[k]
                m1[k] = 0.9 * m1[k] + 0.1 * g
                m2[k] = 0.999 * m2[k] + 0.001 * g * g
                rate = RATE * (1 - epoch / EPOCHS)
                w[k] = w[k] - rate * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.999**step)) + 1e-8)
    return QualityModel(w)


def _gradient(model: QualityModel, features: np.ndarray, bounds: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
    """Gradient of the mean log loss of the bags."""
    w = model.weights
    sizes = np.diff(bounds)
    x, hidden, t, s, energy = model.encode(features)
    attention = model.attend(energy, bounds)
    bag = np.add.reduceat(hidden * attention[:, None], bounds[:-1], axis=0)
    score = 1 / (1 + np.exp(-np.clip(bag @ w["c"] + w["d"][0], -500, 500)))
    error = (score - labels) / len(labels)
    to_bag = np.repeat(error, sizes)[:, None] * w["c"][None, :]
    by_attention = (to_bag * hidden).sum(axis=1)
    mean = np.repeat(np.add.reduceat(by_attention * attention, bounds[:-1]), sizes)
    to_energy = attention * (by_attention - mean)
    gate = to_energy[:, None] * w["a"][None, :]
    to_t, to_s = gate * s * (1 - t * t), gate * t * s * (1 - s)
    to_hidden = to_bag * attention[:, None] + to_t @ w["V"].T + to_s @ w["U"].T
    inner = to_hidden * (1 - hidden * hidden)
    return {
        "W": x.T @ inner,
        "b": inner.sum(axis=0),
        "V": hidden.T @ to_t,
        "U": hidden.T @ to_s,
        "a": (t * s).T @ to_energy,
        "c": bag.T @ error,
        "d": np.array([error.sum()]),
    }


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
) -> QualityModel | None:
    """Fit on at most about ``sample_rows`` documents per label, by all passages of whole texts.

    ``labels`` has ids and labels 0 or 1; see ``labelled_sample``. None without any labelled text.
    """
    prepare(docs.sparkSession)
    rows = labelled_sample(docs, labels, id_column, text_column, label_column, sample_rows)

    def describe(batches):
        for batch, texts in slices(batches, "text"):
            features, bounds = passage_features(texts)
            flat = pa.ListArray.from_arrays(
                pa.array(bounds * FEATURES, pa.int32()), pa.array(features.astype(np.float32).ravel())
            )
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(0), flat], names=["label", "id", "features"])

    kind = docs.schema[id_column].dataType.simpleString()
    sample = rows.mapInArrow(describe, f"label int, id {kind}, features array<float>").toPandas()
    if not len(sample):
        return None
    # The same order whatever the partitioning, as the steps of the fit depend on it.
    sample = sample.assign(size=sample["features"].map(len)).sort_values(["id", "label", "size"], kind="stable")
    sizes = np.array([len(f) // FEATURES for f in sample["features"]])
    features = np.concatenate([np.asarray(f, dtype=float) for f in sample["features"]]).reshape(-1, FEATURES)
    model = fit_bags(features, np.concatenate([[0], np.cumsum(sizes)]), sample["label"].to_numpy(dtype=float))
    return replace(model, fitted=sample["label"].nunique() > 1)


def score_quality(
    docs: DataFrame,
    model: QualityModel | None,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Per row: its id, ``score`` (0 to 1, from all passages), ``passages``, ``attended`` (the passage with most
    weight), and the columns named in ``keep``.

    Null, empty and blank texts are one empty passage. Without a model every score is 0.5. Ids may be null or
    repeat; other columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(model)

    def score(batches):
        m = shared.value
        for batch, texts in slices(batches, "text"):
            features, bounds = passage_features(texts)
            if m is None:
                value, attention = np.full(len(texts), 0.5), np.ones(len(features))
            else:
                value, attention = m.score(features, bounds)
            most = [int(np.argmax(attention[a:b])) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            found = {"score": value, "passages": np.diff(bounds), "attended": np.array(most, dtype=np.int64)}
            yield with_kept(batch, {k: pa.array(v) for k, v in found.items()})

    return scored_rows(docs, score, "score double, passages long, attended long", id_column, text_column, keep)
