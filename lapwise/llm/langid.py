"""Language identification: multinomial naive Bayes over hashed character n-grams.

Fitting counts n-grams per language in tasks that each hand on one vector of counts per language; the sum is a
matrix of fixed size. Scoring broadcasts the matrix of log probabilities (languages x buckets) and multiplies it
with the sparse counts of a batch.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapwise.llm.jobs import prepare
from lapwise.llm.samples import bounded_sample
from lapwise.llm.texts import SLICE_BYTES, Texts, slices

UNKNOWN = "und"
#: Letters and numerals such as "²" or "Ⅷ".
_LETTER_OR_NUMERAL = re.compile(r"[^\W\d_]")
WIDTHS = (1, 2, 3)
BUCKETS = 1 << 14
#: Labelled rows per language the model is fitted on.
SAMPLE_ROWS = 20_000
SMOOTHING = 0.5
#: In place of a bucket: the number of rows.
ROWS = -1

_MIX = np.uint64(0x9E3779B97F4A7C15)


def has_letter(text: str) -> bool:
    return any(m.group().isalpha() for m in _LETTER_OR_NUMERAL.finditer(text))


@dataclass(frozen=True)
class LanguageModel:
    """Languages in order, their log priors, and log probabilities of each bucket (languages x buckets)."""

    languages: tuple[str, ...]
    prior: np.ndarray
    weights: np.ndarray
    widths: tuple[int, ...] = WIDTHS

    @property
    def buckets(self) -> int:
        return self.weights.shape[1]


def character_codes(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all rows, in lower case and with everything but letters as one space, and row bounds."""
    decoded = [texts.raw(i).decode("utf-8", "replace").lower() for i in range(len(texts))]
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in decoded], dtype=np.int64)])
    codes = np.frombuffer("".join(decoded).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).copy()
    other = codes < 128
    other &= ~((codes >= 97) & (codes <= 122))
    codes[other] = 32
    return codes, bounds


def gram_counts(texts: Texts, buckets: int, widths: tuple[int, ...] = WIDTHS):
    """Sparse counts as (row, bucket, count) of the hashed character n-grams that hold a letter or begin or end a word.

    N-grams never span rows; runs of spaces count once.
    """
    codes, bounds = character_codes(texts)
    if not len(codes):
        return (np.zeros(0, dtype=np.int64),) * 3
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    blank = codes == 32
    repeated = np.zeros(len(codes), dtype=bool)
    repeated[1:] = blank[1:] & blank[:-1] & (row[1:] == row[:-1])
    codes, row, blank = codes[~repeated], row[~repeated], blank[~repeated]
    keys = []
    for width in widths:
        n = len(codes) - width + 1
        if n <= 0:
            continue
        value = np.full(n, width, dtype=np.uint64)
        for k in range(width):
            value = (value ^ codes[k : k + n]) * _MIX
            value ^= value >> np.uint64(29)
        ok = row[:n] == row[width - 1 : width - 1 + n]
        if width == 1:
            ok &= ~blank
        keys.append((row[:n] * buckets + (value % np.uint64(buckets)).astype(np.int64))[ok])
    every = np.concatenate(keys) if keys else np.zeros(0, dtype=np.int64)
    if len(texts) * buckets <= 1 << 21:
        dense = np.bincount(every, minlength=0)
        cells = np.flatnonzero(dense)
        return cells // buckets, cells % buckets, dense[cells]
    cells, count = np.unique(every, return_counts=True)
    return cells // buckets, cells % buckets, count


def fit_language_model(
    docs: DataFrame,
    text_column: str = "text",
    language_column: str = "lang",
    order_column: str = "doc_id",
    buckets: int = BUCKETS,
    widths: tuple[int, ...] = WIDTHS,
    sample_rows: int = SAMPLE_ROWS,
) -> LanguageModel:
    """Fit on at most about ``sample_rows`` rows per language, by whole texts; null texts and languages are left out."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(language_column).alias("lang"), F.col(text_column).alias("text"), F.col(order_column).alias("id"))
    rows = bounded_sample(rows.where("lang IS NOT NULL AND text IS NOT NULL"), "lang", sample_rows, "id")

    def count(batches):
        total: dict[str, np.ndarray] = {}
        rows_seen: dict[str, int] = {}
        for batch, texts in slices(batches, "text"):
            langs = batch.column(0).to_pylist()
            row, bucket, times = gram_counts(texts, buckets, widths)
            for lang in set(langs):
                own = np.array([x == lang for x in langs])
                mine = own[row]
                total[lang] = total.get(lang, 0) + np.bincount(bucket[mine], weights=times[mine], minlength=buckets)
                rows_seen[lang] = rows_seen.get(lang, 0) + int(own.sum())
        for lang, counts in total.items():
            # Rows are counted beside the buckets, under a number that is none.
            found = np.flatnonzero(counts)
            bucket, times = np.append(found, ROWS), np.append(counts[found], rows_seen[lang]).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(bucket)), pa.array(bucket), pa.array(times)], names=["lang", "bucket", "times"])

    partial = rows.mapInArrow(count, "lang string, bucket long, times long")
    sums = partial.groupBy("lang", "bucket").agg(F.sum("times").alias("times")).toPandas()
    seen, sums = sums[sums["bucket"] == ROWS], sums[sums["bucket"] != ROWS]
    languages = tuple(sorted(seen["lang"]))
    place = {lang: i for i, lang in enumerate(languages)}
    counts = np.full((len(languages), buckets), SMOOTHING)
    prior = np.zeros(len(languages))
    for lang, n in zip(seen["lang"], seen["times"], strict=True):
        prior[place[lang]] = n
    if len(languages):
        np.add.at(counts, ([place[x] for x in sums["lang"]], sums["bucket"].to_numpy(dtype=np.int64)), sums["times"].to_numpy(dtype=float))
        prior = np.log(prior / prior.sum())
    return LanguageModel(languages, prior, np.log(counts / counts.sum(axis=1, keepdims=True)), widths)


def identify_language(
    docs: DataFrame, model: LanguageModel, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Per row: its id, ``lang_pred`` and ``score`` (its posterior, 0 to 1), from the whole text.

    Null texts, texts without a letter, and all texts under a model without languages are ``und`` with score 0.
    Ties go to the language first by name. Ids may be null or repeat; other columns are ignored; an empty table
    gives an empty result.
    """
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_column].dataType.simpleString()

    def score(batches):
        m = shared.value
        for batch, texts in slices(batches, "text", SLICE_BYTES):
            n = len(texts)
            lang, best = [UNKNOWN] * n, np.zeros(n)
            if m.languages:
                row, bucket, times = gram_counts(texts, m.buckets, m.widths)
                logs = np.tile(m.prior, (n, 1))
                for k in range(len(m.languages)):
                    logs[:, k] += np.bincount(row, weights=times * m.weights[k, bucket], minlength=n)
                chosen = logs.argmax(axis=1)
                posterior = 1 / np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1)
                for i in range(n):
                    if has_letter(texts.raw(i).decode("utf-8", "replace")):
                        lang[i], best[i] = m.languages[chosen[i]], posterior[i]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang), pa.array(best)], names=["id", "lang_pred", "score"])

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(score, f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_column)
