"""Bounded samples of labelled rows to fit classifiers on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def remainder(id_column: str, divisor: int):
    """crc32 of the id as text, modulo ``divisor``; null without id."""
    return F.pmod(F.crc32(F.col(id_column).cast("string").cast("binary")), F.lit(divisor))


def bounded_sample(rows: DataFrame, label: str, bound: int, order: str) -> DataFrame:
    """About ``bound`` rows of each label at most, chosen by the hash of ``order`` (an id); all rows if fewer.

    Labels are few. Choosing by hash makes the sample the same at every run and partitioning.
    """
    sizes = rows.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()
    place = F.pmod(F.xxhash64(order), F.lit(1_000_003))
    keep = F.lit(False)
    for size in sizes:
        share = min(1.0, bound / size["n"])
        keep = keep | (F.col(label).eqNullSafe(F.lit(size[label])) & (place < F.lit(int(share * 1_000_003) + 1)))
    return rows.where(keep)


def labelled_sample(docs: DataFrame, labels: DataFrame, id_column: str, text_column: str, label: str, bound: int) -> DataFrame:
    """(id, label, text) of about ``bound`` documents of each label 0 and 1.

    Chosen from the labels alone, so that no more than the sample is ever joined with texts; a table of that size
    is broadcast. An id that is labelled several times counts with its highest label; other labels, rows
    without id or label, and null texts are left out.
    """
    wanted = labels.select(F.col(id_column).alias("id"), F.col(label).cast("int").alias("label"))
    wanted = wanted.where("id IS NOT NULL AND label IN (0, 1)").groupBy("id").agg(F.max("label").alias("label"))
    chosen = F.broadcast(bounded_sample(wanted, "label", bound, "id"))
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).where("text IS NOT NULL")
    return texts.join(chosen, "id").select("id", "label", "text")
