"""What the jobs of this package share: workers that can import it, intermediate tables, id filters."""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapwise.session import new_table_path

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

FILTER_BITS = 1 << 26

#: What a worker holds at a time of the rows it is sent, unless the session says otherwise. Texts may be long, so rows
#: alone bound nothing; a single longer row is a batch of its own.
ARROW_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 * 1024 * 1024),
}
#: For the C library of a worker: arrays from 1 MB go back to the system when they are freed. By default the bound rises
#: up to 32 MB with every such array, and what is freed stays with the worker, from task to task.
ALLOCATOR = {"MALLOC_MMAP_THRESHOLD_": str(1024 * 1024), "MALLOC_TRIM_THRESHOLD_": str(8 * 1024 * 1024), "MALLOC_ARENA_MAX": "2"}


def prepare(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, and bound what they hold."""
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([_ROOT, *paths])
    for name, value in ALLOCATOR.items():
        environment.setdefault(name, value)
    for name, value in ARROW_SETTINGS.items():
        if spark.conf.get(name, None) is None:
            spark.conf.set(name, value)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = new_table_path(df.sparkSession, name)
    df.write.mode("error").parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back._written_to = path
    return back


def discard(*tables: DataFrame) -> None:
    """Remove tables of ``written``. Only for tables whose every use has been written since, as lost work that
    reads them could not be done again."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table._written_to)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def id_filter(ids: DataFrame, column: str, bits: int = FILTER_BITS) -> np.ndarray:
    """Bitmap of hashed ids, of a fixed size whatever their number (8 MB).

    Ids that are in the table always pass; others pass more often the more ids there are. It only saves
    shuffling, never decides a result.
    """
    place = F.pmod(F.xxhash64(column), F.lit(bits))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(64)).cast("int"))
    blocks = (
        ids.select(F.call_function("shiftright", place, F.lit(6)).alias("word"), bit.alias("bit"))
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
        .toPandas()
    )
    bitmap = np.zeros(bits // 64, dtype=np.uint64)
    bitmap[blocks["word"].to_numpy(dtype=np.int64)] = blocks["bits"].to_numpy(dtype=np.int64).view(np.uint64)
    return bitmap


def passing(df: DataFrame, column: str, shared, inside: bool = True) -> DataFrame:
    """Rows whose id passes the bitmap (a broadcast), or (not ``inside``) those that surely are not in it."""
    prepare(df.sparkSession)
    bits = len(shared.value) * 64

    def keep(batches):
        for batch in batches:
            place = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False).astype(np.int64)
            hit = (shared.value[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1)
            kept = batch.filter(pa.array(hit.astype(bool) == inside))
            yield kept.select(list(range(batch.num_columns - 1)))

    placed = df.withColumn("_place", F.pmod(F.xxhash64(column), F.lit(bits)))
    return placed.mapInArrow(keep, df.schema)


def without_ids(df: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """Rows of ``df`` whose id is not in ``ids``; rows without id stay. Only rows that may go are shuffled."""
    ids = written(ids.select(column).where(F.col(column).isNotNull()).distinct(), "ids")
    bitmap = df.sparkSession.sparkContext.broadcast(id_filter(ids, column))
    unsure = passing(df, column, bitmap).join(ids, column, "left_anti").select(*df.columns)
    return passing(df, column, bitmap, inside=False).unionAll(unsure)


def scored_rows(docs: DataFrame, score, schema: str, id_column: str, text_column: str, keep=()) -> DataFrame:
    """Run ``score`` over batches of (id, text, kept columns); the result has the id, ``schema`` and the kept columns.

    Columns travel under names of this package, so that those of ``docs`` may be called anything.
    """
    kept = [F.col(c).alias(f"_keep{i}") for i, c in enumerate(keep)]
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"), *kept)
    kind = docs.schema[id_column].dataType.simpleString()
    extra = "".join(f", _keep{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep))
    names = {"id": id_column} | {f"_keep{i}": c for i, c in enumerate(keep)}
    return rows.mapInArrow(score, f"id {kind}, {schema}{extra}").withColumnsRenamed(names)


def with_kept(batch: pa.RecordBatch, found: dict[str, pa.Array]) -> pa.RecordBatch:
    """The id of each row of a batch, what was found for it, and its kept columns."""
    kept = {n: batch.column(i) for i, n in enumerate(batch.schema.names) if n.startswith("_keep")}
    return pa.RecordBatch.from_pydict({"id": batch.column(0), **found, **kept})
