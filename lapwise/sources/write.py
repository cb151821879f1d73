"""Writers: raw landing, processed tables, the mart and its exports."""

from __future__ import annotations

import os
import time
import uuid
from collections.abc import Mapping, Sequence
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapwise.functions import interval_seconds, sort_nulls_last
from lapwise.sources.read import CSV_FORMAT, TIME_FORMATS, landing_state, read_csv


def land_once(df: DataFrame, path: str, partition_by: Sequence[str] = (), wait: float = 600.0) -> bool:
    """Write raw records as JSON unless the path already holds landed data; whether they were written.

    Landed is what a finished job marked, and a file or a folder of files that others put there. If it is landed
    nothing is computed. An empty folder, which a failed job leaves, is written to; what a job left behind that
    was lost while landing is not taken for landed data, but raises.

    Of several writers the one that makes the claim, a file beside the path, lands; the others wait for it, up to
    ``wait`` seconds, and land themselves if it fails. The claim of a lost process stays, and raises after the wait.
    """
    spark, deadline = df.sparkSession, time.monotonic() + wait
    folder, _, name = path.rstrip("/").rpartition("/")
    claim = f"{folder}/_claim-{name}" if folder else f"_claim-{name}"
    while landing_state(spark, path) != "landed":
        if _create_exclusive(spark, claim):
            try:
                return _land(df, path, partition_by)
            finally:
                _hadoop(spark, claim)[0].delete(_hadoop(spark, claim)[1], False)
        if time.monotonic() >= deadline:
            raise RuntimeError(f"{path} is being landed by another writer, or {claim} is left of a lost one")
        time.sleep(0.2)
    return False


def _land(df: DataFrame, path: str, partition_by: Sequence[str]) -> bool:
    # The writer before may have landed between the look and the claim.
    state = landing_state(df.sparkSession, path)
    if state == "unfinished":
        raise RuntimeError(f"{path} holds an unfinished landing; land elsewhere or clear it")
    if state == "landed":
        return False
    # An empty folder is there already.
    writer = df.write.options(**TIME_FORMATS).partitionBy(*partition_by)
    writer.mode("error" if state == "missing" else "append").json(path)
    return True


def _hadoop(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _create_exclusive(spark: SparkSession, path: str) -> bool:
    """Make an empty file; false if it is there. At once on local disks and file systems like HDFS.

    Object stores without conditional writes do not tell two writers of one moment apart.
    """
    system, where = _hadoop(spark, path)
    system.mkdirs(system.makeQualified(where).getParent())
    if system.getScheme() == "file":
        # The local file system of Hadoop looks first and creates then.
        try:
            os.close(os.open(system.makeQualified(where).toUri().getPath(), os.O_CREAT | os.O_EXCL))
        except FileExistsError:
            return False
        return True
    try:
        system.create(where, False).close()
    except Py4JJavaError:
        if system.exists(where):
            return False
        raise
    return True


@contextmanager
def claimed(spark: SparkSession, path: str):
    """Hold a claim on a path, a file beside it; raises if another writer holds it or a lost one left it."""
    folder, _, name = path.rstrip("/").rpartition("/")
    claim = f"{folder}/_claim-{name}" if folder else f"_claim-{name}"
    if not _create_exclusive(spark, claim):
        raise RuntimeError(f"{path} is being written by another writer, or {claim} is left of a lost one")
    try:
        yield
    finally:
        discard(spark, claim)


def write_processed(
    df: DataFrame,
    path: str,
    cluster_by: Sequence[str] = (),
    partition_by: Sequence[str] = (),
    metrics: Mapping[str, Column] | None = None,
) -> dict:
    """Replace processed Parquet; return the ``metrics`` (aggregates by name) over what the same job has written.

    ``cluster_by`` gathers rows with equal values into few files; sizes stay even, as oversized values are
    spread over several tasks. ``partition_by`` makes a folder per value and replaces only the folders of
    values present in ``df``: for thousands of sessions, not for millions.
    """
    gather = [*partition_by, *(c for c in cluster_by if c not in partition_by)]
    if gather:
        df = df.hint("rebalance", *gather)
    observation = Observation() if metrics else None
    if observation is not None:
        # On top of the shuffle, in the tasks that write: each of these counts once, however often others are repeated.
        df = df.observe(observation, *[aggregate.alias(name) for name, aggregate in metrics.items()])
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).parquet(path)
    return observation.get if observation is not None else {}


def publish(spark: SparkSession, staged: str, path: str, partition_by: Sequence[str] = ()) -> None:
    """Put a staged table in the place of the one at ``path``, or of its partitions that the staged one has.

    Folders are renamed, which file systems do at once and object stores by copying. No data is read.
    """
    java = spark._jvm.org.apache.hadoop.fs.Path
    source, target = java(staged), java(path)
    system = source.getFileSystem(spark._jsc.hadoopConfiguration())

    def replace(new, old) -> None:
        before = java(f"{old.getParent().toString()}/_replaced-{uuid.uuid4().hex}")
        if not system.exists(old.getParent()):
            system.mkdirs(old.getParent())
        if system.exists(old) and not system.rename(old, before):
            raise RuntimeError(f"{old} can not be replaced")
        if not system.rename(new, old):
            raise RuntimeError(f"{new} can not be moved to {old}")
        system.delete(before, True)

    if not partition_by:
        replace(source, target)
        return
    folders = [source]
    for _ in partition_by:
        folders = [e.getPath() for f in folders for e in system.listStatus(f) if e.isDirectory()]
    for folder in folders:
        within = folder.toUri().getPath()[len(source.toUri().getPath()) :]
        replace(folder, java(f"{path}{within}"))
    if not system.exists(target):
        system.mkdirs(target)
    system.delete(source, True)


def exists(spark: SparkSession, path: str) -> bool:
    system, where = _hadoop(spark, path)
    return system.exists(where)


def partition_folders(spark: SparkSession, path: str) -> set[str]:
    """Names of the folders that lie directly in a table written with a partition column."""
    system, where = _hadoop(spark, path)
    return {e.getPath().getName() for e in system.listStatus(where) if e.isDirectory()}


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def materialise(df: DataFrame, path: str) -> DataFrame:
    """Write a derived table and read it back, so that what follows does not compute it again."""
    write_processed(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def exportable(df: DataFrame) -> DataFrame:
    """Intervals as double seconds, which every reader of Parquet and CSV understands."""
    intervals = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DayTimeIntervalType)]
    return df.withColumns({name: interval_seconds(name) for name in intervals})


def export_parquet(df: DataFrame, path: str, order: Sequence[str] = ()) -> None:
    """With an ``order``, files follow one another by name in that order (``in_key_order``)."""
    df = in_key_order(df, order) if order else df
    exportable(df).write.mode("overwrite").parquet(path)


def export_csv(df: DataFrame, path: str, order: Sequence[str] = ()) -> None:
    """Comma-separated with a header line per file, as RFC 4180 has it.

    Quotes are doubled, text with commas, quotes or line breaks is quoted, an empty text is ``""`` and null nothing.
    With an ``order``, files follow one another by name in that order (``in_key_order``).
    """
    df = in_key_order(df, order) if order else df
    exportable(df).write.mode("overwrite").options(**TIME_FORMATS, **CSV_FORMAT).csv(path)


def in_key_order(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows sorted for files in key order: a leading ``-`` means descending, nulls last either way.

    Cut by ranges of the order, so that no task sorts it all; further columns that can be sorted break ties, and with
    that a range is never one key alone unless whole rows repeat. Files written from it follow one another by name.
    """
    named = {c.removeprefix("-") for c in order}
    ties = [f.name for f in df.schema.fields if f.name not in named and _sortable(f.dataType)]
    return sort_nulls_last(df, *order, *ties)


def _sortable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_sortable(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _sortable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def files_in_order(spark: SparkSession, path: str, suffix: str) -> list[str]:
    """Files of an export by name, which is the order of their rows where it was written in order."""
    system, where = _hadoop(spark, path)
    names = sorted(e.getPath().getName() for e in system.listStatus(where) if e.isFile())
    return [f"{path.rstrip('/')}/{name}" for name in names if name.endswith(suffix) and not name.startswith(("_", "."))]


def export_counts(spark: SparkSession, df: DataFrame, parquet_path: str, csv_path: str) -> DataFrame:
    """One row: number of rows of the table and of both exports read back."""
    csv = read_csv(spark, csv_path, exportable(df).schema)
    return (
        df.agg(F.count(F.lit(1)).alias("table_rows"))
        .withColumn("parquet_rows", spark.read.parquet(parquet_path).agg(F.count(F.lit(1))).scalar())
        .withColumn("csv_rows", csv.agg(F.count(F.lit(1))).scalar())
    )
