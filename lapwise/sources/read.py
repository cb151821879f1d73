"""Readers for landed JSON and processed Parquet."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_records(
    spark: SparkSession, path: str | list[str], schema: T.StructType | None, multi_line: bool = True
) -> DataFrame:
    """Flat JSON records: files holding one array each, or, with ``multi_line=False``, one record per line.

    Unparsable input raises. Without a schema all columns found are kept, which costs a pass over the files.
    Files with one array are read by one task each; records landed by ``land_once`` are split freely.
    """
    reader = spark.read.option("multiLine", multi_line).option("mode", "FAILFAST")
    return (reader.schema(schema) if schema else reader).json(path)


def read_parallel_arrays(
    spark: SparkSession, path: str | list[str], schema: T.StructType, field: str, multi_line: bool = True
) -> DataFrame:
    """JSON documents holding a struct of equally long arrays, as one row per array index.

    One document per file or, with ``multi_line=False``, per line.
    """
    documents = read_records(spark, path, schema, multi_line)
    return inline_arrays(documents.select(f"{field}.*"), *schema[field].dataType.fieldNames())


def inline_arrays(df: DataFrame, *arrays: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per index of the parallel array columns, next to the kept columns.

    An array that is missing altogether yields nulls; arrays of unequal length raise.
    """
    longest = F.greatest(F.lit(0), *[F.size(a) for a in arrays])
    unequal = F.lit(False)
    for name in arrays:
        unequal = unequal | F.coalesce(F.size(name) != longest, F.lit(False))
    present = [F.coalesce(F.col(a), F.array().cast(df.schema[a].dataType)).alias(a) for a in arrays]
    zipped = F.arrays_zip(*arrays)
    rows = df.select(*keep, *present, unequal.alias("_unequal"))
    checked = F.when(F.col("_unequal"), F.raise_error(F.lit("parallel arrays of unequal length"))).otherwise(zipped)
    return rows.select(*keep, F.inline(checked))


# Text formats that keep microseconds, which the default CSV and JSON formats drop.
TIME_FORMATS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


# CSV as RFC 4180 and most readers have it, with null told apart from empty text.
CSV_FORMAT = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "lineSep": "\n",
    "emptyValue": '""',
    "nullValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """CSV with header lines as ``write.export_csv`` makes it.

    Where the schema has text, which may hold line breaks, a file is read by one task; other files are split.
    """
    text = any(isinstance(f.dataType, T.StringType) for f in schema.fields)
    options = {k: v for k, v in CSV_FORMAT.items() if not (text and k == "lineSep")}
    # Fields without quotes or content are read as this mark of null, so that "" stays an empty text.
    options |= {"emptyValue": "", "nullValue": "\0null", "multiLine": str(text)}
    return spark.read.schema(schema).options(**TIME_FORMATS, **options).option("mode", "FAILFAST").csv(path)


def landing_state(spark: SparkSession, path: str) -> str:
    """``missing``, ``empty`` (nothing in it), ``unfinished`` (left by a lost job) or ``landed``.

    Looks at what lies directly in the folder, however many files there are below.
    """
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(where):
        return "missing"
    if system.getFileStatus(where).isFile():
        return "landed"
    names = {entry.getPath().getName() for entry in system.listStatus(where)}
    if "_SUCCESS" in names:
        return "landed"
    if "_temporary" in names:
        return "unfinished"
    return "landed" if any(not n.startswith((".", "_")) for n in names) else "empty"


def fingerprint(spark: SparkSession, path: str) -> str:
    """Text that changes when files of a table do: from what one listing says of the path and what lies directly in it.

    Folders in it count by the time of their last change, so files that change further down are not seen.
    """
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark._jsc.hadoopConfiguration())
    # As one text, so that the number of calls does not go with the number of files.
    listed = f"{system.getFileStatus(where).toString()} {spark._jvm.org.apache.commons.lang3.ArrayUtils.toString(system.listStatus(where))}"
    return hashlib.sha256(re.sub(r"access_time=\d+", "", listed).encode()).hexdigest()


def read_parquet(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Processed Parquet; columns and filters are pushed into the scan."""
    return spark.read.parquet(*([path] if isinstance(path, str) else path))


def register_tables(
    spark: SparkSession,
    files: Mapping[str, str],
    save: bool = False,
    folder: str | None = None,
    bucket_by: Mapping[str, Sequence[str]] | None = None,
    buckets: int = 200,
) -> None:
    """Make each Parquet path available to SQL by name, replacing what had the name before.

    Views by default; ``save`` copies the data into tables, in ``folder`` if given, else in the warehouse. Tables named
    in ``bucket_by`` are saved in ``buckets`` buckets of these columns, one sorted file each: tables with as many buckets
    are joined and grouped by them without a shuffle. A key lies in one bucket, however often it occurs; choose columns
    whose values are many.
    """
    bucket_by = bucket_by or {}
    if bucket_by and not save:
        raise ValueError("only saved tables have buckets")
    for name, path in files.items():
        df = read_parquet(spark, path)
        if not save:
            df.createOrReplaceTempView(name)
            continue
        columns = list(bucket_by.get(name, ()))
        if columns:
            # Rows are dealt to tasks as they are to buckets, so that each task writes the one file of its own.
            df = df.repartition(buckets, *columns)
        writer = df.write.mode("overwrite")
        if columns:
            writer = writer.bucketBy(buckets, *columns).sortBy(*columns)
        (writer.option("path", f"{folder}/{name}") if folder else writer).saveAsTable(name)
