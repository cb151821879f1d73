"""Loads that rebuild only the sessions whose landed files changed.

Landed records lie in a folder per session, as ``land_once`` with ``partition_by`` leaves them. A manifest of these
files is kept with the tables. A load lists the files, without opening any, and parses those of sessions that differ
from the manifest; the mart of a session is rebuilt if any of its datasets changed, from the tables in use for the rest.

Every folder is listed through the driver several times a load, which is meant for thousands of them. Where sessions are
more, ``Blocks`` of sessions have a folder each, and what is said of sessions here holds for blocks.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapwise.plans import clean, mart
from lapwise.plans.pipeline import DATASETS, read_records, stage_table
from lapwise.session import together
from lapwise.sources.write import claimed, discard, exists, materialise, partition_folders, publish

SESSION = "session_key"
INPUTS = ("drivers", "laps", "stints", "pit_stops", "circuit_weather", "race_control")


@dataclass(frozen=True)
class Blocks:
    """What has a folder of its own: the column that names the folders, and its whole number for a session."""

    column: str
    number: Column

    @property
    def manifest(self) -> str:
        return f"dataset string, {self.column} long, files long, bytes long, state long"

    @property
    def changes(self) -> str:
        return f"dataset string, {self.column} long, change string"

    def tag(self, df: DataFrame) -> DataFrame:
        """Add the folders' column to rows that have a session."""
        return df if self.column == SESSION else df.withColumn(self.column, self.number.cast("long"))

    def checked(self, records: DataFrame) -> DataFrame:
        """Landed records, which raise when they are read if they lie in a folder that is not that of their session."""
        if self.column == SESSION:
            return records
        own = F.col(self.column).cast("long").eqNullSafe(self.number.cast("long"))
        misplaced = F.concat(F.lit(f"not in its folder of {self.column}: session "), F.col(SESSION).cast("string"))
        misplaced = F.raise_error(F.coalesce(misplaced, F.lit("landed records without a session"))).cast("long")
        return records.withColumn(SESSION, F.when(own, F.col(SESSION)).otherwise(misplaced))


def per_session() -> Blocks:
    return Blocks(SESSION, F.col(SESSION))


def landed_files(spark: SparkSession, raw: Mapping[str, str], blocks: Blocks | None = None) -> DataFrame:
    """Per dataset and session (or block): number and bytes of its files, and a number that changes when one of them does.

    Files count by name, length and time of change; their content is not read. A dataset without files has no rows.
    """
    blocks = blocks or per_session()
    by = blocks.column
    listed = spark.createDataFrame([], blocks.manifest)
    for dataset, path in raw.items():
        files = spark.read.format("binaryFile").load(path)
        if by not in files.columns:
            if not files.isEmpty():
                raise ValueError(f"{path}: landed files have to lie in a folder per session or block of them ({by})")
            continue
        own = F.xxhash64(F.element_at(F.split("path", "/"), -1), "length", "modificationTime")
        counted = files.groupBy(F.col(by).cast("long").alias(by)).agg(
            F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.bit_xor(own).alias("state")
        )
        listed = listed.unionByName(counted.withColumn("dataset", F.lit(dataset)))
    return listed


def changes(now: DataFrame, before: DataFrame, by: str = SESSION) -> DataFrame:
    """Datasets and sessions whose files are ``new``, ``changed`` or ``gone`` since the manifest before."""
    figures = ("files", "bytes", "state")
    key = ["dataset", by]
    now = now.select(*key, F.struct(*figures).alias("now"))
    before = before.select(*key, F.struct(*figures).alias("before"))
    change = F.when(F.col("before").isNull(), "new").when(F.col("now").isNull(), "gone").otherwise("changed")
    differing = now.join(before, key, "full_outer").where(~F.col("now").eqNullSafe(F.col("before")))
    return differing.select(*key, change.alias("change"))


def load(
    spark: SparkSession, raw: Mapping[str, str], folder: str, multi_line: bool = False, blocks: Blocks | None = None
) -> DataFrame:
    """Bring the processed tables and the mart in ``folder`` up to the landed files; return what had changed.

    ``raw`` maps each of ``INPUTS`` to its landed folder. All changed sessions are cleaned, gated and joined beside the
    tables in use. If a gate fails it raises and nothing is changed. Else the folders of these sessions take the place
    of those in use and, last, the manifest is replaced: a load that is lost on the way is done again by the next, with
    the same result. Sessions without records any more are removed. One load at a time is let in.

    One row per dataset and changed session comes to the driver: meant, as the folders are, for thousands of sessions.
    With ``blocks`` landed files and tables have a folder per block of sessions, and blocks are what changes and is
    replaced. All loads into a folder have to be given the same ones.
    """
    missing = set(INPUTS) - set(raw)
    if missing:
        raise ValueError(f"no landed folder of {', '.join(sorted(missing))}")
    folder = folder.rstrip("/")
    stage = f"{folder}-staged-{uuid.uuid4().hex}"
    with claimed(spark, folder):
        try:
            return _load(spark, {d: raw[d] for d in INPUTS}, folder, stage, multi_line, blocks or per_session())
        finally:
            discard(spark, stage)


def _load(
    spark: SparkSession, raw: Mapping[str, str], folder: str, stage: str, multi_line: bool, blocks: Blocks
) -> DataFrame:
    by, kept = blocks.column, f"{folder}/manifest"
    now = materialise(landed_files(spark, raw, blocks), f"{stage}/manifest")
    if exists(spark, kept):
        before = spark.read.parquet(kept)
        if by not in before.columns:
            raise ValueError(f"{folder} was loaded by other blocks than {by}")
    else:
        before = spark.createDataFrame([], blocks.manifest)
    rows = [tuple(r) for r in changes(now, before, by).orderBy("dataset", by).collect()]
    if any(number is None for _, number, _ in rows):
        raise ValueError("landed records without a session")
    if not rows:
        return spark.createDataFrame([], blocks.changes)
    # Numbers of the changed folders: sessions, or blocks of them.
    changed = {dataset: [n for d, n, _ in rows if d == dataset] for dataset in raw}
    changed["race_status"] = changed["race_control"]
    numbers = sorted({number for _, number, _ in rows})

    def staged_table(dataset: str) -> DataFrame:
        schema, cleaned = DATASETS[dataset]
        # A filter on the folders' column: files of other sessions are not opened.
        records = read_records(spark, raw[dataset], schema, multi_line).where(F.col(by).isin(changed[dataset]))
        return stage_table(dataset, blocks.tag(cleaned(blocks.checked(records))), stage, [by], [by])[1]

    staged = together({dataset: partial(staged_table, dataset) for dataset in raw if changed[dataset]})
    if "race_control" in staged:
        status = blocks.tag(clean.race_status(staged["race_control"]))
        staged["race_status"] = stage_table("race_status", status, stage, [by], [by])[1]

    def after(dataset: str) -> DataFrame | None:
        """What the changed sessions will have of a dataset."""
        unchanged = sorted(set(numbers) - set(changed[dataset]))
        in_use = f"{folder}/{dataset}"
        if not unchanged or not exists(spark, in_use):
            return staged.get(dataset)
        own = spark.read.parquet(in_use)
        own = own.withColumn(by, F.col(by).cast("long")).where(F.col(by).isin(unchanged))
        return staged[dataset].unionByName(own) if dataset in staged else own

    tables = {dataset: after(dataset) for dataset in changed}
    absent = [dataset for dataset, df in tables.items() if df is None]
    if absent:
        raise ValueError(f"no landed records of {', '.join(absent)} at all")
    built = blocks.tag(mart.build_mart(tables))
    staged["lap_mart"] = stage_table("lap_mart", built, stage, [by], [by])[1]
    mart.check_grain(staged["lap_mart"])
    changed["lap_mart"] = numbers

    for dataset in staged:
        written = partition_folders(spark, f"{stage}/{dataset}")
        publish(spark, f"{stage}/{dataset}", f"{folder}/{dataset}", [by])
        for number in changed[dataset]:
            if f"{by}={number}" not in written:
                discard(spark, f"{folder}/{dataset}/{by}={number}")
    publish(spark, f"{stage}/manifest", kept)
    return spark.createDataFrame(rows, blocks.changes)


def loaded_mart(spark: SparkSession, folder: str) -> DataFrame:
    """The mart as the last load left it, a folder per session: reports on some sessions read only theirs."""
    df = spark.read.parquet(f"{folder.rstrip('/')}/lap_mart")
    return df.withColumn(SESSION, F.col(SESSION).cast("long")).select(*mart.MART_COLUMNS)
