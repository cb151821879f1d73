"""The batch job from landed records to reports and exports."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from lapwise.plans import clean, mart
from lapwise.session import together
from lapwise.sources import schemas
from lapwise.sources.read import read_records, register_tables
from lapwise.sources.write import discard, export_counts, export_csv, export_parquet, materialise, publish, write_processed

# Dataset: schema of the landed records (None keeps all columns found) and cleaning function.
DATASETS = {
    "drivers": (schemas.DRIVERS, clean.clean_drivers),
    "laps": (schemas.LAPS, clean.clean_laps),
    "stints": (schemas.STINTS, clean.clean_stints),
    "pit_stops": (schemas.PIT_STOPS, clean.clean_pit_stops),
    "circuit_weather": (schemas.CIRCUIT_WEATHER, clean.clean_circuit_weather),
    "hourly_weather": (schemas.HOURLY_WEATHER, clean.clean_hourly_weather),
    "race_control": (schemas.RACE_CONTROL, clean.clean_race_control),
}


def process(
    spark: SparkSession,
    raw: Mapping[str, str],
    folder: str,
    keep_extra: bool = False,
    multi_line: bool = True,
    partition_by: Sequence[str] = (),
) -> dict[str, str]:
    """Clean each landed dataset, write it as Parquet and gate it; return the paths.

    ``raw`` maps datasets to their landed files. ``keep_extra`` keeps unknown circuit-weather columns. Landed records
    are parsed once: the job that writes a dataset, beside the tables in use, also counts what its gate asks for, and
    only uniqueness is looked up in what was written. If all gates hold, the new tables take the place of those in use;
    if one does not, it raises and these stay as they are.
    """

    def job(dataset: str) -> tuple[str, DataFrame]:
        schema, cleaned = DATASETS[dataset]
        if keep_extra and dataset == "circuit_weather":
            schema = None
        records = read_records(spark, raw[dataset], schema, multi_line)
        return stage_table(dataset, cleaned(records), stage, partition_by)

    # A folder beside, for this run alone.
    stage = f"{folder.rstrip('/')}-staged-{uuid.uuid4().hex}"
    staged: dict[str, tuple[str, DataFrame]] = {}
    try:
        staged = together({dataset: partial(job, dataset) for dataset in raw})
        if "race_control" in staged:
            status = clean.race_status(staged["race_control"][1])
            staged["race_status"] = stage_table("race_status", status, stage, partition_by)
    except Exception:
        discard(spark, stage)
        raise
    paths = {}
    for dataset, (path, df) in staged.items():
        paths[dataset] = f"{folder}/{dataset}"
        publish(spark, path, paths[dataset], partition_by if "session_key" in df.columns else [])
    discard(spark, stage)
    return paths


def stage_table(
    dataset: str,
    df: DataFrame,
    stage: str,
    partition_by: Sequence[str],
    cluster_by: Sequence[str] = ("session_key",),
) -> tuple[str, DataFrame]:
    """Write a dataset and hold what was written against its gate; its path and content."""
    path = f"{stage}/{dataset}"
    of_sessions = "session_key" in df.columns
    layout = (cluster_by, partition_by) if of_sessions else ((), ())
    metrics = write_processed(df, path, *layout, clean.gate_metrics(dataset))
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    clean.check_written(dataset, written, metrics)
    return path, written


def build(spark: SparkSession, paths: Mapping[str, str], folder: str) -> DataFrame:
    """Register the processed tables, write the mart, gate its grain and return it."""
    register_tables(spark, paths)
    tables = {dataset: spark.table(dataset) for dataset in paths}
    lap_mart = materialise(mart.build_mart(tables), f"{folder}/lap_mart")
    lap_mart.createOrReplaceTempView("lap_mart")
    return mart.check_grain(lap_mart)


def export(spark: SparkSession, lap_mart: DataFrame, folder: str) -> DataFrame:
    """Export the mart as Parquet and CSV; return the row counts of the mart and of both exports."""
    parquet_path, csv_path = f"{folder}/lap_mart.parquet", f"{folder}/lap_mart.csv"
    export_parquet(lap_mart, parquet_path)
    export_csv(lap_mart, csv_path)
    return export_counts(spark, lap_mart, parquet_path, csv_path)
