"""Spark session and shared-folder settings."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import SparkSession

Result = TypeVar("Result")

SETTINGS = {
    # Timestamps without an offset are UTC throughout.
    "spark.sql.session.timeZone": "UTC",
    # Malformed casts raise instead of turning into nulls.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split skewed partitions even where the next join then has to shuffle again.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Rows shuffled by (session, driver) need no second shuffle to be joined by (session, driver, lap).
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Rewriting one session must not delete the others.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}


# Shuffled data per task, and the bounds within which the number of tasks follows the size of the data.
TASK_BYTES = 128 * 1024**2
MIN_TASKS, MAX_TASKS = 200, 100_000


def shuffle_tasks(data_bytes: int) -> int:
    """Shuffle partitions to start from; adaptive execution merges them, but never adds any."""
    return max(MIN_TASKS, min(MAX_TASKS, -(-data_bytes // TASK_BYTES)))


def get_spark(
    app_name: str = "lapwise", master: str | None = None, data_bytes: int | None = None, **settings: str
) -> SparkSession:
    """Session with the settings the operators were written for; ``settings`` win over them.

    ``data_bytes`` is the size of the largest table to be shuffled. Without it the number of shuffle
    partitions stays Spark's own, which suits some tens of gigabytes.
    """
    sized = {"spark.sql.shuffle.partitions": str(shuffle_tasks(data_bytes))} if data_bytes else {}
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **sized, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, for written intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. A temporary folder is used only in local mode,
    where driver and executors are one machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        folder = os.path.join(tempfile.gettempdir(), "lapwise-shared")
        spark.conf.set("spark.checkpoint.dir", folder)
        return folder
    raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")


def new_table_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else writes to."""
    return f"{shared_folder(spark)}/lapwise/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def together(jobs: Mapping[str, Callable[[], Result]]) -> dict[str, Result]:
    """Run independent jobs at the same time, so that small ones fill the cores large ones leave idle.

    All run to their end; then the error of the first that failed is raised, if any did.
    """
    with ThreadPoolExecutor(max_workers=max(len(jobs), 1)) as pool:
        running = {name: pool.submit(job) for name, job in jobs.items()}
    return {name: job.result() for name, job in running.items()}
