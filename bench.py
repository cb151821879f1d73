"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the cores (default all). Every
query runs over its whole tables into a sink that discards rows, once to warm up and then BENCH_RUNS
times (default 3), of which the median counts.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lapwise.catalog import QUERIES, race  # noqa: E402
from lapwise.session import get_spark  # noqa: E402

HEADLINES = (
    "asof_left_join",
    "asof_tolerance_flag",
    "asof_single_key",
    "purchases_by_view_recency",
    "interval_overlap_flag",
    "range_join_few_ranges",
    "range_join_many_ranges",
    "next_ordinal_self_join",
    "equality_join_three_keys",
    "grouped_median_stats",
    "median_of_large_groups",
    "median_and_means_in_ranges",
    "filtered_counts",
    "composite_distinct",
    "grain_duplicates",
    "change_detection",
    "change_detection_single_key",
    "state_timeline",
    "state_timeline_single_key",
    "key_report_broken",
    "export_row_counts",
    "lap_mart",
    "lap_mart_summary",
    "pace_by_rainfall",
    "rainfall_changes",
    "strategy_by_stint",
    "compound_changes",
    "headline_figures",
)


def run(spark, name: str, sf_dir: str) -> float:
    if name == "lap_mart":
        race.forget_marts()  # time the whole build, not the reading of what was built before
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = get_spark(
        "bench",
        master=f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g")},
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINES:
        run(spark, name, sf_dir)
        seconds[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(runs)), 3)
    scale = re.search(r"sf([0-9.]+)$", sf_dir)
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(scale.group(1)) if scale else sf_dir,
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
