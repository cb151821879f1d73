"""Run the batch job: ``python -m lapwise OUT laps=raw/laps.json stints=raw/stints.json ...``

Cleans and gates the landed files, builds the lap mart, shows the reports and writes the exports. Paths
may be anything Spark reads, wildcards included, so that one run covers many sessions.
"""

from __future__ import annotations

import argparse
import inspect

from lapwise.operators.quality import preview, profile
from lapwise.plans import mart, pipeline, reports
from lapwise.session import get_spark
from lapwise.sources.read import read_parquet

REPORTS = {
    "Mart": mart.mart_summary,
    "Clean laps": reports.green_flag_sample,
    "Pace by rainfall": reports.pace_by_rainfall,
    "Pace by lap": reports.pace_by_lap,
    "Rainfall changes": reports.rainfall_changes,
    "Pace in chosen laps": reports.pace_in_lap_ranges,
    "Compound usage": reports.compound_usage,
    "Wet stints": reports.compound_stints,
    "Strategy by stint": reports.strategy_by_stint,
    "Pit stops": reports.pit_stops,
    "Pit stops by lap": reports.pit_stops_by_lap,
    "Pit stops by rainfall": reports.pit_stops_by_rainfall,
    "Compound changes at pit stops": reports.compound_changes,
    "Headline figures": reports.headline_figures,
}


def main() -> None:
    parser = argparse.ArgumentParser(prog="lapwise", description=__doc__)
    parser.add_argument("out", help="folder for processed tables, the mart and its exports")
    parser.add_argument("raw", nargs="+", metavar="dataset=path", help=", ".join(pipeline.DATASETS))
    parser.add_argument("--master", help="Spark master, unless spark-submit names it")
    parser.add_argument("--data-gigabytes", type=float, help="size of the largest table, to size shuffles by")
    parser.add_argument("--json-lines", action="store_true", help="one record per line instead of one array per file")
    parser.add_argument("--keep-extra", action="store_true", help="keep unknown weather columns")
    parser.add_argument("--partition-by-session", action="store_true", help="one folder per session")
    parser.add_argument("--by-session", action="store_true", help="report each session on its own")
    parser.add_argument("--rows", type=int, default=20, help="rows shown per report")
    arguments = parser.parse_args()

    raw = dict(pair.split("=", 1) for pair in arguments.raw)
    unknown = set(raw) - set(pipeline.DATASETS)
    if unknown:
        parser.error(f"unknown datasets: {sorted(unknown)}")
    size = arguments.data_gigabytes and int(arguments.data_gigabytes * 1024**3)
    spark = get_spark("lapwise", arguments.master, size)
    paths = pipeline.process(
        spark,
        raw,
        f"{arguments.out}/processed",
        arguments.keep_extra,
        not arguments.json_lines,
        ["session_key"] if arguments.partition_by_session else [],
    )
    if "race_control" in paths:
        log = read_parquet(spark, paths["race_control"])
        for title, df in {
            "Race control": profile(log),
            "First messages": preview(log, ["date"], 10),
            "Messages in chosen laps": reports.race_control_in_lap_ranges(log),
        }.items():
            print(title)
            df.show(arguments.rows, truncate=False)
    lap_mart = pipeline.build(spark, paths, arguments.out)
    for title, report in REPORTS.items():
        print(title)
        per_session = arguments.by_session and "by_session" in inspect.signature(report).parameters
        (report(lap_mart, by_session=True) if per_session else report(lap_mart)).show(arguments.rows, truncate=False)
    print("Exported rows")
    pipeline.export(spark, lap_mart, f"{arguments.out}/export").show()


if __name__ == "__main__":
    main()
