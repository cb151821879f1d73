"""The lap mart: one row per session, driver and lap."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapwise.functions import add_seconds, all_true, within_seconds
from lapwise.operators.aggregates import distinct_keys, filtered_counts, truth_counts
from lapwise.operators.joins import lookup_join, range_join
from lapwise.operators.quality import require_grain
from lapwise.operators.slices import MAX_ROWS
from lapwise.operators.temporal import asof_join, overlap_flag

# Columns of the mart, and how old weather may be to count.
LAP_KEY = ("session_key", "driver_number", "lap_number")
WEATHER_TOLERANCE_SECONDS = 60

DRIVER_COLUMNS = ("full_name", "name_acronym", "team_name", "team_colour", "country_code")
STINT_COLUMNS = ("stint_number", "compound", "tyre_age_at_start", "valid_for_strategy")
PIT_COLUMNS = ("pit_duration", "stop_duration", "lane_duration", "valid_stop_duration")
WEATHER_COLUMNS = (
    "air_temperature",
    "track_temperature",
    "humidity",
    "pressure",
    "wind_speed",
    "wind_direction",
    "rainfall",
)
LAP_COLUMNS = (
    "meeting_key",
    *LAP_KEY,
    "date_start",
    "date_end",
    "lap_duration",
    "duration_sector_1",
    "duration_sector_2",
    "duration_sector_3",
    "is_pit_out_lap",
    "valid_for_weather",
    "valid_for_pace",
)
MART_COLUMNS = (
    *LAP_COLUMNS,
    *DRIVER_COLUMNS,
    *STINT_COLUMNS,
    *PIT_COLUMNS,
    "is_pit_stop",
    "weather_time",
    *WEATHER_COLUMNS,
    "weather_time_gap",
    "valid_weather_match",
    "is_neutralised",
    "valid_green_flag_pace",
)


def build_mart(tables: Mapping[str, DataFrame], max_rows: int | None = MAX_ROWS) -> DataFrame:
    """Assemble the mart from ``laps drivers stints pit_stops circuit_weather race_status``.

    The two sorted lookups come first, while rows are narrow: they shuffle whole rows. Drivers, stints
    and pit stops are then joined by equality on (session, driver).
    """
    laps = tables["laps"].withColumn("date_end", add_seconds("date_start", "lap_duration"))
    laps = laps.select(*LAP_COLUMNS)
    session = ["session_key"]

    # Any state but NORMAL counts as neutralised, FINISHED included.
    periods = tables["race_status"].where(F.col("race_state") != "NORMAL")
    mart = overlap_flag(
        laps, periods, session, "date_start", "date_end", "start_time", "end_time", "is_neutralised", max_rows
    )
    mart = asof_join(
        mart,
        tables["circuit_weather"],
        session,
        "date_start",
        "date",
        {"date": "weather_time", **{c: c for c in WEATHER_COLUMNS}},
        max_rows=max_rows,
        counted=laps,
    )
    mart = lookup_join(mart, tables["drivers"], LAP_KEY[:2], DRIVER_COLUMNS)
    mart = range_join(mart, tables["stints"], LAP_KEY[:2], "lap_number", "lap_start", "lap_end", STINT_COLUMNS)
    mart = lookup_join(mart, tables["pit_stops"], LAP_KEY, PIT_COLUMNS, hit="is_pit_stop")
    return add_flags(mart).select(*MART_COLUMNS)


def add_flags(mart: DataFrame) -> DataFrame:
    """Age and validity of the matched weather, and whether the lap is a clean racing lap."""
    mart = mart.withColumn("weather_time_gap", F.col("date_start") - F.col("weather_time")).withColumn(
        "valid_weather_match", within_seconds("date_start", "weather_time", WEATHER_TOLERANCE_SECONDS)
    )
    return mart.withColumn(
        "valid_green_flag_pace",
        all_true(
            F.col("valid_for_pace"),
            F.col("valid_weather_match"),
            ~F.col("is_pit_stop"),
            ~F.coalesce(F.col("is_pit_out_lap"), F.lit(False)),
            ~F.col("is_neutralised"),
        ),
    )


def mart_summary(mart: DataFrame) -> DataFrame:
    """One row of counts by which to judge the mart."""
    neutralised = truth_counts("is_neutralised", "neutralised")
    conditions = {
        "valid_pace_laps": F.col("valid_for_pace"),
        "valid_strategy_laps": F.col("valid_for_strategy"),
        "valid_weather_laps": F.col("valid_weather_match"),
        "pit_stop_laps": F.col("is_pit_stop"),
        "neutralised_laps": neutralised["neutralised_true"],
        "non_neutralised_laps": neutralised["neutralised_false"],
        "unknown_neutralisation_laps": neutralised["neutralised_unknown"],
        "valid_green_flag_pace_laps": F.col("valid_green_flag_pace"),
    }
    return filtered_counts(mart, conditions, total="total_rows", unique_laps=distinct_keys(*LAP_KEY))


def check_grain(mart: DataFrame) -> DataFrame:
    """Raise if a lap occurs more than once, else return the mart."""
    require_grain(mart, LAP_KEY, "lap mart")
    return mart
