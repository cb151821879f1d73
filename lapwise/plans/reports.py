"""Reports over the lap mart. Each takes the mart and returns an ordered DataFrame.

The mart may hold any number of sessions; ``by_session`` adds the session key to grouping, output and
order, without it a report covers all laps together. ``digits`` overrides the number of decimals.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapwise.functions import change_label, round_columns, sort_nulls_last
from lapwise.operators.aggregates import grouped_summary, run_extent
from lapwise.operators.joins import next_ordinal_join
from lapwise.operators.temporal import change_points

SESSION = "session_key"
# The laps that some reports look at.
LAP_RANGES = ((24, 35), (37, 45))


def _session(by_session: bool) -> list[str]:
    return [SESSION] if by_session else []


def _rows() -> Column:
    return F.count(F.lit(1))


def _round(df: DataFrame, standard: dict[str, int], digits: int | None) -> DataFrame:
    return round_columns(df, {c: n if digits is None else digits for c, n in standard.items()})


def green_flag_laps(mart: DataFrame) -> DataFrame:
    """Clean racing laps. Unlike the mart's own flag, an unknown pit-out state disqualifies a lap."""
    return mart.where(
        F.col("valid_for_pace")
        & F.col("valid_weather_match")
        & ~F.col("is_pit_stop")
        & ~F.col("is_pit_out_lap")
        & ~F.col("is_neutralised")
    )


def in_lap_ranges(lap: str, ranges: Sequence[tuple[int, int]]) -> Column:
    condition = F.lit(False)
    for low, high in ranges:
        condition = condition | F.col(lap).between(low, high)
    return condition


def pace_by_rainfall(mart: DataFrame, by_session: bool = False, digits: int | None = None) -> DataFrame:
    """Number, mean, median and extremes of clean lap times, dry against wet."""
    keys = [*_session(by_session), "rainfall"]
    summary = grouped_summary(
        green_flag_laps(mart),
        keys,
        {
            "lap_count": _rows(),
            "average_lap_time": F.avg("lap_duration"),
            "fastest_lap": F.min("lap_duration"),
            "slowest_lap": F.max("lap_duration"),
        },
        {"median_lap_time": "lap_duration"},
    )
    names = ["average_lap_time", "median_lap_time", "fastest_lap", "slowest_lap"]
    summary = _round(summary, dict.fromkeys(names, 3), digits)
    return sort_nulls_last(summary.select(*keys, "lap_count", *names), *keys)


def pace_by_lap(mart: DataFrame, by_session: bool = False, digits: int | None = None) -> DataFrame:
    """Median clean lap time through the race."""
    keys = [*_session(by_session), "lap_number", "rainfall"]
    summary = grouped_summary(
        green_flag_laps(mart), keys, {"driver_laps": _rows()}, {"median_lap_time": "lap_duration"}
    )
    return sort_nulls_last(_round(summary, {"median_lap_time": 3}, digits), *keys)


def rainfall_changes(mart: DataFrame) -> DataFrame:
    """Weather observations at which rainfall set in or stopped, within each session."""
    observed = mart.where("valid_weather_match").select(SESSION, "weather_time", "rainfall").distinct()
    changes = change_points(observed, [SESSION], ["weather_time"], "rainfall")
    changes = changes.select(SESSION, "weather_time", "previous_rainfall", "rainfall")
    return sort_nulls_last(changes, SESSION, "weather_time")


def pace_in_lap_ranges(
    mart: DataFrame,
    ranges: Sequence[tuple[int, int]] = LAP_RANGES,
    by_session: bool = False,
    digits: int | None = None,
) -> DataFrame:
    """Clean lap times next to the weather, in chosen parts of the race."""
    keys = [*_session(by_session), "lap_number", "rainfall"]
    weather = ["air_temperature", "track_temperature", "humidity", "wind_speed"]
    summary = grouped_summary(
        green_flag_laps(mart).where(in_lap_ranges("lap_number", ranges)),
        keys,
        {**{c: F.avg(c) for c in weather}, "driver_laps": _rows()},
        {"median_lap_time": "lap_duration"},
    )
    summary = _round(summary, {"median_lap_time": 3, **dict.fromkeys(weather, 2)}, digits)
    columns = [*_session(by_session), "lap_number", "median_lap_time", *weather, "rainfall", "driver_laps"]
    return sort_nulls_last(summary.select(*columns), *keys)


def compound_usage(mart: DataFrame, by_session: bool = False) -> DataFrame:
    """Laps driven on each compound, most used first."""
    session = _session(by_session)
    usage = mart.where("valid_for_strategy").groupBy(*session, "compound").agg(_rows().alias("driver_laps"))
    return sort_nulls_last(usage, *session, "-driver_laps")


def compound_stints(
    mart: DataFrame, compound: str = "WET", by_session: bool = False, digits: int | None = None
) -> DataFrame:
    """Stints on one compound with the conditions they were driven in."""
    session = _session(by_session)
    stints = run_extent(
        mart.where(F.col("valid_for_strategy") & (F.col("compound") == compound) & F.col("valid_weather_match")),
        [*session, "full_name", "driver_number", "stint_number"],
        "lap_number",
        "first_lap",
        "last_lap",
        "driver_laps",
        rainfall_rate=F.avg("rainfall"),
        avg_track_temperature=F.avg("track_temperature"),
        avg_humidity=F.avg("humidity"),
    )
    means = ["rainfall_rate", "avg_track_temperature", "avg_humidity"]
    return sort_nulls_last(_round(stints, dict.fromkeys(means, 2), digits), *session, "first_lap", "driver_number")


def strategy_by_stint(mart: DataFrame, by_session: bool = False) -> DataFrame:
    """Compound and laps of every stint."""
    session = _session(by_session)
    stints = run_extent(
        mart.where("valid_for_strategy"),
        [*session, "full_name", "driver_number", "stint_number", "compound"],
        "lap_number",
        "first_lap",
        "last_lap",
        "driver_laps",
    )
    return sort_nulls_last(stints, *session, "driver_number", "stint_number")


def pit_stops(mart: DataFrame, by_session: bool = False) -> DataFrame:
    """Every pit stop with its circumstances."""
    session = _session(by_session)
    # The session also decides between equals: rows sort evenly only if the order tells them apart.
    stops = sort_nulls_last(mart.where("is_pit_stop"), *session, "lap_number", "driver_number", SESSION)
    return stops.select(
        *session,
        "full_name",
        "driver_number",
        "lap_number",
        "compound",
        "rainfall",
        "air_temperature",
        "track_temperature",
        "humidity",
        "is_neutralised",
        "pit_duration",
        "lane_duration",
        "stop_duration",
    )


def pit_stops_by_lap(mart: DataFrame, by_session: bool = False, digits: int | None = None) -> DataFrame:
    """Pit stops with known weather, per lap of the race."""
    keys = [*_session(by_session), "lap_number", "rainfall"]
    stops = mart.where(F.col("is_pit_stop") & F.col("valid_weather_match"))
    counts = stops.groupBy(*keys).agg(
        _rows().alias("pit_stops"),
        F.avg("track_temperature").alias("avg_track_temperature"),
        F.avg("humidity").alias("avg_humidity"),
    )
    counts = _round(counts, {"avg_track_temperature": 2, "avg_humidity": 2}, digits)
    columns = ["lap_number", "pit_stops", "rainfall", "avg_track_temperature", "avg_humidity"]
    return sort_nulls_last(counts.select(*_session(by_session), *columns), *keys)


def pit_stops_by_rainfall(mart: DataFrame, by_session: bool = False) -> DataFrame:
    """Pit stops with known weather, dry against wet."""
    keys = [*_session(by_session), "rainfall"]
    stops = mart.where(F.col("is_pit_stop") & F.col("valid_weather_match"))
    return sort_nulls_last(stops.groupBy(*keys).agg(_rows().alias("pit_stops")), *keys)


def compound_changes(mart: DataFrame, by_session: bool = False) -> DataFrame:
    """Compound before and after every pit stop; a new stint need not mean a new compound."""
    session = _session(by_session)
    stops = next_ordinal_join(
        mart.where("is_pit_stop").select(
            SESSION, "full_name", "driver_number", "lap_number", "compound", "rainfall", "is_neutralised"
        ),
        mart,
        [SESSION, "driver_number"],
        "lap_number",
        {"compound": "new_compound"},
    )
    stops = sort_nulls_last(stops, *session, "lap_number", "driver_number", SESSION)
    return stops.select(
        *session,
        "full_name",
        "driver_number",
        F.col("lap_number").alias("pit_lap"),
        F.col("compound").alias("old_compound"),
        "new_compound",
        "rainfall",
        "is_neutralised",
        change_label("compound", "new_compound", same="SAME COMPOUND", changed="COMPOUND CHANGE").alias(
            "change_type"
        ),
    )


def race_control_in_lap_ranges(
    race_control: DataFrame, ranges: Sequence[tuple[int, int]] = LAP_RANGES, by_session: bool = False
) -> DataFrame:
    """Race-control messages of chosen parts of the race, in order of time."""
    session = _session(by_session)
    messages = race_control.where(in_lap_ranges("lap_number", ranges))
    messages = sort_nulls_last(messages, *session, "date", SESSION, "message")
    return messages.select(*session, "date", "lap_number", "category", "flag", "scope", "sector", "message")


def green_flag_sample(mart: DataFrame, by_session: bool = False, digits: int | None = None) -> DataFrame:
    """Size and median of the laps the mart itself flags as clean, dry against wet."""
    keys = [*_session(by_session), "rainfall"]
    summary = grouped_summary(
        mart.where("valid_green_flag_pace"),
        keys,
        {"lap_count": _rows()},
        {"median_lap_time": "lap_duration"},
    )
    return sort_nulls_last(_round(summary, {"median_lap_time": 3}, digits), *keys)


def headline_figures(mart: DataFrame, digits: int | None = None) -> DataFrame:
    """One row: dry and wet median of clean lap times, their difference, and the number of pit stops.

    The difference is taken before rounding.
    """
    medians = grouped_summary(
        green_flag_laps(mart).withColumn("_wet", F.col("rainfall") != 0),
        ["_wet"],
        {},
        {"_median": "lap_duration"},
    )
    figures = medians.agg(
        F.max(F.when(~F.col("_wet"), F.col("_median"))).alias("dry_median"),
        F.max(F.when(F.col("_wet"), F.col("_median"))).alias("rain_median"),
    ).withColumn("median_difference", F.col("rain_median") - F.col("dry_median"))
    figures = _round(figures, dict.fromkeys(figures.columns, 2), digits)
    return figures.withColumn("pit_events", mart.agg(F.count_if("is_pit_stop")).scalar())
