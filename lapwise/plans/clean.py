"""Cleaning of each dataset: parse times, flag incomplete records instead of dropping them, project.

Each ``clean_*`` takes landed records and returns a DataFrame; ``check`` applies the dataset's gate. The names of
columns are fixed values: those of the landed records and of the processed tables.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapwise.functions import is_complete, parse_utc
from lapwise.operators.quality import key_metrics, require_key, require_periods, require_written_key
from lapwise.operators.temporal import state_timeline
from lapwise.sources.read import inline_arrays


def clean_drivers(records: DataFrame) -> DataFrame:
    return records.select(
        "meeting_key",
        "session_key",
        "driver_number",
        "full_name",
        "name_acronym",
        "team_name",
        "team_colour",
        "country_code",
    )


def clean_laps(records: DataFrame) -> DataFrame:
    return records.select(
        "meeting_key",
        "session_key",
        "driver_number",
        "lap_number",
        parse_utc("date_start").alias("date_start"),
        "lap_duration",
        "duration_sector_1",
        "duration_sector_2",
        "duration_sector_3",
        "is_pit_out_lap",
        is_complete("date_start").alias("valid_for_weather"),
        is_complete("lap_duration").alias("valid_for_pace"),
    )


def clean_stints(records: DataFrame) -> DataFrame:
    return records.select(
        "meeting_key",
        "session_key",
        "driver_number",
        "stint_number",
        "lap_start",
        "lap_end",
        "compound",
        "tyre_age_at_start",
        is_complete("lap_start", "lap_end").alias("valid_for_strategy"),
    )


def clean_pit_stops(records: DataFrame) -> DataFrame:
    return records.select(
        "meeting_key",
        "session_key",
        "driver_number",
        "lap_number",
        parse_utc("date").alias("date"),
        "lane_duration",
        "pit_duration",
        "stop_duration",
        is_complete("stop_duration").alias("valid_stop_duration"),
    )


def clean_circuit_weather(records: DataFrame) -> DataFrame:
    """All columns found are kept."""
    return records.withColumn("date", parse_utc("date"))


def clean_hourly_weather(documents: DataFrame) -> DataFrame:
    """One row per hour from documents of parallel arrays; all measures found are kept."""
    arrays = documents.select("hourly.*")
    return inline_arrays(arrays, *arrays.columns).withColumn("time", parse_utc("time"))


def clean_race_control(records: DataFrame) -> DataFrame:
    return records.select(
        "meeting_key",
        "session_key",
        parse_utc("date").alias("date"),
        "lap_number",
        "category",
        "flag",
        "scope",
        "sector",
        "driver_number",
        "message",
    )


# Race-control messages and the race states they lead to.
STATE_CATEGORIES = ("SafetyCar", "SessionStatus")
STATE_MESSAGES = {
    "SESSION STARTED": "NORMAL",
    "VIRTUAL SAFETY CAR DEPLOYED": "VSC",
    "VIRTUAL SAFETY CAR ENDING": "NORMAL",
    "SAFETY CAR DEPLOYED": "SAFETY_CAR",
    "SESSION ABORTED": "RED_FLAG",
    "RED FLAG": "RED_FLAG",
    "SESSION FINISHED": "FINISHED",
}
CONDITIONAL_MESSAGES = {"TRACK CLEAR": ("SAFETY_CAR", "NORMAL")}


def state_messages(race_control: DataFrame) -> DataFrame:
    """The race-control messages that can bear on the race state."""
    return race_control.where(
        F.col("category").isin(*STATE_CATEGORIES) | (F.col("flag") == "RED") | (F.col("message") == "TRACK CLEAR")
    )


def race_status(
    race_control: DataFrame, order: tuple[str, ...] = ("date", "message"), keep_open: bool = False
) -> DataFrame:
    """Periods of constant race state per session.

    Messages of the same instant are taken in the order of the further ``order`` columns.
    """
    return state_timeline(
        state_messages(race_control),
        ["session_key"],
        order,
        "message",
        STATE_MESSAGES,
        CONDITIONAL_MESSAGES,
        state="race_state",
        keep_open=keep_open,
    )


@dataclass(frozen=True)
class Gate:
    """Rules a cleaned dataset has to meet before anything is built on it."""

    key: tuple[str, ...]
    violations: dict[str, Column] = field(default_factory=dict)


def gate_of(dataset: str) -> Gate | None:
    lap = ("session_key", "driver_number", "lap_number")
    gates = {
        "drivers": lambda: Gate(("session_key", "driver_number")),
        "laps": lambda: Gate(lap, {"lap_number_below_1": F.col("lap_number") < 1}),
        "stints": lambda: Gate(("session_key", "driver_number", "stint_number")),
        "pit_stops": lambda: Gate(lap),
        "circuit_weather": lambda: Gate(("session_key", "date")),
        "hourly_weather": lambda: Gate(("time",)),
    }
    return gates[dataset]() if dataset in gates else None


def check(dataset: str, df: DataFrame) -> DataFrame:
    """Raise if the dataset breaks its gate, else return it."""
    gate = gate_of(dataset)
    if gate is not None:
        require_key(df, gate.key, dataset, gate.violations)
    if dataset == "race_status":
        require_periods(df, "start_time", "end_time", dataset)
    return df


def gate_metrics(dataset: str) -> dict[str, Column]:
    """What the job that writes a dataset is to count for its gate."""
    gate = gate_of(dataset)
    return key_metrics(gate.key, gate.violations) if gate else {}


def check_written(dataset: str, written: DataFrame, metrics: dict[str, int]) -> None:
    """Raise if a written dataset breaks its gate; what its writing counted is not counted again."""
    gate = gate_of(dataset)
    if gate is not None:
        require_written_key(metrics, written, gate.key, dataset)
    if dataset == "race_status":
        require_periods(written, "start_time", "end_time", dataset)
