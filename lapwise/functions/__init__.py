"""Column expressions used by several operators and reports."""

from lapwise.functions.expressions import (
    add_seconds,
    all_true,
    change_label,
    composite_key,
    interval_micros,
    interval_seconds,
    is_complete,
    parse_utc,
    round_columns,
    seconds_between,
    sort_nulls_last,
    utc_wall_clock,
    within_seconds,
)

__all__ = [
    "add_seconds",
    "all_true",
    "change_label",
    "composite_key",
    "interval_micros",
    "interval_seconds",
    "is_complete",
    "parse_utc",
    "round_columns",
    "seconds_between",
    "sort_nulls_last",
    "utc_wall_clock",
    "within_seconds",
]
