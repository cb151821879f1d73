"""Column expressions; all run JVM-side and work on TIMESTAMP and TIMESTAMP_NTZ alike."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def add_seconds(time: Column | str, seconds: Column | str) -> Column:
    """``time`` moved by a possibly fractional number of seconds; null if either is null."""
    return _col(time) + F.make_dt_interval(secs=_col(seconds))


def seconds_between(later: Column | str, earlier: Column | str) -> Column:
    """``later - earlier`` as double seconds, to the microsecond."""
    return interval_seconds(_col(later) - _col(earlier))


def interval_micros(interval: Column | str) -> Column:
    """A day-time interval as whole microseconds, by integer arithmetic only."""
    interval = _col(interval)
    seconds = interval.cast("interval second").cast("bigint")
    rest = (interval - F.expr("INTERVAL '1' SECOND") * seconds) * 1_000_000
    return seconds * 1_000_000 + rest.cast("interval second").cast("bigint")


def interval_seconds(interval: Column | str) -> Column:
    """A day-time interval as double seconds, to the microsecond."""
    return interval_micros(interval) / 1_000_000


def within_seconds(later: Column | str, earlier: Column | str, seconds: float) -> Column:
    """TRUE if ``later`` is at most ``seconds`` after ``earlier`` (inclusive); FALSE if either is unknown."""
    gap = _col(later) - _col(earlier)
    return F.coalesce(gap <= F.make_dt_interval(secs=F.lit(seconds)), F.lit(False))


def parse_utc(text: Column | str, strict: bool = True) -> Column:
    """ISO-8601 text to a timestamp; what has no offset is UTC, whatever the session time zone.

    Malformed text raises, or becomes null with ``strict=False``.
    """
    text = _col(text)
    full = F.regexp_replace(text, r"^(\d{4}-\d{2}-\d{2})$", "$1T00:00")
    full = F.regexp_replace(full, r"([T ]\d{2}:\d{2})(?=$|Z|[+-])", "$1:00")
    full = F.regexp_replace(full, r"([T ]\d{2}:\d{2}:\d{2}([.]\d+)?)$", "$1Z")
    parsed = F.try_to_timestamp(full)
    if not strict:
        return parsed
    malformed = F.raise_error(F.concat(F.lit("not an ISO-8601 time: "), text)).cast("timestamp")
    return F.when(text.isNotNull() & parsed.isNull(), malformed).otherwise(parsed)


def utc_wall_clock(time: Column | str) -> Column:
    """A TIMESTAMP as the TIMESTAMP_NTZ that a clock in UTC shows."""
    return F.convert_timezone(None, F.lit("UTC"), _col(time).cast("timestamp_ntz"))


def is_complete(*columns: Column | str) -> Column:
    """TRUE if none of the columns is null, else FALSE."""
    return reduce(lambda a, b: a & b, [_col(c).isNotNull() for c in columns])


def all_true(*conditions: Column) -> Column:
    """Conjunction in which an unknown outcome counts as FALSE."""
    return F.coalesce(reduce(lambda a, b: a & b, conditions), F.lit(False))


def composite_key(*columns: Column | str, separator: str = "-") -> Column:
    """Key parts as text joined by a separator; null if any part is null."""
    parts: list[Column] = []
    for column in columns:
        if parts:
            parts.append(F.lit(separator))
        parts.append(_col(column).cast("string"))
    return F.concat(*parts)


def change_label(
    old: Column | str,
    new: Column | str,
    unknown: str = "UNKNOWN",
    same: str = "SAME",
    changed: str = "CHANGE",
) -> Column:
    """Three-way label; an unknown old value with a known new one counts as a change."""
    return (
        F.when(_col(new).isNull(), unknown)
        .when(_col(old) == _col(new), same)
        .otherwise(changed)
    )


def sort_nulls_last(df: DataFrame, *columns: str) -> DataFrame:
    """Order by the columns, a leading ``-`` meaning descending, with nulls last in both directions."""
    columns = tuple(dict.fromkeys(columns))
    return df.orderBy(
        *[
            F.col(c[1:]).desc_nulls_last() if c.startswith("-") else F.col(c).asc_nulls_last()
            for c in columns
        ]
    )


def round_columns(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    """Round the named columns, each to its own number of digits."""
    return df.withColumns({name: F.round(name, places) for name, places in digits.items()})
