"""As-of joins, interval overlap, change detection and state timelines."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapwise.operators.folds import fold_states
from lapwise.operators.ordered import OrderedRows
from lapwise.operators.slices import MAX_ROWS, find_slices


def _spread(keys: Sequence[str], *times: str) -> Column:
    """0 for rows that can match, else the number of the reading task plus one.

    Rows with an unknown key or time match nothing; as an extra window key this keeps all of them from
    meeting in one task.
    """
    usable = F.lit(True)
    for column in [*keys, *times]:
        usable = usable & F.col(column).isNotNull()
    return F.when(usable, F.lit(0)).otherwise(F.spark_partition_id() + 1)


def _known(df: DataFrame, *columns: str) -> DataFrame:
    for column in columns:
        df = df.where(F.col(column).isNotNull())
    return df


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    columns: Mapping[str, str] | None = None,
    tie_break: Sequence[str] = (),
    max_rows: int | None = MAX_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Every left row with the latest right row of its key at or before its time, or nulls.

    ``columns`` maps right columns to output names (default: all but the keys, unrenamed). Right rows
    must be unique per (keys, ``right_time``), or be put in order by ``tie_break`` columns of the right
    side, the largest winning. Both inputs go through one shuffle; there is no join.

    Left columns nobody uses are not read; of the right side, name only what is needed. ``counted`` may
    stand in for ``left`` when rows per key are counted, if it has the same keys and times at less cost.
    """
    if columns is None:
        columns = {c: c for c in right.columns if c not in keys}
    clash = set(columns.values()) & set(left.columns)
    if clash:
        raise ValueError(f"output columns already on the left side: {sorted(clash)}")
    ties = {f"_tie_{i}": F.col(c) for i, c in enumerate(tie_break)}
    found = F.struct(*[F.col(c).alias(name) for c, name in columns.items()])

    group, order = [*keys, "_spread"], ["_time", "_side", *ties]

    def interleave(left: DataFrame, right: DataFrame, time: str) -> DataFrame:
        # Side 0 sorts first, so a right row of the same time matches.
        return _interleave(left, right, keys, (time,), right_time, 1, 0, {"_found": found, **ties})

    def look_up(left: DataFrame, right: DataFrame, time: str) -> DataFrame:
        ordered = OrderedRows.cut(interleave(left, right, time), group, order, slices)
        latest = ordered.running_last("_found", "_latest").df.where(F.col("_side") == 1)
        return latest.select(
            *_left_columns(left, time), *[F.col("_latest")[name].alias(name) for name in columns.values()]
        )

    right = _known(right, *keys, right_time)
    sized = (left if counted is None else counted).select(*keys, left_time)
    slices = find_slices(_matchable(interleave(sized, right, left_time)), group, order, max_rows)
    if slices.fine_enough:
        return look_up(left, right, left_time)
    if tie_break:
        best = F.max_by(F.struct(*right.columns), F.struct(*tie_break)).alias("_best")
        right = right.groupBy(*keys, right_time).agg(best).select("_best.*")
    return _by_distinct_time(left, keys, left_time, lambda probes: look_up(probes, right, _PROBE_TIME))


def overlap_flag(
    left: DataFrame,
    periods: DataFrame,
    keys: Sequence[str],
    start: str,
    end: str,
    period_start: str,
    period_end: str,
    flag: str,
    max_rows: int | None = MAX_ROWS,
) -> DataFrame:
    """Add ``flag``: whether any period of the same key overlaps [start, end), touching ends excluded.

    NULL where start or end is unknown. Some period starts before ``end`` and ends after ``start``
    exactly when the latest end among the periods starting before ``end`` is after ``start``. So it
    takes a running maximum over one sorted sequence; pairs of rows are never formed.
    """

    group, order = [*keys, "_spread"], ["_time", "_side"]

    def interleave(left: DataFrame, periods: DataFrame, times: tuple[str, ...]) -> DataFrame:
        # Side 0 sorts first: a period has to start strictly before the end.
        return _interleave(
            left, periods, keys, times, period_start, 0, 1, {"_period_end": F.col(period_end)}
        )

    def look_up(left: DataFrame, periods: DataFrame, times: tuple[str, ...]) -> DataFrame:
        ordered = OrderedRows.cut(interleave(left, periods, times), group, order, slices)
        latest = ordered.running_max("_period_end", "_latest_end").df.where(F.col("_side") == 0)
        return latest.select(*_left_columns(left, times[0]), "_latest_end")

    periods = _known(periods, *keys, period_start, period_end)
    # First with rows of unknown times, which often are worked out from other columns.
    among = _known(left.select(*keys), *keys).unionByName(periods.select(*keys)).withColumn("_spread", F.lit(0))
    slices = find_slices(_matchable(interleave(left, periods, (end, start))), group, order, max_rows, among)
    if slices.fine_enough:
        found = look_up(left, periods, (end, start))
    else:
        longest = periods.groupBy(*keys, period_start).agg(F.max(period_end).alias(period_end))
        found = _by_distinct_time(left, keys, end, lambda probes: look_up(probes, longest, (_PROBE_TIME,)))
    overlaps = F.coalesce(F.col("_latest_end") > F.col(start), F.lit(False))
    unknown = F.col(start).isNull() | F.col(end).isNull()
    return found.select(*left.columns, F.when(unknown, F.lit(None)).otherwise(overlaps).alias(flag))


_PROBE_TIME = "_probe_time"


def _interleave(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_times: tuple[str, ...],
    right_time: str,
    left_side: int,
    right_side: int,
    right_columns: Mapping[str, Column],
) -> DataFrame:
    """Both sides in one layout, to be sorted by ``_time`` and ``_side``.

    The first of ``left_times`` becomes ``_time``; a left row lacking any of them matches nothing. The
    other left columns stay as they are, so that those nobody asks for are not even read.
    """
    time = left_times[0]
    if left.schema[time].dataType != right.schema[right_time].dataType:
        raise TypeError(f"{time} and {right_time} have to be of one type")
    probes = left.select(
        *keys,
        _spread(keys, *left_times).alias("_spread"),
        F.col(time).alias("_time"),
        F.lit(left_side).alias("_side"),
        *[c for c in left.columns if c not in keys and c != time],
    )
    values = right.select(
        *keys,
        F.lit(0).alias("_spread"),
        F.col(right_time).alias("_time"),
        F.lit(right_side).alias("_side"),
        *[column.alias(name) for name, column in right_columns.items()],
    )
    return probes.unionByName(values, allowMissingColumns=True)


def _left_columns(left: DataFrame, time: str) -> list[Column]:
    """The columns of the left side, back under their names."""
    return [F.col("_time").alias(c) if c == time else F.col(c) for c in left.columns]


def _matchable(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("_spread") == 0)


def _by_distinct_time(left: DataFrame, keys: Sequence[str], time: str, look_up) -> DataFrame:
    """Look up each distinct (keys, time) once and bring the answers back with an equality join.

    For the case that one instant of one key is itself too large to sort in a task; adaptive execution
    splits such a join.
    """
    probes = left.select(*keys, F.col(time).alias(_PROBE_TIME)).dropna().distinct()
    found = look_up(probes).withColumnsRenamed({k: f"_probe_{k}" for k in keys})
    same = F.col(time) == F.col(_PROBE_TIME)
    for key in keys:
        same = same & (F.col(key) == F.col(f"_probe_{key}"))
    return left.join(found, same, "left").drop(_PROBE_TIME, *[f"_probe_{k}" for k in keys])


def change_points(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    previous: str | None = None,
    max_rows: int | None = MAX_ROWS,
) -> DataFrame:
    """Rows without a previous value, or whose value differs from it, with the previous value added.

    Nulls follow SQL comparison: a change to null is not reported, the row after a null is.
    """
    previous = previous or f"previous_{value}"
    rows = OrderedRows.of(df, keys, order, max_rows).previous(value, previous)
    changed = F.col(previous).isNull() | (F.col(value) != F.col(previous))
    return rows.where(changed).result()


def close_periods(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    start: str,
    end: str,
    keep_open: bool = False,
    max_rows: int | None = MAX_ROWS,
) -> DataFrame:
    """Turn points in time into periods that end where the next one of the key starts.

    The last period of a key has no end; it is dropped unless ``keep_open``.
    """
    return _close(OrderedRows.of(df, keys, order, max_rows), start, end, keep_open).result()


def _close(rows: OrderedRows, start: str, end: str, keep_open: bool) -> OrderedRows:
    rows = rows.following(start, end)
    return rows if keep_open else rows.where(F.col(end).isNotNull())


def state_changes(
    events: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    signal: str,
    set_rules: Mapping[str, str],
    conditional_rules: Mapping[str, tuple[str, str] | Mapping[str, str]] | None = None,
    initial: str = "NOT_STARTED",
    state: str = "state",
    max_rows: int | None = MAX_ROWS,
) -> DataFrame:
    """Rows of an event log at which a state machine changes state, with the new state added.

    ``set_rules`` maps a signal to the state it always sets, ``conditional_rules`` a signal to
    ``(required state, new state)``, or to a mapping of several such pairs. Rules may chain, contradict each other and
    lead in circles; a condition that is met goes before what the same signal sets. Other signals change nothing.
    ``order`` must be unique within a key.
    """
    rows = _state_changes(
        events, keys, order, signal, set_rules, conditional_rules or {}, initial, state, max_rows
    )
    return rows.result()


def state_timeline(
    events: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    signal: str,
    set_rules: Mapping[str, str],
    conditional_rules: Mapping[str, tuple[str, str] | Mapping[str, str]] | None = None,
    initial: str = "NOT_STARTED",
    state: str = "state",
    trigger: str = "trigger",
    start: str = "start_time",
    end: str = "end_time",
    keep_open: bool = False,
    max_rows: int | None = MAX_ROWS,
) -> DataFrame:
    """Periods of constant state per key: keys, start, end, state and the signal that opened it.

    ``order[0]`` is the time of the events; see ``state_changes`` for the rules.
    """
    rules = (signal, set_rules, conditional_rules or {}, initial, state, max_rows)
    rows = _state_changes(events, keys, order, *rules, uncut=True)
    if not rows.slices.fine_enough:
        # Too many events share one instant. Copies of an event change nothing, so one of each will do.
        rows = _state_changes(events.select(*keys, *order, signal).distinct(), keys, order, *rules)
    # Same keys, order and slices as above, so this needs no further shuffle.
    closed = _close(rows, order[0], "_end", keep_open).df
    return closed.select(
        *keys,
        F.col(order[0]).alias(start),
        F.col("_end").alias(end),
        F.col(state),
        F.col(signal).alias(trigger),
    )


def _state_changes(
    events, keys, order, signal, set_rules, conditional_rules, initial, state, max_rows, uncut=False
) -> OrderedRows:
    """Conditional rules that can neither enable nor contradict each other are running values; others are folded."""
    relevant = events.where(F.col(signal).isin([*set_rules, *conditional_rules]))
    plain = {name: rule for name, rule in conditional_rules.items() if isinstance(rule, tuple)}
    required = [before for before, _ in plain.values()]
    outcomes = dict(plain.values())
    apart = not any(outcomes[before] != after for before, after in plain.values())
    if len(plain) < len(conditional_rules) or not apart or any(after in required for after in outcomes.values()):
        rows = OrderedRows.of(relevant, keys, order, max_rows)
        return fold_states(rows, signal, set_rules, conditional_rules, initial, state)
    return _running_states(relevant, keys, order, signal, set_rules, plain, initial, state, max_rows, uncut)


def _running_states(
    relevant, keys, order, signal, set_rules, conditional_rules, initial, state, max_rows, uncut
) -> OrderedRows:
    """The fold written as running values.

    The last unconditional state (``_base``) decides whether a conditional rule fires. That is exact as
    long as firing one rule can never enable or alter another.
    """
    target = F.lit(None).cast("string")
    for name, new_state in set_rules.items():
        target = F.when(F.col(signal) == name, new_state).otherwise(target)
    rows = OrderedRows.of(relevant.withColumn("_target", target), keys, order, max_rows, uncut)
    # The states are those of the rules, so what is carried between slices is small.
    rows = rows.running_last("_target", "_base", bounded=True)

    reached = F.col("_target")
    base = F.coalesce("_base", F.lit(initial))
    for name, (before, after) in conditional_rules.items():
        fires = (F.col(signal) == name) & (base == before)
        reached = F.when(fires, after).otherwise(reached)
    rows = rows.with_df(rows.df.withColumn("_reached", reached))
    rows = rows.running_last("_reached", "_now", before="_before", bounded=True)

    now = F.coalesce("_now", F.lit(initial))
    before = F.coalesce("_before", F.lit(initial))
    changed = rows.with_df(rows.df.withColumn(state, now)).where(now != before)
    return changed.with_df(changed.df.drop("_target", "_base", "_reached", "_now", "_before"))
