"""Grouped statistics, filtered counts and distinct counts."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapwise.operators.slices import group_sizes, same_keys

# Values of one group that a task keeps in memory without trouble.
MAX_VALUES = 1_000_000
# Up to this many groups, what is known about each is broadcast; beyond, it is joined by a shuffle.
MAX_BROADCAST_GROUPS = 20_000
# A sketch of this accuracy misses ranks by at most 1/10,000 of the rows, which both margins exceed: of
# the bracket around the middle, and of the steps by which a wide bracket is narrowed.
SKETCH_ACCURACY = 10_000
BRACKET = (0.4998, 0.5002)
NARROWING_STEPS = 500


def grouped_summary(
    df: DataFrame,
    keys: Sequence[str],
    aggregates: Mapping[str, Column],
    medians: Mapping[str, str] | None = None,
    max_rows: int | None = MAX_VALUES,
) -> DataFrame:
    """One row per group: the named aggregates, and exact interpolated medians of the named columns.

    ``medians`` maps output names to columns. The built-in median keeps all distinct values of a group
    in the memory of one task, so it is used only if no group has more than ``max_rows`` rows; both ways give
    the same doubles, bit for bit. With medians ``df`` is read more than once: materialise it first if it is
    costly.
    """
    medians = dict(medians or {})
    _require_numbers(df, medians.values())
    plain = [column.alias(name) for name, column in aggregates.items()]
    if not medians or max_rows is None or _larger_groups(df, keys, max_rows).isEmpty():
        return df.groupBy(*keys).agg(*plain, *[F.median(c).alias(name) for name, c in medians.items()])

    result = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), *plain)
    for name, column in medians.items():
        median = grouped_median(df, keys, column, name, max_rows)
        pairs = [(k, f"_median_{k}") for k in keys]
        median = median.withColumnsRenamed(dict(pairs))
        result = result.join(median, same_keys(pairs), "left").drop(*[d for _, d in pairs])
    return result.select(*keys, *aggregates, *medians)


def grouped_median(
    df: DataFrame, keys: Sequence[str], value: str, out: str, max_rows: int = MAX_VALUES
) -> DataFrame:
    """Exact interpolated median per group, for groups of any size; groups without values are left out.

    For large groups, a bounded sketch first brackets the middle. Values below and above the bracket can
    not be the median and are only counted before anything is shuffled. What is left are the distinct
    values of a narrow band, which are ranked by their running count.
    """
    _require_numbers(df, [value])
    rows = df.select(*keys, F.col(value).cast("double").alias("_value")).where(F.col("_value").isNotNull())
    large = _larger_groups(rows, keys, max_rows)
    number, largest = large.agg(F.count(F.lit(1)), F.max("_rows")).first()
    spread = F.broadcast if number <= MAX_BROADCAST_GROUPS else lambda few: few
    pairs = [(k, f"_large_{k}") for k in keys]
    brackets = _brackets(rows, keys, large.withColumnsRenamed(dict(pairs)), pairs, spread)
    if number and largest * (BRACKET[1] - BRACKET[0]) > max_rows:
        brackets = _narrower(rows, keys, brackets, pairs, spread)
    rows = rows.join(spread(brackets), same_keys(pairs), "left")
    zone = (
        F.when(F.col("_value") < F.col("_bracket")[0], F.lit(-1))
        .when(F.col("_value") > F.col("_bracket")[1], F.lit(1))
        .otherwise(F.lit(0))
    )
    rows = rows.select(*keys, zone.alias("_zone"), "_value")
    inside = F.when(F.col("_zone") == 0, F.col("_value")).alias("_value")
    counts = rows.groupBy(*keys, "_zone", inside).agg(F.count(F.lit(1)).alias("_n"))

    group = Window.partitionBy(*keys)
    upto = group.orderBy("_zone", "_value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.withColumns({"_upto": F.sum("_n").over(upto), "_all": F.sum("_n").over(group)})
    lower, upper = F.floor((F.col("_all") - 1) / 2), F.floor(F.col("_all") / 2)
    middle = ranked.where((F.col("_upto") > lower) & (F.col("_upto") - F.col("_n") <= upper))
    found = middle.groupBy(*keys).agg(
        F.min("_value").alias("_low"), F.max("_value").alias("_high"), F.max(F.abs("_zone")).alias("_missed")
    )
    # Halfway as the built-in median puts it.
    median = F.when(F.col("_low") == F.col("_high"), F.col("_low")).otherwise(
        F.lit(0.5) * F.col("_low") + F.lit(0.5) * F.col("_high")
    )
    missed = F.raise_error(F.lit("the median lies outside its bracket")).cast("double")
    return found.select(*keys, F.when(F.col("_missed") > 0, missed).otherwise(median).alias(out))


def _require_numbers(df: DataFrame, columns: Iterable[str]) -> None:
    for column in columns:
        if not isinstance(df.schema[column].dataType, T.NumericType):
            raise TypeError(f"the median of {column} needs numbers")


def _larger_groups(df: DataFrame, keys: Sequence[str], max_rows: int) -> DataFrame:
    return group_sizes(df, keys).where(F.col("_rows") > max_rows)


def _brackets(rows: DataFrame, keys: Sequence[str], large: DataFrame, pairs, spread) -> DataFrame:
    """Values certain to enclose the middle of each large group."""
    names = large.select(*[d for _, d in pairs], F.lit(True).alias("_is_large"))
    ends = F.percentile_approx("_value", list(BRACKET), SKETCH_ACCURACY).alias("_bracket")
    sketched = rows.join(spread(names), same_keys(pairs)).groupBy(*keys).agg(ends)
    return sketched.withColumnsRenamed(dict(pairs))


def _narrower(rows: DataFrame, keys: Sequence[str], brackets: DataFrame, pairs, spread) -> DataFrame:
    """Brackets within brackets: a sketch of the values inside, read off where the middle has to be."""
    value, low, high = F.col("_value"), F.col("_bracket")[0], F.col("_bracket")[1]
    inside = (value >= low) & (value <= high)
    steps = [i / NARROWING_STEPS for i in range(NARROWING_STEPS + 1)]
    sketched = rows.join(spread(brackets), same_keys(pairs)).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_all"),
        F.count_if(value < low).alias("_below"),
        F.count_if(inside).alias("_inside"),
        F.percentile_approx(F.when(inside, value), steps, SKETCH_ACCURACY).alias("_grid"),
    )
    step = F.floor(((F.col("_all") - 1) / 2 - F.col("_below")) / F.col("_inside") * NARROWING_STEPS).cast("int")
    first = F.greatest(step - 1, F.lit(0))
    last = F.least(step + 2, F.lit(NARROWING_STEPS))
    bracket = F.array(F.col("_grid")[first], F.col("_grid")[last])
    return sketched.select(*keys, bracket.alias("_bracket")).withColumnsRenamed(dict(pairs))


def filtered_counts(
    df: DataFrame, conditions: Mapping[str, Column], total: str | None = None, **others: Column
) -> DataFrame:
    """One row, one count per condition (rows for which it is unknown are not counted), in one pass.

    ``total`` names a count of all rows, ``others`` further aggregates.
    """
    counts = [F.count_if(condition).alias(name) for name, condition in conditions.items()]
    first = [F.count(F.lit(1)).alias(total)] if total else []
    return df.agg(*first, *[column.alias(name) for name, column in others.items()], *counts)


def truth_counts(flag: str, prefix: str) -> dict[str, Column]:
    """Conditions splitting a nullable flag into its true, false and unknown rows."""
    column = F.col(flag)
    return {f"{prefix}_true": column, f"{prefix}_false": ~column, f"{prefix}_unknown": column.isNull()}


def distinct_keys(*columns: str) -> Column:
    """Number of distinct composite keys; keys with a null part are not counted."""
    return F.count_distinct(*[F.col(c) for c in columns])


def surplus_rows(df: DataFrame, key: Sequence[str], out: str = "surplus_rows") -> DataFrame:
    """One row: how many rows repeat the key of another row; null key parts count as equal."""
    per_key = df.groupBy(*key).count()
    return per_key.agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias(out))


def duplicate_groups(df: DataFrame, key: Sequence[str], out: str = "row_count") -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias(out)).where(F.col(out) > 1)


def run_extent(
    df: DataFrame, keys: Sequence[str], ordinal: str, first: str, last: str, count: str, **means: Column
) -> DataFrame:
    """First and last ordinal and number of rows of each run, with further aggregates."""
    return df.groupBy(*keys).agg(
        F.min(ordinal).alias(first),
        F.max(ordinal).alias(last),
        F.count(F.lit(1)).alias(count),
        *[column.alias(name) for name, column in means.items()],
    )
