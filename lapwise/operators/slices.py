"""Cut oversized keys along their ordering so that no single task has to sort a whole key.

A window partitioned by a key puts all rows of that key into one task. Where one key holds much of a
table, its rows are cut into *slices*: consecutive pieces of the ordering. Windows then run per
(key, slice), and what a slice needs from the slices before or after it is carried over through a
summary with one row per slice.

Which keys to cut is found by counting, where by quantile sketches of all of them, made in one pass. Every key or
value that is collected holds more than 1/MAX_CELLS of all rows, so there are never more than MAX_CELLS of them,
whatever the size of the table.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapwise.functions import interval_micros

# Rows of one key that a task sorts without trouble, spilling if it has to.
MAX_ROWS = 10_000_000
MAX_CELLS = 16_384
# Slices per MAX_ROWS rows of a key: some room for sketches, which are not exact, and for values that repeat.
FINENESS = 3
# Up to this many slices are listed, and their summaries broadcast if of bounded width.
MAX_LISTED_SLICES = 50_000
# Items that a sketch keeps per level; all of them and exact below the least.
LEAST_SKETCH, LARGEST_SKETCH = 1_024, 32_768

# Bytes of text that one axis looks at, and the axes a text column gets.
TEXT_BYTES, TEXT_AXES = 7, 8

_NULL_PLACE = -(2**63)
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)
_FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)


class HotKeyError(ValueError):
    """A key has more rows than a task should sort, and its order does not allow to cut it."""


def axes_of(df: DataFrame, order: Sequence[str]) -> list[tuple[str, int]]:
    """(column, part) by which rows may be cut, in order.

    Whole numbers and times are followed by the next order column where they tie. Text has an axis for every few
    bytes, and fractions one whose numbers may tie where the values differ; both end the list, as rows that are
    alike to the axes need not be alike to the order.
    """
    axes = []
    for column in order:
        kind = df.schema[column].dataType
        if kind == T.StringType():
            return axes + [(column, part) for part in range(TEXT_AXES)]
        if isinstance(kind, _FRACTIONAL):
            return [*axes, (column, 0)]
        if not isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType, *_INTEGRAL)):
            break
        axes.append((column, 0))
    return axes


def position(df: DataFrame, column: str, part: int = 0) -> Column:
    """The column, or a part of a text, as a whole number that never decreases where the column increases."""
    kind = df.schema[column].dataType
    if isinstance(kind, _FRACTIONAL):
        # By logarithm, so that all magnitudes are told apart; what is not a number sorts last, as in Spark.
        value = F.col(column).cast("double")
        size = F.least((F.log2(F.abs(value)) + 1075) * float(2**50), F.lit(float(2**62))).cast("long")
        size = F.when(value == 0, F.lit(0).cast("long")).otherwise(size)
        return F.when(F.isnan(value), F.lit(2**62 + 1)).when(value < 0, -size).otherwise(size)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(kind, T.TimestampNTZType):
        # Through an interval, which unlike a cast to TIMESTAMP does not depend on the session time zone.
        return interval_micros(F.col(column) - F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("long")
    if isinstance(kind, T.StringType):
        # A few bytes as one number; text is ordered by its bytes.
        digits = F.substring(F.hex(column), 1 + 2 * TEXT_BYTES * part, 2 * TEXT_BYTES)
        return F.conv(F.rpad(digits, 2 * TEXT_BYTES, "0"), 16, 10).cast("long")
    return F.col(column).cast("long")


def has_bounded_width(kind: T.DataType) -> bool:
    """Whether values of the type have a fixed size."""
    if isinstance(kind, T.StructType):
        return all(has_bounded_width(f.dataType) for f in kind.fields)
    return not isinstance(
        kind, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.VarcharType, T.CharType, T.VariantType)
    )


def same_keys(pairs: Sequence[tuple[str, str]]) -> Column:
    """Join condition over (left, right) column pairs that treats nulls as equal."""
    condition = F.lit(True)
    for left, right in pairs:
        condition = condition & F.col(left).eqNullSafe(F.col(right))
    return condition


def local_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """Collected rows as a DataFrame that is part of the plan and needs no Python on the executors."""
    arrays = []
    for i, field in enumerate(schema.fields):
        values = [row[i] for row in rows]
        if isinstance(field.dataType, T.TimestampType):
            # Spark hands out times in the zone of this process, without saying so.
            values = [value and value.astimezone(datetime.UTC) for value in values]
        arrays.append(pa.array(values))
    return spark.createDataFrame(pa.table(arrays, names=schema.fieldNames()), schema)


def group_sizes(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))


def large_groups(df: DataFrame, keys: Sequence[str], max_rows: int) -> DataFrame:
    """Keys with more than ``max_rows`` rows, at most MAX_CELLS of them.

    ``_limit`` is the limit applied: ``max_rows``, or 1/MAX_CELLS of all rows if that is more.
    """
    sizes = group_sizes(df, keys)
    total = sizes.agg(F.sum("_rows")).scalar()
    limit = F.greatest(F.lit(max_rows), F.ceil(total / MAX_CELLS)).cast("long")
    return sizes.withColumn("_limit", limit).where(F.col("_rows") > F.col("_limit"))


def _place(position: Column) -> Column:
    """Position with nulls first, below all others; the two lowest whole numbers share one."""
    return F.when(position.isNull(), F.lit(_NULL_PLACE)).otherwise(F.greatest(position, F.lit(_NULL_PLACE + 1)))


def _slice_of(place: Column, bounds: Column, most: int) -> Column:
    """How many of the ascending bounds, at most ``most``, are not above the place, by halving; -1 without bounds."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(most.bit_length()))])
    # Beyond the last bound nothing is read, which counts as not passed.
    passed = lambda found, step: F.get(bounds, found + step - 1) <= place
    found = F.aggregate(steps, F.lit(0), lambda found, step: F.when(passed(found, step), found + step).otherwise(found))
    return F.when(bounds.isNull(), F.lit(-1)).otherwise(found).cast("long")


@dataclass(frozen=True)
class Slices:
    """How the rows of each key are cut; without levels nothing is cut."""

    keys: tuple[str, ...]
    axes: tuple[tuple[str, int], ...] = ()
    # Per axis: keys and the slices before, with the ``_bounds`` between their slices; and the most bounds of any.
    levels: tuple[tuple[DataFrame, int], ...] = ()
    # All slices, if they are few enough to be listed.
    listed: DataFrame | None = None
    fine_enough: bool = True

    @property
    def columns(self) -> list[str]:
        """Names of the slice columns; comparing them in order compares the slices."""
        return [f"_slice_{i}" for i in range(len(self.levels))]

    def tag(self, df: DataFrame) -> DataFrame:
        """Add the slice columns; rows of keys that are not cut get -1."""
        places = {f"_axis_{i}": _place(position(df, *self.axes[i])) for i in range(len(self.levels))}
        return self.refine(df.withColumns(places)).drop(*places) if places else df

    def refine(self, df: DataFrame, first: int = 0) -> DataFrame:
        """``tag`` for rows that have the places along the axes, and the slice columns before ``first``."""
        for i, (bounds, most) in enumerate(self.levels[first:], first):
            pairs = [(c, f"_cell{c}") for c in [*self.keys, *self.columns[:i]]]
            cells = bounds.withColumnsRenamed(dict(pairs))
            number = _slice_of(F.col(f"_axis_{i}"), F.col("_bounds"), most)
            df = df.join(F.broadcast(cells), same_keys(pairs), "left").withColumn(f"_slice_{i}", number)
            df = df.drop("_bounds", *[d for _, d in pairs])
        return df

    def carry(
        self,
        df: DataFrame,
        contributes: Column,
        summary: Column,
        combine,
        out: str,
        from_later: bool = False,
        bounded: bool = False,
    ) -> DataFrame:
        """Add ``out``: ``combine`` over the ``summary`` of all earlier (or later) slices of the key.

        ``df`` must be tagged; ``contributes`` selects the rows to summarise. Summaries have one row per
        slice of a cut key. ``bounded`` vouches for their size where their type does not bound it.
        """
        if not self.levels:
            raise ValueError("nothing is cut, so there is nothing to carry")
        names = [*self.keys, *self.columns]
        pairs = [(c, f"_from{c}") for c in names]
        cut = df.where(F.col(self.columns[0]) >= 0)
        if self.listed is None:
            per_slice = cut.groupBy(*names).agg(summary.alias("_summary"))
            per_slice = per_slice.withColumnsRenamed(dict(pairs))
        else:
            # Rows that contribute nothing need not be read to learn which slices there are.
            filled = cut.where(contributes).groupBy(*names).agg(summary.alias("_summary"))
            every = self.listed.withColumnsRenamed(dict(pairs))
            per_slice = every.join(filled, same_keys(pairs), "left").drop(*names)

        order = [F.col(f"_from{c}") for c in self.columns]
        order = [c.desc() if from_later else c.asc() for c in order]
        before = Window.partitionBy(*[f"_from{k}" for k in self.keys]).orderBy(*order)
        before = before.rowsBetween(Window.unboundedPreceding, -1)
        carried = per_slice.select(*[d for _, d in pairs], combine(F.col("_summary")).over(before).alias(out))
        bounded = bounded or has_bounded_width(carried.schema[out].dataType)
        if bounded and self.listed is not None:
            carried = F.broadcast(carried)
        return df.join(carried, same_keys(pairs), "left").drop(*[d for _, d in pairs])


def find_slices(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    max_rows: int | None = MAX_ROWS,
    among: DataFrame | None = None,
) -> Slices:
    """Count rows per key and cut the keys that exceed ``max_rows``; ``None`` skips the counting.

    ``among`` may hold the keys of all these rows and of others, if it is read at less cost: where no key has too many
    rows in it, the rows themselves are not counted.

    Usually one pass over the key columns finds nothing to cut. Otherwise another one makes a quantile sketch of
    ``order[0]`` per large key, and slices start at quantiles. Where a value may be too frequent, slices are counted,
    and those of too many rows of one value are cut along the next order column in the same way. Sketches are exact
    up to a thousand rows; beyond, slices are larger than meant by the sketch's error, at most some limits even where
    one key has all rows.
    """
    keys = tuple(keys)
    axes = axes_of(df, order)
    if max_rows is None:
        return Slices(keys)

    if among is not None and group_sizes(among, keys).where(F.col("_rows") > max_rows).isEmpty():
        return Slices(keys)
    # Nothing but the keys is read, unless some key turns out to be too large.
    if group_sizes(df, keys).where(F.col("_rows") > max_rows).isEmpty():
        return Slices(keys)
    if not axes:
        return Slices(keys, fine_enough=False)
    large = large_groups(df, keys, max_rows).collect()
    if not large:
        return Slices(keys)

    spark, limit = df.sparkSession, large[0]["_limit"]
    fields = [T.StructField(k, df.schema[k].dataType, True) for k in keys]
    cells = {tuple(r[k] for k in keys): r["_rows"] for r in large}
    places = [_place(position(df, *axis)).alias(f"_axis_{i}") for i, axis in enumerate(axes)]
    rows = _rows_of(df.select(*keys, *places), keys, local_rows(spark, list(cells), T.StructType(fields)))
    levels: list[tuple[DataFrame, int]] = []
    done: list[tuple] = []
    for i in range(len(axes)):
        names = [f.name for f in fields]
        bounds, frequent = _bounds(rows, names, f"_axis_{i}", max(cells.values()), limit)
        schema = T.StructType([*fields, T.StructField("_bounds", T.ArrayType(T.LongType()))])
        most = max(len(b) for b in bounds.values())
        levels.append((local_rows(spark, [(*cell, b) for cell, b in bounds.items()], schema), most))
        fields = [*fields, T.StructField(f"_slice_{i}", T.LongType(), False)]
        if not frequent:
            # Every bound is the place of some row, so that no slice is empty.
            done += [(*cell, n) for cell, b in bounds.items() for n in range(1, len(b) + 1)]
            cells = {}
            break
        names.append(f"_slice_{i}")
        rows = Slices(keys, tuple(axes), tuple(levels)).refine(rows, i)
        sizes = {tuple(r)[:-1]: r["_rows"] for r in group_sizes(rows, names).collect()}
        cells = {cell: n for cell, n in sizes.items() if n > limit and cell in frequent}
        done += [cell for cell in sizes if cell not in cells]
        # Rows of the place that two numbers share can not be told apart by what follows.
        shared = any(bounds[cell[:-1]][cell[-1] - 1] == _NULL_PLACE + 1 for cell in cells)
        if not cells or shared:
            break
        if i + 1 < len(axes):
            rows = _rows_of(rows, names, local_rows(spark, list(cells), T.StructType(fields)))
    done = [(*cell, *[-1] * (len(fields) - len(cell))) for cell in [*done, *cells]]
    listed = local_rows(spark, done, T.StructType(fields)) if len(done) <= MAX_LISTED_SLICES else None
    return Slices(keys, tuple(axes), tuple(levels), listed, fine_enough=not cells)


def _rows_of(rows: DataFrame, names: Sequence[str], cells: DataFrame) -> DataFrame:
    pairs = [(c, f"_large_{c}") for c in names]
    return rows.join(F.broadcast(cells.withColumnsRenamed(dict(pairs))), same_keys(pairs)).drop(*[d for _, d in pairs])


def _bounds(
    rows: DataFrame, names: Sequence[str], axis: str, most_rows: int, limit: int
) -> tuple[dict[tuple, list[int]], set[tuple]]:
    """Per cell the places where its slices start, and the slices (cell and number) of a place that may be frequent.

    A place with more than ``limit`` rows spans two quantiles at least, and gets a slice of its own.
    """
    parts = -(-FINENESS * most_rows // limit)
    kept = min(max(LEAST_SKETCH, 1 << (8 * parts).bit_length()), LARGEST_SKETCH)
    # Ranks have to be constants, so all cells get those that the largest needs, and pick from them.
    ranks = ",".join(repr(n / (4 * parts)) for n in range(4 * parts))
    sketched = rows.groupBy(*names).agg(
        F.kll_sketch_agg_bigint(axis, F.lit(kept)).alias("_sketch"), F.count(F.lit(1)).alias("_rows")
    )
    all_quantiles = F.expr(f"kll_sketch_get_quantile_bigint(_sketch, CAST(split('{ranks}', ',') AS ARRAY<DOUBLE>))")
    own = F.least(F.ceil(F.col("_rows") * FINENESS / limit), F.lit(parts)).cast("int")
    # The first of every _parts-th of the list; a filter takes the list once, where a lambda would take it every time.
    picked = F.expr(
        f"filter(_all, (v, i) -> i = 0 OR i * _parts div {4 * parts}L > (i - 1) * _parts div {4 * parts}L)"
    )
    found = sketched.select(*names, own.alias("_parts"), all_quantiles.alias("_all")).select(*names, picked.alias("_q"))
    bounds, frequent = {}, set()
    for row in found.collect():
        cell, quantiles = tuple(row)[:-1], row["_q"]
        twice = {a for a, b in zip(quantiles, quantiles[1:]) if a == b}
        bounds[cell] = sorted({*quantiles, *(v + 1 for v in twice if v < 2**63 - 1)})
        frequent |= {(*cell, n) for n, v in enumerate(bounds[cell], 1) if v in twice}
    return bounds, frequent
