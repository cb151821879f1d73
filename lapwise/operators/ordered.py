"""Ordered lookups within a key: previous, next and running values, for keys of any size."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from lapwise.operators.slices import MAX_ROWS, HotKeyError, Slices, find_slices


def _latest(column: Column) -> Column:
    return F.last(column, ignorenulls=True)


@dataclass(frozen=True)
class OrderedRows:
    """Rows with an ordering inside each key. Methods add a column and return the widened rows.

    All columns added through one instance share a single shuffle and sort.
    """

    df: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    slices: Slices

    @classmethod
    def of(
        cls,
        df: DataFrame,
        keys: Sequence[str],
        order: Sequence[str],
        max_rows: int | None = MAX_ROWS,
        uncut: bool = False,
    ) -> OrderedRows:
        """``order`` must decide between any two rows of a key that differ in what is looked up.

        Keys with more than ``max_rows`` rows are cut along the order columns. Where that leaves too many rows that
        the order can not tell apart, HotKeyError is raised, unless ``uncut`` is set or ``max_rows`` is None. For
        one sequence over a whole table, use a constant column as key.
        """
        if not keys:
            raise ValueError("at least one key column is needed")
        slices = find_slices(df, keys, order, max_rows)
        if not (slices.fine_enough or uncut):
            raise HotKeyError(
                f"more than {max_rows} rows of one key in {list(keys)} can not be cut along {list(order)}; "
                "add order columns that tell them apart, or pass max_rows=None to sort them in one task"
            )
        return cls.cut(df, keys, order, slices)

    @classmethod
    def cut(cls, df: DataFrame, keys: Sequence[str], order: Sequence[str], slices: Slices) -> OrderedRows:
        """With slices that were found before, for these or for more rows."""
        return cls(slices.tag(df), tuple(keys), tuple(order), slices)

    def with_df(self, df: DataFrame) -> OrderedRows:
        return replace(self, df=df)

    def where(self, condition) -> OrderedRows:
        return self.with_df(self.df.where(condition))

    def result(self) -> DataFrame:
        return self.df.drop(*self.slices.columns)

    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.keys, *self.slices.columns).orderBy(*self.order)

    def _position(self) -> Column:
        # A single column of a primitive type can be aggregated by hashing, a struct only by sorting.
        return F.col(self.order[0]) if len(self.order) == 1 else F.struct(*self.order)

    def previous(self, column: str, out: str) -> OrderedRows:
        """Value of the column in the row before, null in the first row of the key."""
        if not self.slices.levels:
            return self.with_df(self.df.withColumn(out, F.lag(column).over(self.window())))
        return self._neighbour(column, out, F.lag, F.max_by, from_later=False)

    def following(self, column: str, out: str) -> OrderedRows:
        """Value of the column in the row after, null in the last row of the key."""
        if not self.slices.levels:
            return self.with_df(self.df.withColumn(out, F.lead(column).over(self.window())))
        return self._neighbour(column, out, F.lead, F.min_by, from_later=True)

    def _neighbour(self, column, out, step, nearest, from_later) -> OrderedRows:
        # Wrapped in a struct so that a null value is told apart from a missing row.
        df = self.df.withColumn("_wrapped", F.struct(F.col(column).alias("value")))
        df = self.slices.carry(
            df,
            F.lit(True),
            nearest("_wrapped", self._position()),
            _latest,
            "_carried",
            from_later,
        )
        inside = step("_wrapped").over(self.window())
        df = df.withColumn(out, F.coalesce(inside, F.col("_carried"))["value"])
        return self.with_df(df.drop("_wrapped", "_carried"))

    def running_last(
        self, column: str, out: str, before: str | None = None, bounded: bool = False
    ) -> OrderedRows:
        """Most recent non-null value of the column up to the current row, and as ``before`` up to the last.

        ``bounded`` says that values are small even though their type does not tell.
        """
        frames = {out: self.window().rowsBetween(Window.unboundedPreceding, 0)}
        if before:
            frames[before] = self.window().rowsBetween(Window.unboundedPreceding, -1)
        inside = {name: F.last(column, ignorenulls=True).over(frame) for name, frame in frames.items()}
        if not self.slices.levels:
            return self.with_df(self.df.withColumns(inside))
        known = F.col(column).isNotNull()
        latest = F.max_by(column, F.when(known, self._position()))
        df = self.slices.carry(self.df, known, latest, _latest, "_carried", bounded=bounded)
        df = df.withColumns({name: F.coalesce(value, F.col("_carried")) for name, value in inside.items()})
        return self.with_df(df.drop("_carried"))

    def running_max(self, column: str, out: str) -> OrderedRows:
        """Largest value of the column up to and including the current row."""
        frame = self.window().rowsBetween(Window.unboundedPreceding, 0)
        inside = F.max(column).over(frame)
        if not self.slices.levels:
            return self.with_df(self.df.withColumn(out, inside))
        df = self.slices.carry(self.df, F.col(column).isNotNull(), F.max(column), F.max, "_carried")
        return self.with_df(df.withColumn(out, F.greatest(inside, F.col("_carried"))).drop("_carried"))
