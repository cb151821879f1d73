"""Quality gates: profile a table in one pass, and raise if it breaks its rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapwise.operators.aggregates import duplicate_groups


class QualityError(ValueError):
    """A table breaks one of its rules."""


def key_report(
    df: DataFrame, key: Sequence[str], violations: Mapping[str, Column] | None = None
) -> DataFrame:
    """One row: rows, duplicate rows, nulls per key part and rows per violation.

    All checks share one aggregation by key, which starts before the shuffle. An unknown outcome is no
    violation.
    """
    violations = dict(violations or {})
    per_key = df.groupBy(*key).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(condition).alias(f"_bad_{name}") for name, condition in violations.items()],
    )
    none = F.lit(0).cast("long")
    return per_key.agg(
        F.coalesce(F.sum("_rows"), none).alias("rows"),
        F.coalesce(F.sum(F.col("_rows") - 1), none).alias("duplicate_rows"),
        *[F.coalesce(F.sum(F.when(F.col(k).isNull(), F.col("_rows"))), none).alias(f"null_{k}") for k in key],
        *[F.coalesce(F.sum(f"_bad_{name}"), none).alias(name) for name in violations],
    )


def require_key(
    df: DataFrame, key: Sequence[str], name: str, violations: Mapping[str, Column] | None = None
) -> dict[str, int]:
    """Raise unless the key is unique and complete and nothing violates a rule; return the report."""
    report = _passed(key_report(df, key, violations), name)
    return report


def key_metrics(key: Sequence[str], violations: Mapping[str, Column] | None = None) -> dict[str, Column]:
    """What ``key_report`` counts but duplicates, as plain aggregates: metrics of a job that does something else."""
    return {
        "rows": F.count(F.lit(1)),
        **{f"null_{k}": F.count_if(F.col(k).isNull()) for k in key},
        **{name: F.count_if(condition) for name, condition in (violations or {}).items()},
    }


def require_written_key(metrics: Mapping[str, int], written: DataFrame, key: Sequence[str], name: str) -> dict[str, int]:
    """Raise like ``require_key``: from the ``key_metrics`` of the job that wrote the table, and its key columns."""
    keys = written.groupBy(*key).agg(F.count(F.lit(1)).alias("_rows"))
    surplus = keys.agg(F.coalesce(F.sum(F.col("_rows") - 1), F.lit(0).cast("long"))).first()[0]
    return _required({"rows": metrics["rows"], "duplicate_rows": surplus, **metrics}, name)


def checked_report(
    df: DataFrame, key: Sequence[str], name: str, violations: Mapping[str, Column] | None = None
) -> DataFrame:
    """The report of ``require_key`` as a table of one row, computed once."""
    report = key_report(df, key, violations)
    found = _passed(report, name)
    return df.sparkSession.createDataFrame([tuple(found.values())], report.schema)


def _passed(report: DataFrame, name: str) -> dict[str, int]:
    return _required(report.first().asDict(), name)


def _required(report: dict[str, int], name: str) -> dict[str, int]:
    broken = {check: count for check, count in report.items() if check != "rows" and count}
    if broken:
        raise QualityError(f"{name}: " + ", ".join(f"{check} = {count}" for check, count in broken.items()))
    return report


def require_grain(df: DataFrame, key: Sequence[str], name: str) -> None:
    """Raise if any key has more than one row, naming a few of them."""
    examples = duplicate_groups(df, key).limit(5).collect()
    if examples:
        raise QualityError(f"{name} has more than one row for: {[r.asDict() for r in examples]}")


def require_periods(df: DataFrame, start: str, end: str, name: str) -> None:
    """Raise if a period does not end after it starts."""
    count = bad_periods(df, start, end).first()[0]
    if count:
        raise QualityError(f"{name}: {count} periods end before or when they start")


def bad_periods(df: DataFrame, start: str, end: str, out: str = "bad_periods") -> DataFrame:
    """One row: number of periods that do not end after they start."""
    return df.agg(F.count_if(F.col(start) >= F.col(end)).alias(out))


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: number of nulls per column, in one pass."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns or df.columns])


def profile(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, number of rows and of nulls."""
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"_nulls_{i}") for i, c in enumerate(df.columns)],
    )
    columns = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(field.name).alias("column"),
                F.lit(field.dataType.simpleString()).alias("type"),
                F.col("_rows").alias("rows"),
                F.col(f"_nulls_{i}").alias("nulls"),
            )
            for i, field in enumerate(df.schema.fields)
        ]
    )
    return counted.select(F.inline(columns))


def preview(df: DataFrame, order: Sequence[str], rows: int) -> DataFrame:
    """The first rows in the given order."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(rows)
