"""Landed lines split into records to go on with and lines set aside, each with the reasons why."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapwise.functions import parse_utc

_BROKEN = "_corrupt_record"
_RESERVED = ("record", "reasons", "rejected")


class Quarantined(NamedTuple):
    """Accepted records; rejected lines as ``record`` and ``reasons``; numbers of ``lines``, ``accepted``, ``rejected``."""

    accepted: DataFrame
    rejected: DataFrame
    counts: dict[str, int]


def judge_records(
    lines: DataFrame, schema: T.StructType, times: Sequence[str] = (), required: Sequence[str] = (), text: str = "value"
) -> DataFrame:
    """Each line parsed once: the columns of ``schema``, the line as ``record``, and ``reasons`` to reject it, if any.

    ``times`` are text columns with ISO-8601 times, which become timestamps; ``required`` must not be null. Reasons, in
    the order of the schema: ``x: not a <type>``, ``x: no time``, ``x: missing``; a line that is no JSON object has the
    one reason ``not a JSON object``, and ``not of the schema`` stands for faults within nested values. Lines that are
    null or blank are none. What follows the first object on a line is ignored, as in Spark's own reader; columns that
    the schema does not have are, too.
    """
    clash = [f.name for f in schema.fields if f.name in (*_RESERVED, _BROKEN)]
    if clash:
        raise ValueError(f"reserved names in the schema: {', '.join(clash)}")
    unknown = (set(times) | set(required)) - set(schema.fieldNames())
    if unknown:
        raise ValueError(f"not in the schema: {', '.join(sorted(unknown))}")
    nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN}
    line = F.col("record")
    parsed = lines.select(F.col(text).alias("record")).where(line.rlike(r"\S"))
    parsed = parsed.withColumn("_parsed", F.from_json(line, nullable.add(_BROKEN, T.StringType()), options))
    values = {f.name: F.col("_parsed")[f.name] for f in schema.fields}
    columns = {name: parse_utc(value, strict=False) if name in times else value for name, value in values.items()}

    broken = F.col("_parsed")[_BROKEN].isNotNull()
    # Arrays of records are not lines of records; a text that parses to nothing at all is no object either.
    no_object = line.rlike(r"^\s*\[") | F.col("_parsed").isNull() | (broken & F.json_object_keys(line).isNull())

    def faults(field: T.StructField) -> list[Column]:
        name, value = field.name, values[field.name]
        given = F.get_json_object(line, f"$['{name}']").isNotNull()
        out = [F.when(broken & value.isNull() & given, f"{name}: not a {field.dataType.simpleString()}")]
        if name in times:
            out.append(F.when(value.isNotNull() & columns[name].isNull(), f"{name}: no time"))
        if name in required:
            out.append(F.when(value.isNull() & ~(broken & given), f"{name}: missing"))
        return out

    found = F.array_compact(F.array(*[fault for field in schema.fields for fault in faults(field)]))
    found = F.when(broken & (F.size(found) == 0), F.array(F.lit("not of the schema"))).otherwise(found)
    reasons = F.when(no_object, F.array(F.lit("not a JSON object"))).otherwise(found)
    return parsed.select(*[column.alias(name) for name, column in columns.items()], "record", reasons.alias("reasons"))


def quarantine(
    lines: DataFrame,
    path: str,
    schema: T.StructType,
    times: Sequence[str] = (),
    required: Sequence[str] = (),
    text: str = "value",
) -> Quarantined:
    """Judge the lines and write both kinds in one job, which also counts them; a folder for each below ``path``.

    Every line that is not blank ends up in one of the two. See ``judge_records`` for the rules.
    """
    judged = judge_records(lines, schema, times, required, text)
    judged = judged.withColumn("rejected", F.size("reasons") > 0)
    # Accepted records are not kept twice.
    judged = judged.withColumns(
        {"record": F.when(F.col("rejected"), F.col("record")), "reasons": F.when(F.col("rejected"), F.col("reasons"))}
    )
    counts = Observation()
    observed = judged.observe(
        counts,
        F.count(F.lit(1)).alias("lines"),
        F.count_if(~F.col("rejected")).alias("accepted"),
        F.count_if(F.col("rejected")).alias("rejected"),
    )
    observed.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("rejected").parquet(path)
    back = lines.sparkSession.read.schema(judged.schema).parquet(path)
    accepted = back.where("NOT rejected").select(*schema.fieldNames())
    return Quarantined(accepted, back.where("rejected").select("record", "reasons"), counts.get)
