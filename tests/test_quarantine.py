"""Lines set aside, with their reasons."""

import datetime

import pytest
from pyspark.sql import types as T

from lapwise.sources.quarantine import judge_records, quarantine

SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("at", T.StringType()),
        T.StructField("flag", T.BooleanType()),
        T.StructField("inner", T.StructType([T.StructField("x", T.DoubleType())])),
    ]
)
CASES = {
    '{"id": 1, "at": "2024-01-01T00:00", "flag": true, "inner": {"x": 1.5}}': [],
    '{"id": 2}': [],
    '  {"id": 3, "extra": [1], "at": null}  ': [],
    '{"id": 4, "at": "soon"}': ["at: no time"],
    '{"at": "2024-01-01"}': ["id: missing"],
    '{"id": null}': ["id: missing"],
    '{"id": "x", "flag": 7}': ["id: not a bigint", "flag: not a boolean"],
    '{"id": 99999999999999999999}': ["id: not a bigint"],
    '{"id": 1.5, "at": "soon"}': ["id: not a bigint", "at: no time"],
    '{"id": 5, "inner": {"x": "far"}}': ["not of the schema"],
    '{"id": 6, "at": ': ["not a JSON object"],
    "[1, 2]": ["not a JSON object"],
    '[{"id": 7}, {"id": 8}]': ["not a JSON object"],
    "7": ["not a JSON object"],
    "null": ["not a JSON object"],
    "id,at": ["not a JSON object"],
    "{}": ["id: missing"],
}


def test_reasons(spark):
    lines = spark.createDataFrame([(line, 1) for line in [*CASES, None, "", " \t"]], "value string, reasons int")
    judged = judge_records(lines, SCHEMA, times=["at"], required=["id"])
    got = {r.record: r.reasons for r in judged.collect()}
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in CASES.items()}
    assert judged.columns == [*SCHEMA.fieldNames(), "record", "reasons"]


def test_every_line_is_in_one_of_both(spark, tmp_path):
    rows = [(line,) for line in [*CASES, *CASES, None, "  "]]
    lines = spark.createDataFrame(rows, "line string").repartition(3)
    split = quarantine(lines, str(tmp_path / "q"), SCHEMA, times=["at"], required=["id"], text="line")
    good = sum(not v for v in CASES.values())
    assert split.counts == {"lines": 2 * len(CASES), "accepted": 2 * good, "rejected": 2 * (len(CASES) - good)}
    assert split.accepted.count() == 2 * good and split.rejected.count() == 2 * (len(CASES) - good)
    assert sorted(r.record for r in split.rejected.collect()) == sorted(2 * [k for k, v in CASES.items() if v])
    first = split.accepted.where("id = 1").first()
    assert first["at"] == datetime.datetime(2024, 1, 1, tzinfo=datetime.UTC).astimezone().replace(tzinfo=None)
    assert (first["flag"], first["inner"]["x"]) == (True, 1.5)
    # Again in the same place: what was there goes, also of a kind that has no lines now.
    split = quarantine(lines.where("line = '{\"id\": 2}'"), str(tmp_path / "q"), SCHEMA, required=["id"], text="line")
    assert split.counts == {"lines": 2, "accepted": 2, "rejected": 0}
    assert (split.accepted.count(), split.rejected.count()) == (2, 0)
    empty = quarantine(lines.limit(0), str(tmp_path / "none"), SCHEMA, text="line")
    assert empty.counts == {"lines": 0, "accepted": 0, "rejected": 0} and empty.accepted.isEmpty()


def test_lines_are_parsed_once(spark):
    lines = spark.createDataFrame([("{}",)], "value string").repartition(2)
    judged = judge_records(lines, SCHEMA, times=["at"], required=["id"])
    assert judged._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_refused(spark):
    lines = spark.createDataFrame([("{}",)], "value string")
    with pytest.raises(ValueError, match="reserved names"):
        judge_records(lines, T.StructType([T.StructField("record", T.StringType())]))
    with pytest.raises(ValueError, match="not in the schema: when"):
        judge_records(lines, SCHEMA, times=["when"])
