"""Readers, writers and column expressions."""

import csv
import datetime
import json
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from lapwise.functions import (
    add_seconds,
    all_true,
    change_label,
    composite_key,
    parse_utc,
    seconds_between,
    sort_nulls_last,
    utc_wall_clock,
)
from lapwise.session import new_table_path, shuffle_tasks
from lapwise.sources import read, schemas, write


def landed(folder, name, data):
    path = folder / name
    path.write_text(json.dumps(data))
    return str(path)


def test_records_take_the_schema(spark, tmp_path):
    record = {"session_key": 1, "driver_number": 4, "stint_number": 1, "lap_start": None, "lap_end": 3, "extra": 1}
    path = landed(tmp_path, "stints.json", [record])
    df = read.read_records(spark, path, schemas.STINTS)
    assert df.columns == schemas.STINTS.fieldNames()
    row = df.first()
    assert (row["lap_start"], row["lap_end"], row["compound"]) == (None, 3, None)
    assert "extra" in read.read_records(spark, path, None).columns


def test_broken_records_raise(spark, tmp_path):
    path = tmp_path / "broken.json"
    path.write_text('[{"session_key": "not a number"}]')
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILFAST|not a number"):
        read.read_records(spark, str(path), schemas.STINTS).collect()


def test_parallel_arrays(spark, tmp_path):
    document = {"latitude": 1.0, "hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00"], "rain": [0.0, 0.5]}}
    path = landed(tmp_path, "weather.json", document)
    df = read.read_parallel_arrays(spark, path, schemas.HOURLY_WEATHER, "hourly")
    assert [(r["time"], r["rain"], r["temperature_2m"]) for r in df.collect()] == [
        ("2024-01-01T00:00", 0.0, None),
        ("2024-01-01T01:00", 0.5, None),
    ]


def test_parallel_arrays_of_unequal_length_raise(spark, tmp_path):
    document = {"hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00"], "rain": [0.0]}}
    path = landed(tmp_path, "weather.json", document)
    with pytest.raises(Exception, match="unequal length"):
        read.read_parallel_arrays(spark, path, schemas.HOURLY_WEATHER, "hourly").collect()


def test_landing_happens_once(spark, tmp_path):
    path = str(tmp_path / "raw")
    assert write.land_once(spark.range(3), path)
    assert not write.land_once(spark.range(10), path)
    assert spark.read.json(path).count() == 3


def test_landing_does_not_trust_what_a_lost_job_left(spark, tmp_path):
    (tmp_path / "raw" / "_temporary" / "0").mkdir(parents=True)
    with pytest.raises(RuntimeError, match="unfinished"):
        write.land_once(spark.range(3), str(tmp_path / "raw"))


def test_landing_after_a_failed_job(spark, tmp_path):
    path = str(tmp_path / "raw")
    broken = spark.range(3).select(F.when(F.col("id") < 2, F.col("id")).otherwise(F.raise_error(F.lit("lost"))).alias("id"))
    with pytest.raises(Exception, match="lost"):
        write.land_once(broken, path)
    # Either refused, or done over; never taken for landed data without rows.
    try:
        assert write.land_once(spark.range(3), path)
    except RuntimeError:
        return
    assert spark.read.json(path).count() == 3
    assert not write.land_once(spark.range(9), path)


def test_an_empty_folder_is_not_landed_data(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    assert write.land_once(spark.range(3), str(tmp_path / "raw"))
    assert spark.read.json(str(tmp_path / "raw")).count() == 3


def test_of_many_writers_one_lands(spark, tmp_path):
    path = str(tmp_path / "deep" / "raw")
    with ThreadPoolExecutor(4) as pool:
        wrote = list(pool.map(lambda n: write.land_once(spark.range(n, n + 3), path), range(0, 40, 10)))
    assert sorted(wrote) == [False, False, False, True]
    first = 10 * wrote.index(True)
    assert sorted(r.id for r in spark.read.json(path).collect()) == [first, first + 1, first + 2]
    assert [f.name for f in (tmp_path / "deep").iterdir()] == ["raw"]


def test_a_writer_that_fails_makes_room_for_the_next(spark, tmp_path):
    path = str(tmp_path / "raw")
    assert write._create_exclusive(spark, f"{tmp_path}/_claim-raw")
    assert not write._create_exclusive(spark, f"{tmp_path}/_claim-raw")
    with pytest.raises(RuntimeError, match="_claim-raw"):
        write.land_once(spark.range(3), path, wait=0.5)
    with ThreadPoolExecutor(1) as pool:
        waiting = pool.submit(write.land_once, spark.range(3), path)
        (tmp_path / "_claim-raw").unlink()
        assert waiting.result()
    assert spark.read.json(path).count() == 3


def test_csv_agrees_with_another_reader(spark, tmp_path):
    texts = ["plain", 'a "b" c', '"', "x,y", "line1\nline2", "", None, " spaced ", "\\", 'end\\"', "é\t"]
    df = spark.createDataFrame([(i, t, i / 4) for i, t in enumerate(texts)], "id int, s string, v double").coalesce(1)
    path = tmp_path / "c"
    write.export_csv(df, str(path))
    (file,) = path.glob("part-*.csv")
    with open(file, newline="", encoding="utf-8") as handle:
        rows = list(csv.reader(handle))
    assert rows[0] == ["id", "s", "v"]
    assert [r[1] for r in rows[1:]] == [t or "" for t in texts]
    back = {r.id: (r.s, r.v) for r in read.read_csv(spark, str(path), df.schema).collect()}
    assert back == {i: (t, i / 4) for i, t in enumerate(texts)}
    write.export_parquet(df, str(tmp_path / "p"))
    counts = write.export_counts(spark, df, str(tmp_path / "p"), str(path)).first()
    assert tuple(counts) == (len(texts),) * 3


def test_landed_files_of_others_are_left_alone(spark, tmp_path):
    path = landed(tmp_path, "raw.json", [{"id": 1}])
    assert not write.land_once(spark.range(3), path)


def test_processed_files_are_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    write.write_processed(spark.range(3), path)
    write.write_processed(spark.range(5), path, cluster_by=["id"])
    assert read.read_parquet(spark, path).count() == 5


def test_partitions_are_replaced_one_by_one(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "session_key long, v string")
    write.write_processed(rows, path, partition_by=["session_key"])
    write.write_processed(rows.where("session_key = 2").withColumn("v", F.lit("c")), path, partition_by=["session_key"])
    assert sorted((r["session_key"], r["v"]) for r in read.read_parquet(spark, path).collect()) == [(1, "a"), (2, "c")]


def test_registered_names_are_replaced(spark, tmp_path):
    for n in (2, 4):
        write.write_processed(spark.range(n), str(tmp_path / str(n)))
        read.register_tables(spark, {"numbers": str(tmp_path / str(n))})
    assert spark.sql("SELECT count(*) FROM numbers").first()[0] == 4
    for n in (2, 4):
        read.register_tables(spark, {"saved_numbers": str(tmp_path / str(n))}, save=True)
    assert spark.table("saved_numbers").count() == 4


def test_exports_keep_microseconds_and_turn_intervals_into_seconds(spark, tmp_path):
    stamp = datetime.datetime(2024, 3, 10, 2, 30, 0, 123456)
    df = spark.createDataFrame([(1, stamp, 'a, "b"'), (2, None, None)], "id int, t timestamp_ntz, s string")
    df = df.withColumn("gap", F.col("t") - F.lit(stamp - datetime.timedelta(seconds=23.5)).cast("timestamp_ntz"))
    parquet, text = str(tmp_path / "p"), str(tmp_path / "c")
    write.export_parquet(df, parquet)
    write.export_csv(df, text)
    expected = [(1, stamp, 'a, "b"', 23.5), (2, None, None, None)]
    assert sorted(map(tuple, spark.read.parquet(parquet).collect())) == expected
    schema = write.exportable(df).schema
    assert sorted(map(tuple, read.read_csv(spark, text, schema).collect())) == expected
    assert write.export_counts(spark, df, parquet, text).first().asDict() == {
        "table_rows": 2,
        "parquet_rows": 2,
        "csv_rows": 2,
    }


def test_shared_folder_is_the_configured_one(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert new_table_path(spark, "x").startswith(folder.rstrip("/"))
    assert new_table_path(spark, "x") != new_table_path(spark, "x")


def test_shuffles_grow_with_the_data():
    assert [shuffle_tasks(n) for n in (1, 10**12, 10**14)] == [200, 7451, 100_000]


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "text string")


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_times_without_offset_are_utc(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = texts(
            spark,
            "2024-11-03T16:24:31.874000+00:00",
            "2024-11-03T16:24:31.874",
            "2024-11-03T16:24",
            "2024-11-03T16:24:31Z",
            "2024-11-03T16:24:31.5+02:00",
            "2024-11-03 16:24+02:00",
            "2024-11-03T16:24Z",
            "2024-11-03",
            None,
        )
        got = [r[0] for r in df.select(utc_wall_clock(parse_utc("text"))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    day = datetime.datetime(2024, 11, 3)
    assert got == [
        day.replace(hour=16, minute=24, second=31, microsecond=874000),
        day.replace(hour=16, minute=24, second=31, microsecond=874000),
        day.replace(hour=16, minute=24),
        day.replace(hour=16, minute=24, second=31),
        day.replace(hour=14, minute=24, second=31, microsecond=500000),
        day.replace(hour=14, minute=24),
        day.replace(hour=16, minute=24),
        day,
        None,
    ]


def test_malformed_times_raise_unless_lenient(spark):
    df = texts(spark, "yesterday")
    assert df.select(parse_utc("text", strict=False)).first()[0] is None
    with pytest.raises(Exception, match="not an ISO-8601 time: yesterday"):
        df.select(parse_utc("text")).collect()


def test_time_arithmetic(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-03-10 01:59:59.9' AS t, 1.25D AS s, CAST(NULL AS DOUBLE) AS none")
    row = df.select(
        add_seconds("t", "s").alias("moved"),
        add_seconds("t", "none").alias("unknown"),
        seconds_between(add_seconds("t", "s"), "t").alias("gap"),
    ).first()
    assert row["moved"] == datetime.datetime(2024, 3, 10, 2, 0, 1, 150000)
    assert row["unknown"] is None and row["gap"] == 1.25


def test_flags_labels_and_keys(spark):
    df = spark.createDataFrame([(True, None, "a"), (True, True, None)], "x boolean, y boolean, s string")
    rows = df.select(
        all_true(F.col("x"), F.col("y")).alias("both"),
        composite_key("s", "x").alias("key"),
        change_label("s", F.lit("a")).alias("from_s"),
        change_label(F.lit("a"), "s").alias("to_s"),
    ).collect()
    assert [tuple(r) for r in rows] == [
        (False, "a-true", "SAME", "SAME"),
        (True, None, "CHANGE", "UNKNOWN"),
    ]


def test_nulls_sort_last_both_ways(spark):
    df = spark.createDataFrame([(None,), (2,), (1,)], "a int")
    assert [r[0] for r in sort_nulls_last(df, "a").collect()] == [1, 2, None]
    assert [r[0] for r in sort_nulls_last(df, "-a").collect()] == [2, 1, None]


def test_fingerprint_follows_the_files_of_a_table(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t"))
    first = read.fingerprint(spark, str(tmp_path / "t"))
    spark.read.parquet(str(tmp_path / "t")).count()
    assert read.fingerprint(spark, str(tmp_path / "t")) == first
    spark.range(5).write.mode("append").parquet(str(tmp_path / "t"))
    assert read.fingerprint(spark, str(tmp_path / "t")) != first


def test_files_follow_one_another_in_order(spark, tmp_path):
    rows = [(i % 7 if i % 11 else None, i, {"k": i}, f"a,{i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, i long, m map<string,long>, t string").repartition(5)
    expected = sorted(((k, i) for k, i, *_ in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write.export_parquet(df, str(tmp_path / "p"), order=["-k"])
        write.export_csv(df.drop("m"), str(tmp_path / "c"), order=["-k"])
        write.export_csv(df.drop("m").limit(0), str(tmp_path / "none"), order=["-k"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = write.files_in_order(spark, str(tmp_path / "p"), ".parquet")
    assert len(files) > 1
    assert [(r["k"], r["i"]) for f in files for r in spark.read.parquet(f).collect()] == expected
    lines = []
    for f in write.files_in_order(spark, str(tmp_path / "c"), ".csv"):
        with open(f) as handle:
            lines += list(csv.DictReader(handle))
    assert [(int(r["k"]) if r["k"] else None, int(r["i"])) for r in lines] == expected
    assert read.read_csv(spark, str(tmp_path / "none"), df.drop("m").schema).isEmpty()


def test_bucketed_tables_are_joined_without_a_shuffle(spark, tmp_path):
    keys = ["session_key", "driver_number"]
    laps = spark.createDataFrame([(i % 5, i % 3, i) for i in range(200)], "session_key long, driver_number long, lap long")
    drivers = spark.createDataFrame([(s, d, f"{s}-{d}") for s in range(5) for d in range(2)], "session_key long, driver_number long, name string")
    files = {}
    for name, df in (("bucket_laps", laps), ("bucket_drivers", drivers)):
        files[name] = str(tmp_path / name)
        df.write.parquet(files[name])
    read.register_tables(spark, files, save=True, folder=str(tmp_path / "t"), bucket_by={n: keys for n in files}, buckets=4)
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(threshold, "-1")
    try:
        joined = spark.table("bucket_laps").join(spark.table("bucket_drivers"), keys, "left").groupBy(*keys, "name").count()
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        got = {(r["session_key"], r["driver_number"], r["name"], r["count"]) for r in joined.collect()}
    finally:
        spark.conf.unset(threshold)
    expected = {}
    for i in range(200):
        key = (i % 5, i % 3, f"{i % 5}-{i % 3}" if i % 3 < 2 else None)
        expected[key] = expected.get(key, 0) + 1
    assert got == {(*k, n) for k, n in expected.items()}
    # A file for each bucket at most.
    assert len(write.files_in_order(spark, str(tmp_path / "t" / "bucket_laps"), ".parquet")) <= 4
    with pytest.raises(ValueError, match="only saved tables"):
        read.register_tables(spark, files, bucket_by={"bucket_laps": keys})
