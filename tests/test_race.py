"""The whole job on a small made-up race, with every edge case worked out by hand or by loops."""

import datetime
import json
import os
import statistics

import pytest
import race_fixture as race
from pyspark.sql import functions as F

from lapwise.operators.quality import QualityError
from lapwise.plans import mart, pipeline, reports
from lapwise.sources import schemas
from lapwise.sources.read import read_csv
from lapwise.sources.write import exportable


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    return tmp_path_factory.mktemp("race")


@pytest.fixture(scope="module")
def paths(spark, folder):
    return pipeline.process(spark, race.land(folder), str(folder / "processed"))


@pytest.fixture(scope="module")
def lap_mart(spark, paths, folder):
    return pipeline.build(spark, paths, str(folder)).cache()


def utc(value):
    if isinstance(value, datetime.datetime):
        return value.astimezone(datetime.UTC)
    return value


def keyed(mart_df):
    rows = exportable(mart_df).collect()
    return {(r["session_key"], r["driver_number"], r["lap_number"]): r for r in rows}


def test_mart_against_loops(lap_mart):
    got, expected = keyed(lap_mart), race.expected_mart()
    assert set(got) == set(expected)
    for key, row in expected.items():
        assert {name: utc(got[key][name]) for name in row} == row, key


def test_mart_columns(lap_mart):
    assert tuple(lap_mart.columns) == mart.MART_COLUMNS


def test_mart_edges(lap_mart):
    rows = keyed(lap_mart)
    assert rows[100, 1, 1]["weather_time"] is None  # before the first observation
    assert (rows[100, 1, 2]["weather_time_gap"], rows[100, 1, 2]["valid_weather_match"]) == (60.0, True)
    assert (rows[100, 2, 2]["weather_time_gap"], rows[100, 2, 2]["valid_weather_match"]) == (60.001, False)
    assert rows[100, 2, 2]["rainfall"] == 0  # kept though too old
    assert rows[100, 1, 3]["weather_time_gap"] == 0.0
    assert rows[100, 3, 4]["is_neutralised"] is None and rows[100, 2, 5]["is_neutralised"] is None
    assert rows[100, 4, 5]["is_neutralised"] is False  # starts when the period ends
    assert rows[100, 4, 8]["is_neutralised"] is False  # ends when the period starts
    assert rows[100, 3, 6]["valid_for_strategy"] is None  # in no stint with known bounds
    assert rows[200, 4, 2]["full_name"] is None


def test_race_status(spark, paths):
    status = spark.read.parquet(paths["race_status"]).select("session_key", "start_time", "end_time", "race_state", "trigger")
    got = sorted(tuple(utc(v) for v in r) for r in status.collect())
    assert got == [(s, race.clock(a), race.clock(b), state, trigger) for s, a, b, state, trigger in race.STATUS]


def test_hourly_weather(spark, paths):
    rows = spark.read.parquet(paths["hourly_weather"]).orderBy("time").collect()
    assert [utc(r["time"]) for r in rows] == [datetime.datetime(2024, 6, 1, h, tzinfo=datetime.UTC) for h in (13, 14)]
    assert rows[1]["wind_speed_10m"] is None and rows[1]["relative_humidity_2m"] == 82


def test_weather_keeps_extra_columns_on_request(spark, tmp_path):
    records = [{**r, "station": 7} for r in race.circuit_weather()]
    (tmp_path / "w.json").write_text(json.dumps(records))
    raw = {"circuit_weather": str(tmp_path / "w.json")}
    kept = pipeline.process(spark, raw, str(tmp_path / "kept"), keep_extra=True)
    assert "station" in spark.read.parquet(kept["circuit_weather"]).columns
    fixed = pipeline.process(spark, raw, str(tmp_path / "fixed"))
    assert spark.read.parquet(fixed["circuit_weather"]).columns == schemas.CIRCUIT_WEATHER.fieldNames()


def test_partitioned_by_session_gives_the_same_mart(spark, folder, tmp_path, lap_mart):
    paths = pipeline.process(spark, race.land(tmp_path), str(tmp_path / "p"), partition_by=["session_key"])
    tables = {name: spark.read.parquet(path) for name, path in paths.items()}
    again = mart.build_mart(tables)
    assert sorted(map(str, exportable(again).collect())) == sorted(map(str, exportable(lap_mart).collect()))


def test_cut_sessions_give_the_same_mart(spark, paths, lap_mart):
    tables = {name: spark.read.parquet(path) for name, path in paths.items()}
    cut = mart.build_mart(tables, max_rows=5)
    assert sorted(map(str, exportable(cut).collect())) == sorted(map(str, exportable(lap_mart).collect()))


def test_summary(lap_mart):
    rows = race.expected_mart().values()
    assert mart.mart_summary(lap_mart).first().asDict() == {
        "total_rows": 96,
        "unique_laps": 96,
        "valid_pace_laps": sum(r["valid_for_pace"] for r in rows),
        "valid_strategy_laps": sum(r["valid_for_strategy"] is True for r in rows),
        "valid_weather_laps": sum(r["valid_weather_match"] for r in rows),
        "pit_stop_laps": 9,
        "neutralised_laps": sum(r["is_neutralised"] is True for r in rows),
        "non_neutralised_laps": sum(r["is_neutralised"] is False for r in rows),
        "unknown_neutralisation_laps": sum(r["is_neutralised"] is None for r in rows),
        "valid_green_flag_pace_laps": sum(r["valid_green_flag_pace"] for r in rows),
    }


def test_overlapping_stints_fail_the_grain_gate(spark, paths, tmp_path):
    tables = {name: spark.read.parquet(path) for name, path in paths.items()}
    extra = tables["stints"].where("driver_number = 1 AND stint_number = 1").withColumn("stint_number", F.lit(9).cast("long"))
    tables["stints"] = tables["stints"].unionByName(extra)
    with pytest.raises(QualityError, match="more than one row"):
        mart.check_grain(mart.build_mart(tables))


@pytest.mark.parametrize(
    "dataset, change",
    [
        ("laps", lambda rows: rows + rows[:1]),
        ("laps", lambda rows: [{**rows[0], "lap_number": 0}, *rows[1:]]),
        ("laps", lambda rows: [{**rows[0], "driver_number": None}, *rows[1:]]),
        ("drivers", lambda rows: rows + rows[:1]),
        ("stints", lambda rows: [{**rows[0], "stint_number": None}, *rows[1:]]),
        ("pit_stops", lambda rows: rows + rows[-1:]),
        ("circuit_weather", lambda rows: [{**rows[0], "date": None}, *rows[1:]]),
    ],
)
def test_broken_datasets_are_refused_and_not_written(spark, tmp_path, dataset, change):
    path = tmp_path / f"{dataset}.json"
    path.write_text(json.dumps(change(getattr(race, dataset)())))
    with pytest.raises(QualityError, match=dataset):
        pipeline.process(spark, {dataset: str(path)}, str(tmp_path / "out"))
    assert not (tmp_path / "out").exists()


def test_messages_at_one_instant_fail_the_period_gate(spark, tmp_path):
    records = race.race_control() + [{**race.race_control()[1], "message": "SAFETY CAR DEPLOYED", "category": "SafetyCar"}]
    (tmp_path / "rc.json").write_text(json.dumps(records))
    with pytest.raises(QualityError, match="race_status"):
        pipeline.process(spark, {"race_control": str(tmp_path / "rc.json")}, str(tmp_path / "out"))


def green(include_unknown_pit_out):
    rows = race.expected_mart()
    return [
        (key, r)
        for key, r in rows.items()
        if r["valid_for_pace"]
        and r["valid_weather_match"]
        and not r["is_pit_stop"]
        and (r["is_pit_out_lap"] is False or (include_unknown_pit_out and r["is_pit_out_lap"] is None))
        and r["is_neutralised"] is False
    ]


def test_the_two_definitions_of_a_clean_lap_differ():
    assert len(green(True)) > len(green(False)) > 0


def test_pace_by_rainfall(lap_mart):
    got = reports.pace_by_rainfall(lap_mart).collect()
    assert [r["rainfall"] for r in got] == [0, 1]
    for row in got:
        times = [r["lap_duration"] for _, r in green(False) if r["rainfall"] == row["rainfall"]]
        assert row["lap_count"] == len(times)
        assert row["median_lap_time"] == pytest.approx(statistics.median(times), abs=6e-4)
        assert row["average_lap_time"] == pytest.approx(statistics.mean(times), abs=6e-4)
        assert (row["fastest_lap"], row["slowest_lap"]) == (min(times), max(times))


def test_green_flag_sample(lap_mart):
    got = {r["rainfall"]: r["lap_count"] for r in reports.green_flag_sample(lap_mart).collect()}
    for rainfall, count in got.items():
        assert count == sum(r["rainfall"] == rainfall for _, r in green(True))


def test_pace_by_lap_and_ranges(lap_mart):
    per_lap = reports.pace_by_lap(lap_mart, by_session=True).collect()
    assert per_lap == sorted(per_lap, key=lambda r: (r["session_key"], r["lap_number"], r["rainfall"]))
    assert sum(r["driver_laps"] for r in per_lap) == len(green(False))
    chosen = reports.pace_in_lap_ranges(lap_mart, [(2, 3), (9, 9)]).collect()
    assert {r["lap_number"] for r in chosen} <= {2, 3, 9}
    assert sum(r["driver_laps"] for r in chosen) == sum(key[2] in (2, 3, 9) for key, _ in green(False))


def test_rainfall_changes(lap_mart):
    expected = []
    for session in race.SESSIONS:
        rows = [r for key, r in race.expected_mart().items() if key[0] == session and r["valid_weather_match"]]
        previous = None
        for time, rainfall in sorted({(r["weather_time"], r["rainfall"]) for r in rows}):
            if previous is None or rainfall != previous:
                expected.append((session, time, previous, rainfall))
            previous = rainfall
    got = [tuple(utc(v) for v in r) for r in reports.rainfall_changes(lap_mart).collect()]
    assert got == expected


def test_tyre_reports(lap_mart):
    usage = {r["compound"]: r["driver_laps"] for r in reports.compound_usage(lap_mart).collect()}
    assert usage == {"INTERMEDIATE": 2 * (12 + 9 + 5 + 11), "WET": 2 * (3 + 5)}
    assert [r["compound"] for r in reports.compound_usage(lap_mart).collect()] == ["INTERMEDIATE", "WET"]
    stints = reports.strategy_by_stint(lap_mart, by_session=True).where("session_key = 100 AND driver_number = 2").collect()
    assert [(r["stint_number"], r["compound"], r["first_lap"], r["last_lap"], r["driver_laps"]) for r in stints] == [
        (1, "INTERMEDIATE", 1, 6, 6),
        (2, "WET", 7, 9, 3),
        (3, "INTERMEDIATE", 10, 12, 3),
    ]
    wet = reports.compound_stints(lap_mart, "WET", by_session=True).collect()
    assert all(r["rainfall_rate"] is not None for r in wet)
    matched = [r for _, r in race.expected_mart().items() if r["compound"] == "WET" and r["valid_weather_match"]]
    assert sum(r["driver_laps"] for r in wet) == len(matched)


def test_pit_stop_reports(lap_mart):
    stops = reports.pit_stops(lap_mart).collect()
    assert len(stops) == 9
    assert [(r["lap_number"], r["driver_number"]) for r in stops] == sorted((r["lap_number"], r["driver_number"]) for r in stops)
    matched = [r for r in race.expected_mart().values() if r["is_pit_stop"] and r["valid_weather_match"]]
    assert sum(r["pit_stops"] for r in reports.pit_stops_by_lap(lap_mart).collect()) == len(matched)
    assert sum(r["pit_stops"] for r in reports.pit_stops_by_rainfall(lap_mart).collect()) == len(matched)


def test_compound_changes(lap_mart):
    changes = reports.compound_changes(lap_mart, by_session=True).where("session_key = 100").collect()
    got = {(r["driver_number"], r["pit_lap"]): (r["old_compound"], r["new_compound"], r["change_type"]) for r in changes}
    assert got == {
        (1, 6): ("INTERMEDIATE", "INTERMEDIATE", "SAME COMPOUND"),
        (2, 6): ("INTERMEDIATE", "WET", "COMPOUND CHANGE"),
        (2, 9): ("WET", "INTERMEDIATE", "COMPOUND CHANGE"),
        (3, 7): (None, "INTERMEDIATE", "COMPOUND CHANGE"),  # the old compound is unknown
        (4, 12): ("INTERMEDIATE", None, "UNKNOWN"),  # last lap
    }


def test_headline_figures(lap_mart):
    row = reports.headline_figures(lap_mart).first()
    wet = statistics.median(r["lap_duration"] for _, r in green(False) if r["rainfall"] == 1)
    dry = statistics.median(r["lap_duration"] for _, r in green(False) if r["rainfall"] == 0)
    assert row["pit_events"] == 9
    assert row["median_difference"] == pytest.approx(wet - dry, abs=6e-3)
    assert row["dry_median"] == pytest.approx(dry, abs=6e-3)


def test_race_control_in_lap_ranges(spark, paths):
    log = spark.read.parquet(paths["race_control"])
    got = reports.race_control_in_lap_ranges(log, [(2, 2), (8, 9)], by_session=True).collect()
    laps = [int(s // 90) + 1 for _, s, *_ in race.MESSAGES]
    assert len(got) == sum(lap in (2, 8, 9) for lap in laps)
    assert got == sorted(got, key=lambda r: (r["session_key"], r["date"]))


def test_export(spark, lap_mart, tmp_path):
    counts = pipeline.export(spark, lap_mart, str(tmp_path)).first().asDict()
    assert counts == {"table_rows": 96, "parquet_rows": 96, "csv_rows": 96}
    flat = exportable(lap_mart)
    assert dict(flat.dtypes)["weather_time_gap"] == "double"
    expected = sorted(map(str, flat.collect()))
    assert sorted(map(str, spark.read.parquet(str(tmp_path / "lap_mart.parquet")).collect())) == expected
    assert sorted(map(str, read_csv(spark, str(tmp_path / "lap_mart.csv"), flat.schema).collect())) == expected


def test_landed_records_are_parsed_once_and_counted_while_written(spark, tmp_path, monkeypatch):
    """Rows that leave the parser are as many as there are records, gate and writing together."""
    parsed = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(key):
        parsed.add(1)
        return key

    read = pipeline.read_records

    def reading(*args):
        records = read(*args)
        return records.withColumn("session_key", counted.asNondeterministic()("session_key"))

    monkeypatch.setattr(pipeline, "read_records", reading)
    raw = {name: path for name, path in race.land(tmp_path).items() if name in ("laps", "pit_stops")}
    paths = pipeline.process(spark, raw, str(tmp_path / "p"))
    assert parsed.value == sum(spark.read.parquet(path).count() for path in paths.values()) > 0


@pytest.mark.parametrize("partition_by", [(), ("session_key",)])
def test_a_failing_gate_leaves_the_tables_in_use(spark, tmp_path, partition_by):
    raw, folder = race.land(tmp_path), str(tmp_path / "p")
    paths = pipeline.process(spark, raw, folder, partition_by=partition_by)
    before = {name: sorted(spark.read.parquet(path).collect(), key=str) for name, path in paths.items()}
    (tmp_path / "broken.json").write_text(json.dumps(race.laps() + race.laps()[:1]))
    with pytest.raises(QualityError, match="laps: duplicate_rows = 1"):
        pipeline.process(spark, raw | {"laps": str(tmp_path / "broken.json")}, folder, partition_by=partition_by)
    assert {name: sorted(spark.read.parquet(path).collect(), key=str) for name, path in paths.items()} == before
    assert not [name for name in os.listdir(tmp_path) if "staged" in name]
    # And a run that holds replaces them.
    pipeline.process(spark, raw, folder, partition_by=partition_by)
    assert {name: sorted(spark.read.parquet(path).collect(), key=str) for name, path in paths.items()} == before
