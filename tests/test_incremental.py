"""Loads of changed sessions against builds of the whole."""

import json
import shutil

import pytest
import race_fixture as race
from pyspark.sql import functions as F

from lapwise.catalog import race as race_queries
from lapwise.operators.quality import QualityError
from lapwise.plans import incremental, mart, pipeline
from lapwise.sources.write import exportable

RECORDS = {name: getattr(race, name) for name in incremental.INPUTS}


def land(folder, dataset, records):
    """One file of records, a line each, in the folder of each session."""
    for session in {r["session_key"] for r in records}:
        path = folder / "raw" / dataset / f"session_key={session}"
        path.mkdir(parents=True, exist_ok=True)
        own = [{k: v for k, v in r.items() if k != "session_key"} for r in records if r["session_key"] == session]
        (path / "part.json").write_text("".join(json.dumps(r) + "\n" for r in own))


def land_all(folder):
    for dataset, records in RECORDS.items():
        land(folder, dataset, records())
    return {dataset: str(folder / "raw" / dataset) for dataset in RECORDS}


def rows(df):
    return sorted(map(str, exportable(df.select(*mart.MART_COLUMNS)).collect()))


@pytest.fixture(scope="module")
def whole(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("whole")
    raw = {d: p for d, p in race.land(folder).items() if d in RECORDS}
    return rows(pipeline.build(spark, pipeline.process(spark, raw, str(folder / "p")), str(folder)))


def reading(spark, monkeypatch):
    """Counts the records that leave the parser."""
    parsed = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(key):
        parsed.add(1)
        return key

    def counting(clean):
        return lambda records: clean(records.withColumn("meeting_key", counted.asNondeterministic()("meeting_key")))

    datasets = {dataset: (schema, counting(clean)) for dataset, (schema, clean) in incremental.DATASETS.items()}
    monkeypatch.setattr(incremental, "DATASETS", datasets)
    return parsed


def changed(df):
    return {tuple(r) for r in df.collect()}


def test_second_load_reads_only_what_changed(spark, tmp_path, whole, monkeypatch):
    raw, folder = land_all(tmp_path), str(tmp_path / "tables")
    land(tmp_path, "laps", [r for r in race.laps() if r["session_key"] == 100 or r["lap_number"] < 5])
    assert len(changed(incremental.load(spark, raw, folder))) == 2 * len(raw)
    assert rows(incremental.loaded_mart(spark, folder)) != whole

    land(tmp_path, "laps", [r for r in race.laps() if r["session_key"] == 200])
    parsed = reading(spark, monkeypatch)
    assert changed(incremental.load(spark, raw, folder)) == {("laps", 200, "changed")}
    assert parsed.value == sum(r["session_key"] == 200 for r in race.laps())
    assert rows(incremental.loaded_mart(spark, folder)) == whole

    # Nothing changed: nothing is read.
    assert changed(incremental.load(spark, raw, folder)) == set()
    assert parsed.value == sum(r["session_key"] == 200 for r in race.laps())
    assert sorted(p.name for p in tmp_path.iterdir()) == ["raw", "tables"]


def test_sessions_come_and_go(spark, tmp_path, whole):
    raw, folder = land_all(tmp_path), str(tmp_path / "tables")
    for dataset, records in RECORDS.items():
        land(tmp_path, dataset, [r | {"session_key": 300} for r in records() if r["session_key"] == 100])
        shutil.rmtree(tmp_path / "raw" / dataset / "session_key=200")
    incremental.load(spark, raw, folder)
    sessions = incremental.loaded_mart(spark, folder).select("session_key").distinct()
    assert {r[0] for r in sessions.collect()} == {100, 300}
    for dataset in RECORDS:
        shutil.rmtree(tmp_path / "raw" / dataset / "session_key=300")
    land_all(tmp_path)
    kinds = {(s, k) for _, s, k in changed(incremental.load(spark, raw, folder))}
    assert {(200, "new"), (300, "gone")} <= kinds
    assert rows(incremental.loaded_mart(spark, folder)) == whole
    # A dataset of a session goes, the rest stays: its laps have no pit stops.
    shutil.rmtree(tmp_path / "raw" / "pit_stops" / "session_key=200")
    assert changed(incremental.load(spark, raw, folder)) == {("pit_stops", 200, "gone")}
    loaded = incremental.loaded_mart(spark, folder)
    assert loaded.count() == len(whole)
    assert loaded.where("session_key = 200 AND is_pit_stop").isEmpty()
    assert not loaded.where("session_key = 100 AND is_pit_stop").isEmpty()


def test_a_failing_gate_changes_nothing(spark, tmp_path, whole):
    raw, folder = land_all(tmp_path), str(tmp_path / "tables")
    incremental.load(spark, raw, folder)
    land(tmp_path, "laps", [*race.laps(), race.laps()[0]])
    with pytest.raises(QualityError, match="laps: duplicate_rows = 1"):
        incremental.load(spark, raw, folder)
    assert rows(incremental.loaded_mart(spark, folder)) == whole
    assert sorted(p.name for p in tmp_path.iterdir()) == ["raw", "tables"]
    land(tmp_path, "laps", race.laps()[1:])
    incremental.load(spark, raw, folder)
    assert incremental.loaded_mart(spark, folder).count() == len(whole) - 1


@pytest.mark.parametrize("lost_at", [1, 3])
def test_a_lost_load_is_done_again(spark, tmp_path, whole, monkeypatch, lost_at):
    raw, folder = land_all(tmp_path), str(tmp_path / "tables")
    land(tmp_path, "laps", [r for r in race.laps() if r["lap_number"] < 5])
    land(tmp_path, "pit_stops", race.pit_stops()[:2])
    incremental.load(spark, raw, folder)
    land_all(tmp_path)
    publish, done = incremental.publish, []

    def losing(*args):
        if len(done) == lost_at:
            raise RuntimeError("lost")
        done.append(args)
        publish(*args)

    monkeypatch.setattr(incremental, "publish", losing)
    with pytest.raises(RuntimeError, match="lost"):
        incremental.load(spark, raw, folder)
    monkeypatch.setattr(incremental, "publish", publish)
    incremental.load(spark, raw, folder)
    assert rows(incremental.loaded_mart(spark, folder)) == whole


def test_odd_landings(spark, tmp_path):
    raw, folder = land_all(tmp_path), str(tmp_path / "tables")
    with pytest.raises(ValueError, match="no landed folder of laps"):
        incremental.load(spark, {d: p for d, p in raw.items() if d != "laps"}, folder)
    (tmp_path / "flat").mkdir()
    assert incremental.landed_files(spark, {"laps": str(tmp_path / "flat")}).isEmpty()
    (tmp_path / "flat" / "laps.json").write_text("{}")
    with pytest.raises(ValueError, match="a folder per session"):
        incremental.load(spark, raw | {"laps": str(tmp_path / "flat")}, folder)
    (tmp_path / "_claim-tables").touch()
    with pytest.raises(RuntimeError, match="another writer"):
        incremental.load(spark, raw, folder)


def test_plans(spark, tmp_path):
    raw, folder = land_all(tmp_path), str(tmp_path / "tables")
    listing = incremental.landed_files(spark, raw)._jdf.queryExecution().toString()
    assert "content" not in listing.split("== Physical Plan ==")[1]
    incremental.load(spark, raw, folder)
    # A report on the sessions that another table names reads their folders only.
    named = spark.createDataFrame([(100, "wet"), (200, "dry")], "session_key long, kind string")
    named.write.parquet(str(tmp_path / "named"))
    named = spark.read.parquet(str(tmp_path / "named")).where("kind = 'wet'").select("session_key")
    report = incremental.loaded_mart(spark, folder).join(F.broadcast(named), "session_key").groupBy("compound").count()
    assert sum(r["count"] for r in report.collect()) == 48
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan


def by_thousand():
    return incremental.Blocks("block", F.floor(F.col("session_key") / 1000))


def land_blocks(folder, dataset, records):
    """One file of records, a line each, in the folder of each thousand of sessions."""
    for block in {r["session_key"] // 1000 for r in records}:
        path = folder / "raw" / dataset / f"block={block}"
        path.mkdir(parents=True, exist_ok=True)
        own = [r for r in records if r["session_key"] // 1000 == block]
        (path / "part.json").write_text("".join(json.dumps(r) + "\n" for r in own))


def test_blocks_of_sessions(spark, tmp_path, whole, monkeypatch):
    """Folders, and with them what is listed and collected, go with the blocks."""
    folder = str(tmp_path / "tables")
    raw = {dataset: str(tmp_path / "raw" / dataset) for dataset in RECORDS}
    later = {d: [r | {"session_key": r["session_key"] + 5000} for r in records()] for d, records in RECORDS.items()}
    for dataset, records in RECORDS.items():
        # 100 and 200 are in block 0, 5100 and 5200 in block 5.
        land_blocks(tmp_path, dataset, records() + later[dataset])
    land_blocks(tmp_path, "laps", [r for r in race.laps() if r["lap_number"] < 5])
    first = changed(incremental.load(spark, raw, folder, blocks=by_thousand()))
    assert first == {(dataset, block, "new") for dataset in RECORDS for block in (0, 5)}
    assert {p.name for p in (tmp_path / "tables" / "lap_mart").glob("*=*")} == {"block=0", "block=5"}

    land_blocks(tmp_path, "laps", race.laps())
    parsed = reading(spark, monkeypatch)
    assert changed(incremental.load(spark, raw, folder, blocks=by_thousand())) == {("laps", 0, "changed")}
    assert parsed.value == len(race.laps())
    loaded = incremental.loaded_mart(spark, folder)
    assert rows(loaded.where("session_key < 1000")) == whole
    assert loaded.count() == 2 * len(whole)

    for dataset in RECORDS:
        shutil.rmtree(tmp_path / "raw" / dataset / "block=5")
    gone = changed(incremental.load(spark, raw, folder, blocks=by_thousand()))
    assert gone == {(dataset, 5, "gone") for dataset in RECORDS}
    assert rows(incremental.loaded_mart(spark, folder)) == whole

    (tmp_path / "empty").mkdir()
    nothing = dict.fromkeys(raw, str(tmp_path / "empty"))
    with pytest.raises(ValueError, match="other blocks"):
        incremental.load(spark, nothing, folder, blocks=incremental.Blocks("season", F.col("session_key")))
    shutil.copytree(tmp_path / "raw" / "laps" / "block=0", tmp_path / "raw" / "laps" / "block=7")
    with pytest.raises(Exception, match="not in its folder of block: session [12]00"):
        incremental.load(spark, raw, folder, blocks=by_thousand())
    assert rows(incremental.loaded_mart(spark, folder)) == whole


def test_the_query_has_no_folder_per_session(spark, tmp_path, monkeypatch):
    sessions, tables = 40, tmp_path / "tables"
    derived = {
        "orders": "SELECT id * 1500 AS o_orderkey, id AS o_custkey, 'O' AS o_orderstatus, 100.5 + id AS o_totalprice, "
        f"'3-MEDIUM' AS o_orderpriority FROM range({sessions})",
        "customer": "SELECT id AS c_custkey, 'Customer#' || (100 + id) AS c_name, id AS c_nationkey, 1D AS c_acctbal, "
        f"'BUILDING' AS c_mktsegment FROM range({sessions})",
        "nation": f"SELECT id AS n_nationkey, 'N' || id AS n_name FROM range({sessions})",
        "lineitem": "SELECT o.id * 1500 AS l_orderkey, 5D AS l_quantity, 'R' AS l_returnflag, 'O' AS l_linestatus "
        f"FROM range({sessions}) o, range(4)",
        "events": "SELECT id * 100 AS event_id, TIMESTAMP'2024-01-01 00:00:01' AS ts, "
        f"element_at(array('view', 'error', 'signup'), CAST(id % 3 AS INT) + 1) AS event_type, 2D * id AS value "
        f"FROM range({10 * sessions})",
    }
    for name, sql in derived.items():
        df = spark.sql(sql)
        df = df.withColumn("ts", F.col("ts").cast("timestamp_ntz")) if name == "events" else df
        df = df.withColumn("o_totalprice", F.col("o_totalprice").cast("double")) if name == "orders" else df
        df.write.parquet(f"{tables}/{name}.parquet")
    monkeypatch.setattr(race_queries, "new_table_path", lambda spark, name: str(tmp_path / name))
    loaded = race_queries.incremental_mart(spark, str(tables))
    assert loaded.select("session_key").distinct().count() == sessions == loaded.count()
    for folder in (tmp_path / "incremental").glob("*/*"):
        assert len(list(folder.glob("*=*"))) <= 3, folder
