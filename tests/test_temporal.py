"""As-of join, overlap, change detection and timelines: edges, and cut keys against brute force."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from lapwise.functions import within_seconds
from lapwise.operators import slices
from lapwise.operators.ordered import OrderedRows
from lapwise.operators.folds import signal_maps
from lapwise.operators.temporal import (
    asof_join,
    change_points,
    close_periods,
    overlap_flag,
    state_changes,
    state_timeline,
)

BASE = datetime.datetime(2024, 3, 10, 1, 59, 0)


def at(seconds):
    return None if seconds is None else BASE + datetime.timedelta(seconds=seconds)


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


@pytest.fixture
def readings(spark):
    rows = [("a", at(10), 1), ("a", at(20), 2), ("b", at(5), 3), (None, at(1), 4), ("a", None, 5)]
    return frame(spark, rows, "key string, at timestamp_ntz, reading int")


def lookups(spark, readings, probes, **options):
    left = frame(spark, [(i, k, at(t)) for i, (k, t) in enumerate(probes)], "id int, key string, t timestamp_ntz")
    joined = asof_join(left, readings, ["key"], "t", "at", {"reading": "reading"}, **options)
    return [r["reading"] for r in joined.orderBy("id").collect()]


def test_asof_edges(spark, readings):
    probes = [("a", 10), ("a", 9.999999), ("a", 19.9), ("a", 500), ("a", None), ("c", 10), (None, 10), ("b", 5)]
    assert lookups(spark, readings, probes) == [1, None, 1, 2, None, None, None, 3]


def test_asof_keeps_copies(spark, readings):
    assert lookups(spark, readings, [("a", 15)] * 3) == [1, 1, 1]


def test_asof_tolerance_is_inclusive_and_a_flag(spark):
    rows = [(1, at(60), at(0)), (2, at(60.001), at(0)), (3, None, at(0)), (4, at(1), None)]
    df = frame(spark, rows, "id int, t timestamp_ntz, matched timestamp_ntz")
    flags = df.withColumn("ok", within_seconds("t", "matched", 60)).orderBy("id").collect()
    assert [r["ok"] for r in flags] == [True, False, False, False]


def test_asof_tie_break(spark):
    rows = [("a", at(1), 1, "x"), ("a", at(1), 3, "z"), ("a", at(1), 2, "y")]
    right = frame(spark, rows, "key string, at timestamp_ntz, version int, name string")
    left = frame(spark, [("a", at(1))], "key string, t timestamp_ntz")
    for max_rows in (100, 1):
        joined = asof_join(left, right, ["key"], "t", "at", {"name": "name"}, ["version"], max_rows)
        assert joined.first()["name"] == "z"


def test_asof_refuses_clashing_names(spark, readings):
    left = frame(spark, [("a", at(1), 0)], "key string, t timestamp_ntz, reading int")
    with pytest.raises(ValueError, match="reading"):
        asof_join(left, readings, ["key"], "t", "at")


def test_asof_empty_sides(spark, readings):
    nothing = readings.where("false")
    assert lookups(spark, nothing, [("a", 10)]) == [None]
    assert lookups(spark, readings, [("a", 10)][:0] or [("zz", 1)]) == [None]


@pytest.mark.parametrize("time_type", ["timestamp", "timestamp_ntz"])
@pytest.mark.parametrize("max_rows", [None, 1, 7, 40])
def test_asof_against_brute_force(spark, time_type, max_rows):
    generator = random.Random(str((time_type, max_rows)))
    # One key holds most rows, and much of it falls into one instant.
    keys = ["hot"] * 8 + ["cold", "rare", None]
    times = [generator.randint(0, 2_000_000) / 1000 for _ in range(150)] + [777.0] * 80
    left = [(i, generator.choice(keys), at(generator.choice(times))) for i in range(400)]
    left += [(1000 + i, "hot", None) for i in range(5)]
    stamps = {(generator.choice(keys), at(generator.choice(times))) for _ in range(200)}
    right = [(k, t, i) for i, (k, t) in enumerate(sorted(stamps, key=str))]
    result = asof_join(
        frame(spark, left, f"id int, key string, t {time_type}"),
        frame(spark, right, f"key string, at {time_type}, value int"),
        ["key"],
        "t",
        "at",
        {"value": "value"},
        max_rows=max_rows,
    )
    expected = {}
    for i, key, t in left:
        candidates = [(at_, v) for k, at_, v in right if key is not None and t is not None and k == key and at_ <= t]
        expected[i] = max(candidates)[1] if candidates else None
    assert {r["id"]: r["value"] for r in result.collect()} == expected


def overlaps(spark, laps, periods, max_rows=slices.MAX_ROWS):
    left = frame(
        spark,
        [(i, k, at(s), at(e)) for i, (k, s, e) in enumerate(laps)],
        "id int, key string, s timestamp_ntz, e timestamp_ntz",
    )
    right = frame(
        spark, [(k, at(s), at(e)) for k, s, e in periods], "key string, p timestamp_ntz, q timestamp_ntz"
    )
    flagged = overlap_flag(left, right, ["key"], "s", "e", "p", "q", "hit", max_rows)
    assert flagged.columns == ["id", "key", "s", "e", "hit"]
    return [r["hit"] for r in flagged.orderBy("id").collect()]


def test_overlap_edges(spark):
    periods = [("a", 100, 200), ("a", 120, 130), ("a", None, 500), ("a", 0, None)]
    laps = [
        ("a", 50, 100),  # ends where the period starts
        ("a", 200, 250),  # starts where it ends
        ("a", 50, 100.000001),
        ("a", 199.999999, 250),
        ("a", 140, 150),  # inside the long period only
        ("a", 50, 500),
        ("b", 140, 150),
        ("a", None, 150),
        ("a", 140, None),
        (None, 140, 150),
    ]
    assert overlaps(spark, laps, periods) == [False, False, True, True, True, True, False, None, None, False]


def test_overlap_without_periods(spark):
    assert overlaps(spark, [("a", 1, 2), ("a", None, 2)], []) == [False, None]


@pytest.mark.parametrize("max_rows", [None, 1, 10, 60])
def test_overlap_against_brute_force(spark, max_rows):
    generator = random.Random(max_rows or 0)
    keys = ["hot"] * 6 + ["cold", None]
    laps, periods = [], []
    for _ in range(300):
        start = generator.choice([generator.randint(0, 3000), 1000])
        laps.append((generator.choice(keys), start, start + generator.choice([5, 60, 600])))
    for _ in range(60):
        start = generator.randint(0, 3000)
        # Some periods are empty or reversed.
        periods.append((generator.choice(keys), start, start + generator.choice([-3, 0, 1, 20, 400])))
    expected = [
        any(k is not None and k == pk and s < pe and e > ps for pk, ps, pe in periods) for k, s, e in laps
    ]
    assert overlaps(spark, laps, periods, max_rows) == expected


def test_overlap_without_keys(spark):
    left = frame(spark, [(at(0), at(10)), (at(30), at(40))], "s timestamp_ntz, e timestamp_ntz")
    right = frame(spark, [(at(5), at(6))], "p timestamp_ntz, q timestamp_ntz")
    flagged = overlap_flag(left, right, [], "s", "e", "p", "q", "hit")
    assert [r["hit"] for r in flagged.orderBy("s").collect()] == [True, False]


def test_change_points_follow_sql_nulls(spark):
    values = [None, None, "x", "x", None, "x", "y"]
    df = frame(spark, [("k", i, v) for i, v in enumerate(values)], "key string, n long, value string")
    for max_rows in (None, 1, 2):
        changes = change_points(df, ["key"], ["n"], "value", max_rows=max_rows).orderBy("n").collect()
        # The change to null at 4 is not reported; the row after it is.
        assert [(r["n"], r["previous_value"]) for r in changes] == [(0, None), (1, None), (2, None), (5, None), (6, "x")]


@pytest.mark.parametrize("max_rows, listed", [(None, 1), (1, 10_000), (50, 10_000), (5, 0)])
def test_neighbours_against_brute_force(spark, monkeypatch, max_rows, listed):
    # With nothing listed, summaries are joined by a shuffle instead of broadcast.
    monkeypatch.setattr(slices, "MAX_LISTED_SLICES", listed)
    generator = random.Random(3)
    rows = [(generator.choice(["hot"] * 9 + ["cold", None]), at(generator.randint(0, 50)), i, generator.choice("ab")) for i in range(300)]
    df = frame(spark, rows, "key string, t timestamp_ntz, id long, value string")
    ordered = OrderedRows.of(df, ["key"], ["t", "id"], max_rows)
    ordered = ordered.previous("value", "before").following("id", "after").running_max("id", "highest")
    ordered = ordered.running_last("value", "last", before="last_before")
    got = {r["id"]: (r["before"], r["after"], r["highest"], r["last"], r["last_before"]) for r in ordered.result().collect()}
    expected = {}
    for key in {r[0] for r in rows}:
        group = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[2]))
        for i, row in enumerate(group):
            before = group[i - 1][3] if i else None
            after = group[i + 1][2] if i + 1 < len(group) else None
            expected[row[2]] = (before, after, max(r[2] for r in group[: i + 1]), row[3], before)
    assert got == expected


def test_cutting_is_even_and_keeps_order(spark):
    rows = [("hot", at(i % 7), f"a name {i:04d}") for i in range(700)]
    df = frame(spark, rows, "key string, t timestamp_ntz, name string")
    assert_cut_in_order(df, ["t", "name"])
    df = df.withColumn("n", F.substring("name", 8, 4).cast("int")).drop("name")
    assert_cut_in_order(df, ["t", "n"])


def assert_cut_in_order(df, order):
    found = slices.find_slices(df, ["key"], order, max_rows=20)
    assert found.fine_enough
    tagged = found.tag(df).orderBy(*order).collect()
    marks = [tuple(r[c] for c in found.columns) for r in tagged]
    assert marks == sorted(marks)
    assert max(marks.count(m) for m in set(marks)) <= 20
    assert found.listed.count() == len(set(marks))


@pytest.mark.parametrize(
    "kind, values",
    [
        ("timestamp_ntz", ["0001-01-01 00:00:00.000001", "1969-12-31 23:59:59.4", "1969-12-31 23:59:59.5", "9999-12-31 23:59:59.999999"]),
        ("timestamp", ["1969-12-31 23:59:59.4", "1970-01-01 00:00:00", "2024-03-10 02:30:00.123456", "2024-03-10 02:30:00.123457"]),
        ("date", ["1900-01-01", "1970-01-01", "2024-02-29"]),
        ("bigint", [-(2**62), -1, 0, 5, 2**62]),
        ("boolean", [False, True]),
        ("string", ["", "A", "Aa", "a", "ab", "abcdefg", "b", "é", "日本"]),
    ],
)
def test_positions_keep_the_order(spark, kind, values):
    df = spark.createDataFrame([(i, str(v)) for i, v in enumerate(values)], "i int, v string").withColumn("v", F.col("v").cast(kind))
    assert slices.axes_of(df, ["v"])
    got = [r[0] for r in df.orderBy("v").select(slices.position(df, "v")).collect()]
    assert got == sorted(got) and len(set(got)) == len(values)


def test_text_of_one_beginning_and_fractions_are_cut_in_order(spark):
    generator = random.Random(8)
    values = [generator.uniform(-1, 1) * 10.0 ** generator.randint(-30, 30) for _ in range(300)]
    values += [0.0, -0.0, float("inf"), float("-inf"), float("nan"), 1.0, 1.0000000000000002]
    assert_cut_in_order(spark.createDataFrame([("hot", v) for v in values], "key string, v double"), ["v"])
    df = spark.createDataFrame([("hot", f"session-{i:03d}") for i in range(700)], "key string, v string")
    assert_cut_in_order(df, ["v"])
    cents = spark.range(500).select(F.lit("hot").alias("key"), (F.col("id") / 7).cast("decimal(12, 4)").alias("v"))
    assert_cut_in_order(cents, ["v"])


def test_a_key_that_can_not_be_cut_is_refused(spark):
    ties = spark.createDataFrame([("hot", at(1), i) for i in range(50)], "key string, t timestamp_ntz, value int")
    for look in (
        lambda df, rows: change_points(df, ["key"], ["t"], "value", max_rows=rows),
        lambda df, rows: close_periods(df, ["key"], ["t"], "t", "end", max_rows=rows),
    ):
        with pytest.raises(slices.HotKeyError, match="max_rows=None"):
            look(ties, 10)
        look(ties, None).collect()
        look(ties, 100).collect()
    unordered = ties.select("key", F.struct("t").alias("t"), "value")
    with pytest.raises(slices.HotKeyError):
        change_points(unordered, ["key"], ["t"], "value", max_rows=10)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_keys_of_any_type_are_cut(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.sql(
            """SELECT timestamp'2024-01-01 02:30:00.123456' AS a, timestamp_ntz'2024-03-10 02:30:00' AS b,
                      date'2024-01-01' AS c, 'x' AS d, CAST(NULL AS STRING) AS e, CAST(1.25 AS DECIMAL(10, 2)) AS f,
                      CAST(id % 2 AS SMALLINT) AS g, TRUE AS h, 0.5D AS i, id FROM range(100)"""
        )
        keys = ["a", "b", "c", "d", "e", "f", "g", "h", "i"]
        found = slices.find_slices(df, keys, ["id"], max_rows=10)
        sizes = found.tag(df).groupBy(*keys, *found.columns).count().collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert found.fine_enough and max(r["count"] for r in sizes) <= 10


@pytest.mark.parametrize("reach", [2**63 - 1, 2**62, 2**61, 1000])
def test_numbers_of_any_reach_are_cut(spark, reach):
    generator = random.Random(reach)
    numbers = sorted({generator.randint(-reach, reach) for _ in range(300)} | {-reach, reach})
    rows = [("hot", n) for n in numbers] + [("cold", -(2**63)), ("cold", 2**63 - 1), ("hot", None)]
    df = frame(spark, rows, "key string, n long")
    changes = OrderedRows.of(df, ["key"], ["n"], max_rows=20).previous("n", "before").result()
    got = {r["n"]: r["before"] for r in changes.where("key = 'hot'").collect()}
    assert got == dict(zip([None, *numbers], [None, None, *numbers]))


def test_small_keys_are_not_cut(spark):
    df = frame(spark, [("a", at(1)), ("b", at(2))], "key string, t timestamp_ntz")
    found = slices.find_slices(df, ["key"], ["t"])
    assert found.columns == [] and found.tag(df).columns == df.columns


def test_close_periods(spark):
    df = frame(spark, [("a", at(0)), ("a", at(5)), ("b", at(9))], "key string, start timestamp_ntz")
    closed = close_periods(df, ["key"], ["start"], "start", "end").collect()
    assert [(r["key"], r["start"], r["end"]) for r in closed] == [("a", at(0), at(5))]
    assert close_periods(df, ["key"], ["start"], "start", "end", keep_open=True).count() == 3


SET_RULES = {"go": "NORMAL", "virtual": "VSC", "car": "SAFETY_CAR", "red": "RED_FLAG", "done": "FINISHED"}
CONDITIONAL = {"clear": ("SAFETY_CAR", "NORMAL")}


def fold(messages, conditional=CONDITIONAL):
    """The state machine, one message after the other."""
    state, changes = "NOT_STARTED", []
    for t, message in messages:
        new = SET_RULES.get(message, state)
        if message in conditional and conditional[message][0] == state:
            new = conditional[message][1]
        if new != state:
            changes.append((t, new, message))
            state = new
    return [(s, e[0], state, trigger) for (s, state, trigger), e in zip(changes, changes[1:])]


@pytest.mark.parametrize("max_rows", [None, 1, 9])
@pytest.mark.parametrize(
    "conditional", [CONDITIONAL, {"clear": ("SAFETY_CAR", "NORMAL"), "green": ("VSC", "NORMAL"), "ok": ("VSC", "NORMAL")}]
)
def test_timeline_against_fold(spark, max_rows, conditional):
    generator = random.Random(len(conditional))
    signals = [*SET_RULES, *["clear", "green", "ok"] * 2, "noise"]
    rows, expected = [], []
    for session in range(25):
        log = [(at(i), generator.choice(signals)) for i in range(generator.randint(0, 60))]
        rows += [(session, *event) for event in log]
        expected += [(session, *period) for period in fold(log, conditional)]
    generator.shuffle(rows)
    df = frame(spark, rows, "session int, t timestamp_ntz, message string")
    got = state_timeline(df, ["session"], ["t"], "message", SET_RULES, conditional, max_rows=max_rows)
    assert got.columns == ["session", "start_time", "end_time", "state", "trigger"]
    assert sorted(map(tuple, got.collect())) == sorted(expected)


def test_timeline_with_many_copies_of_an_event(spark):
    log = [(at(0), "go")] * 40 + [(at(1), "car")] * 40 + [(at(2), "clear"), (at(3), "red"), (at(4), "red")]
    df = frame(spark, [("s", *e) for e in log], "session string, t timestamp_ntz, message string")
    got = state_timeline(df, ["session"], ["t", "message"], "message", SET_RULES, CONDITIONAL, max_rows=3)
    assert sorted((r["start_time"], r["end_time"], r["state"]) for r in got.collect()) == [
        (at(0), at(1), "NORMAL"),
        (at(1), at(2), "SAFETY_CAR"),
        (at(2), at(3), "NORMAL"),
    ]


def test_timeline_keeps_the_open_state_on_request(spark):
    df = frame(spark, [("s", at(0), "go"), ("s", at(1), "red")], "session string, t timestamp_ntz, message string")
    assert state_timeline(df, ["session"], ["t"], "message", SET_RULES).count() == 1
    assert state_timeline(df, ["session"], ["t"], "message", SET_RULES, keep_open=True).count() == 2


def test_timeline_of_no_events_has_its_columns(spark):
    df = frame(spark, [], "session string, t timestamp_ntz, message string")
    got = state_timeline(df, ["session"], ["t"], "message", SET_RULES)
    assert got.columns == ["session", "start_time", "end_time", "state", "trigger"] and got.count() == 0


def fold_any(messages, sets, rules, initial):
    """Any rules, one message after the other."""
    state, changes = initial, []
    for t, message in messages:
        rule = rules.get(message, {})
        rule = dict([rule]) if isinstance(rule, tuple) else rule
        new = rule.get(state, sets.get(message, state))
        if new != state:
            changes.append((t, message, new))
            state = new
    return changes


def random_rules(generator):
    states = ["A", "B", "C", "D"][: generator.randint(2, 4)]
    signals = list("uvwxyz")
    sets = {s: generator.choice(states) for s in signals[:2] if generator.random() < 0.6}
    rules = {}
    for s in signals[1:]:
        pairs = {a: generator.choice(states) for a in states if generator.random() < 0.6}
        if pairs:
            rules[s] = next(iter(pairs.items())) if len(pairs) == 1 else pairs
    return sets, rules, generator.choice(["A", "start"])


def test_maps_of_random_rules_compose_to_the_fold():
    generator = random.Random(11)
    for _ in range(500):
        sets, rules, initial = random_rules(generator)
        log = [(i, generator.choice("uvwxyz")) for i in range(generator.randint(0, 40))]
        states, maps = signal_maps(sets, rules, initial)
        own = [maps[m] for _, m in log if m in maps]
        cut = generator.randint(0, len(own))
        halves = []
        for part in (own[:cut], own[cut:]):
            total = list(range(len(states)))
            for step in part:
                total = [step[s] for s in total]
            halves.append(total)
        end = ([(0, "", initial), *fold_any(log, sets, rules, initial)])[-1][2]
        assert states[halves[1][halves[0][0]]] == end


@pytest.mark.parametrize("max_rows", [None, 1, 6])
@pytest.mark.parametrize("chunk", [2, 1024])
def test_any_rules_against_fold(spark, monkeypatch, max_rows, chunk):
    monkeypatch.setattr("lapwise.operators.folds.CHUNK_ROWS", chunk)
    generator = random.Random(chunk + (max_rows or 0))
    for _ in range(3):
        sets, rules, initial = random_rules(generator)
        rules["x"] = {"A": "B", "B": "A", initial: "B"}  # leads in a circle, so that rows have to be folded
        rows, expected = [], []
        for session in [None, *range(6)]:
            log = [(i, generator.choice("uvwxyz-")) for i in range(generator.randint(0, 25))]
            rows += [(session, t, m, {"n": t}) for t, m in log]
            expected += [(session, *change) for change in fold_any(log, sets, rules, initial)]
        generator.shuffle(rows)
        df = frame(spark, rows, "session int, t long, message string, other map<string, long>")
        got = state_changes(df, ["session"], ["t"], "message", sets, rules, initial, max_rows=max_rows)
        assert got.columns == ["session", "t", "message", "other", "state"]
        out = [(r.session, r.t, r.message, r.state) for r in got.collect()]
        assert sorted(out, key=str) == sorted(expected, key=str)


def test_rules_that_enable_each_other_make_a_timeline(spark):
    log = [(0, "go"), (1, "a"), (2, "b"), (3, "a"), (4, "b"), (5, "b")]
    df = frame(spark, [("s", at(t), m) for t, m in log], "session string, t timestamp_ntz, message string")
    rules = {"a": {"NORMAL": "VSC", "RED_FLAG": "NORMAL"}, "b": ("VSC", "RED_FLAG")}
    got = state_timeline(df, ["session"], ["t"], "message", SET_RULES, rules)
    assert sorted((r["start_time"], r["end_time"], r["state"], r["trigger"]) for r in got.collect()) == [
        (at(0), at(1), "NORMAL", "go"),
        (at(1), at(2), "VSC", "a"),
        (at(2), at(3), "RED_FLAG", "b"),
    ]


def test_counting_rows_of_overlaps_does_not_work_out_times(spark):
    worked_out = spark.sparkContext.accumulator(0)

    @F.udf("timestamp_ntz")
    def end(start):
        worked_out.add(1)
        return start and start + datetime.timedelta(seconds=90)

    laps = frame(spark, [(1, at(0)), (1, at(100)), (2, at(0)), (None, at(0)), (1, None)], "k long, t timestamp_ntz")
    laps = laps.withColumn("e", end.asNondeterministic()("t"))
    periods = frame(spark, [(1, at(50), at(60)), (None, at(0), at(9))], "k long, s timestamp_ntz, u timestamp_ntz")
    found = overlap_flag(laps, periods, ["k"], "t", "e", "s", "u", "hit")
    assert worked_out.value == 0
    rows = {(r["k"], r["t"]): r["hit"] for r in found.collect()}
    assert rows == {(1, at(0)): True, (1, at(100)): False, (2, at(0)): False, (None, at(0)): False, (1, None): None}

    # Rows of unknown times do not count: three of the key are too many, the two that can match are not.
    sizes = slices.find_slices(laps.where("k = 1 AND t IS NOT NULL"), ["k"], ["t"], 2, laps.select("k"))
    assert not sizes.levels
    assert slices.find_slices(laps.where("k = 1"), ["k"], ["t"], 2, laps.select("k")).levels
