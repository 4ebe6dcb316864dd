"""Running tables: foreign-key joins, adders and subtractors, as-of joins with history, failures of folds."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from frames import written
from relstream import Joiner, RecordStream, UpsertTable, tumbling
from relstream.catalog.replay import appended, replay
from relstream.streaming import keyed, running
from test_streaming import SIDES, START, rows, stream


def log_of(spark, data, key="int"):
    """A batch stream of (key, value), one minute apart, numbered from `first`."""
    df = spark.createDataFrame([(k, v, START + timedelta(minutes=i), i) for i, (k, v) in data], f"key {key}, value string, ts timestamp, seq long")
    return RecordStream(written(df, "log"), "key", "value")


def last(table, spark, *columns):
    return rows(table.with_(df=appended(table.rows(), spark), rejects=()).latest().select(*columns))


GOLDEN = [("L", 1, "Record 1"), ("R", "Record 1", "Record 2"), ("L", 2, "Record 3"), ("R", "Record 3", "Record 4"), ("L", 3, "Record 5"),
          ("R", "Record 6", "Record 6")]


@pytest.mark.parametrize("slices", [3])
@pytest.mark.parametrize("how, expected", [
    ("inner", [(1, "Record 1 + Record 2"), (2, None)]),
    ("left", [(1, "Record 1 + null"), (1, "Record 1 + Record 2"), (2, None), (2, None), (3, "Record 5 + null")]),
])
def test_foreign_join_gives_every_version(spark, how, expected, slices):
    """The join function fails for one left value: its results are deletes."""
    both = [(i, (side, str(k), v)) for i, (side, k, v) in enumerate(GOLDEN)]
    df = spark.createDataFrame([(s, k, v, START + timedelta(minutes=i), i) for i, (s, k, v) in both],
                               "side string, key string, value string, ts timestamp, seq long")
    live = replay(RecordStream(written(df, "log"), "key", ("side", "value")), slices=slices, flush=False)
    side = lambda s: RecordStream(live.df.where(F.col("side") == s), "key", "value")
    joiner = Joiner(lambda l, r: {"value": F.concat(l["value"], F.lit(" + "), F.coalesce(r["value"], F.lit("null")))}, lambda l, r: l["value"] != "Record 3")
    joined = UpsertTable.of(side("L")).join_foreign(UpsertTable.of(side("R")), {"fk": F.col("value")}, joiner, how)
    found = appended(joined.rows(), spark).orderBy("key", *joined.order).collect()
    assert [(int(r["key"]), r["value"]) for r in found] == expected
    with pytest.raises(ValueError):
        running.join_foreign(UpsertTable.of(side("L")), UpsertTable.of(side("R")), {"fk": F.col("value")}, joiner, "full")


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("spread", [1, 3])
def test_foreign_join_equals_the_batch(spark, how, spread):
    """Rows that point elsewhere after an update, or nowhere, and deletes on both sides."""
    both = stream(spark, 1).merge(stream(spark, 2))
    side = lambda flow, n: UpsertTable.of(flow.filter(F.col("seq") % 2 == n))
    on = {"k": F.when(F.col("value") != 7, F.col("value") % 8).cast("long")}
    live = replay(both, slices=5, flush=False)
    got = running.join_foreign(side(live, 1), side(live, 0), on, SIDES, how, spread=spread)
    want = side(both, 1).join_foreign(side(both, 0), on, SIDES, how)
    assert last(got, spark, "key", "l", "r") == rows(want.df.select("key", "l", "r"))
    if how == "inner":
        bad = appended(got.quarantine(), spark)
        assert {r["error"] for r in bad.collect()} == {"no foreign key"}


def test_foreign_join_with_many_rows_behind_one(spark):
    """An update of the right row reaches each of 20,000 left rows, in chunks."""
    many = spark.range(20_000).select(F.col("id").alias("key"), F.lit("x").alias("value"), F.lit(START).alias("ts"), F.col("id").alias("seq"))
    right = [("x", "one", 1), ("x", "two", 2), ("x", None, 3), ("x", "three", 4)]
    ones = spark.createDataFrame([(k, v, START + timedelta(minutes=m), 50_000 + m) for k, v, m in right], "name string, v string, ts timestamp, seq long")
    united = many.selectExpr("key", "value", "null name", "null v", "ts", "seq").unionByName(ones.selectExpr("-1L key", "null value", "name", "v", "ts", "seq"))
    live = replay(RecordStream(written(united, "log"), "key", ("value", "name", "v")), slices=4, flush=False)
    left = UpsertTable.of(RecordStream(live.df.where("name IS NULL"), "key", "value"))
    right = UpsertTable.of(RecordStream(live.df.where("name IS NOT NULL"), "name", "v"))
    joined = running.join_foreign(left, right, {"name": F.col("value")}, lambda l, r: {"v": r["v"]}, "inner", spread=4)
    log = appended(joined.rows(), spark)
    assert {tuple(r) for r in log.groupBy("v").count().collect()} >= {("three", 20_000)}
    assert joined.with_(df=log, rejects=()).latest().groupBy("v").count().collect() == [("three", 20_000)]


def test_foreign_join_quarantines_late_updates(spark):
    on_time = log_of(spark, [(5, ("l1", "a")), (6, ("a", "v1"))], "string")
    late = log_of(spark, [(1, ("l1", "b")), (2, ("a", "v0"))], "string").rows()
    live = replay(on_time, late=late, flush=False)
    left = UpsertTable.of(live.filter(F.col("key").startswith("l")))
    right = UpsertTable.of(live.filter(~F.col("key").startswith("l")))
    joined = running.join_foreign(left, right, {"k": F.col("value")}, SIDES, "left")
    assert last(joined, spark, "key", "l", "r") == [("l1", "a", "v1")]
    bad = appended(joined.quarantine().where("operator = 'join_foreign'"), spark).collect()
    assert sorted((r["operator"], r["value"]) for r in bad) == [("join_foreign", '{"value":"b"}'), ("join_foreign", '{"value":"v0"}')]


@pytest.mark.parametrize("slices", [4])
def test_adder_and_subtractor_in_one_query(spark, slices):
    """Groups empty, are deleted and start again; what fails changes nothing and is data, each change once."""
    def add(state, value):
        if value["value"] == 13:
            raise ValueError("unlucky")
        return {"n": state["n"] + 1, "total": state["total"] + value["value"]}

    def subtract(state, value):
        if value["value"] == 13:
            raise ValueError("unlucky")
        return {"n": state["n"] - 1, "total": state["total"] - value["value"]} if state["n"] > 1 else None

    batch = stream(spark, 1)
    group = lambda flow: UpsertTable.of(flow).group_by({"g": F.col("value") % 3})
    found = running.aggregate(group(replay(batch, slices=slices, flush=False)), lambda: {"n": 0, "total": 0}, add, subtract, "n long, total long")
    expected, unlucky = {}, 0
    for r in sorted(UpsertTable.of(batch).changes().collect(), key=lambda r: (r["seq"], r["op"])):
        g, value = r["value"] % 3, {"value": r["value"]}
        try:
            expected[g] = (add if r["op"] > 0 else subtract)(expected.get(g) or {"n": 0, "total": 0}, value)
        except ValueError:
            unlucky += 1
    assert last(found, spark, "g", "n", "total") == sorted((g, s["n"], s["total"]) for g, s in expected.items() if s)
    bad = appended(found.quarantine().where("operator = 'aggregate'"), spark).collect()
    assert len(bad) == unlucky > 1 and all(r["error"] == "ValueError: unlucky" and r["value"] == '{"value":13}' for r in bad)


def test_reduction_starts_with_the_first_value(spark):
    batch = stream(spark, 3)
    group = lambda flow: UpsertTable.of(flow).group_by({"odd": F.col("value") % 2})
    plus, minus = (lambda a, b: {"value": a["value"] + b["value"]}), (lambda a, b: {"value": a["value"] - b["value"]})
    found = running.reduce(group(replay(batch, flush=False)), plus, minus)
    assert last(found, spark, "odd", "value") == rows(group(batch).reduce(value=F.sum("value")).df)


def test_running_tables_refuse_what_cannot_be_taken_back(spark):
    grouped = UpsertTable.of(replay(stream(spark, 1, 20), flush=False)).group_by({"g": F.col("value")})
    with pytest.raises(ValueError, match="adder and a subtractor"):
        grouped.aggregate(top=F.max("value"))
    with pytest.raises(ValueError, match="adder and a subtractor"):
        grouped.reduce(value=F.max("value"))


def arriving(spark, given, late, slices=4, **options):
    """(event minute, side, value) in their order of arrival, one minute apart; the last row ends the stream."""
    df = spark.createDataFrame(
        [("k", s, v, START + timedelta(minutes=m), START + timedelta(days=1, minutes=i), i) for i, (m, s, v) in enumerate(given)],
        "key string, side string, value string, at timestamp, arrival timestamp, seq long")
    live = replay(RecordStream(written(df, "log"), "key", ("side", "value", "at"), "arrival"), slices=slices)
    rows_ = live.df.select("key", "side", "value", F.coalesce("at", F.col("arrival") + F.expr("INTERVAL 10 YEARS")).alias("ts"), "seq")
    side = lambda s: RecordStream(rows_.where((F.col("side") == s) | F.col("side").isNull()), "key", "value")
    return running.join_versions(side("S"), UpsertTable.of(side("T")), SIDES, "left", late=late, **options)


def test_a_record_sees_the_version_of_its_time_whatever_came_first(spark):
    given = [(10, "T", "new"), (5, "S", "early"), (12, "S", "after"), (1, "T", "old"), (11, "S", "between"), (12, "T", "newer"), (0, "S", "before all")]
    flow = arriving(spark, given, timedelta(hours=1))
    assert rows(appended(flow.df.select("l", "r"), spark)) == rows(spark.createDataFrame(
        [("early", "old"), ("after", "newer"), ("between", "new"), ("before all", None)], "l string, r string"))


def test_history_serves_late_records_and_older_ones_are_data(spark):
    """The watermark passes minute 300; two hours of history are left."""
    given = [(10, "T", "first"), (200, "T", "second"), (300, "T", "third"), (301, "S", "now"), (302, "S", "then"), (303, "S", "and then"),
             (250, "S", "late"), (190, "S", "late, first version"), (20, "S", "too late"), (30, "T", "version too late")]
    flow = arriving(spark, given, timedelta(0), slices=10, history=timedelta(hours=2))
    got = dict(map(tuple, appended(flow.df.select("l", "r"), spark).collect()))
    assert got == {"now": "third", "then": "third", "and then": "third", "late": "second", "late, first version": "first"}
    bad = appended(flow.quarantine(), spark).collect()
    assert sorted((r["operator"], r["error"]) for r in bad) == [("join_table", "older than the history: record"), ("join_table", "older than the history: version")]


def test_versions_older_than_the_history_leave_the_state():
    class State:
        def put(self, values):
            self.values = values
    processor = running._Versions(["at", "seq0"], 10)
    processor.versions = State()
    processor._keep([((t, 0), str(t)) for t in (1, 5, 20, 30, 40)], 25)
    assert [t for (t, _), _ in processor.versions.values] == [20, 30, 40]


def test_failures_of_folds_are_data(spark):
    batch = stream(spark, 1)

    def step(state, value):
        if value["value"] % 5 == 0:
            raise ValueError("five")
        return None if value["value"] == 1 else {"n": state["n"] + 1}

    table = batch.group_by_key().fold_any(lambda: {"n": 0}, step, "n long")
    live = running.fold(replay(batch, flush=False), lambda: {"n": 0}, step, "n long")
    assert last(live, spark, "key", "n") == rows(table.df.select("key", "n"))
    told = lambda df: sorted((r["key"], r["value"].replace(" ", ""), r["error"], r["ts"], r["seq"]) for r in df.collect())
    bad = told(table.quarantine())
    assert bad == told(appended(live.quarantine(), spark))
    failing = batch.rows().where("value % 5 = 0")
    assert len(bad) == failing.count() > 3 and bad[0][2] == "ValueError: five"
    assert {r[4] for r in bad} == {f'{{"seq":{r["seq"]}}}' for r in failing.collect()}


def test_reductions_and_windows_quarantine_too(spark):
    batch = stream(spark, 1)

    def larger(a, b):
        if b["value"] == 7:
            raise KeyError("seven")
        return max(a, b, key=lambda v: v["value"])

    windowed = batch.windowed_by_key(tumbling(timedelta(hours=6))).reduce_any(larger)
    assert {r["error"] for r in windowed.quarantine().collect()} == {"KeyError: 'seven'"}
    live = running.reduce_records(replay(batch, flush=False), larger)
    assert last(live, spark, "key", "value") == rows(batch.group_by_key().reduce_any(larger).df.select("key", "value"))


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Tokyo"])
def test_window_folds_do_not_depend_on_the_zone(spark, zone):
    """Windows close when the watermark has passed them, and none is lost, west and east of UTC."""
    batch, late = stream(spark, 1), timedelta(hours=1)
    step = lambda state, value: {"n": state["n"] + 1}
    live = replay(batch, slices=6)
    want = rows(batch.windowed_by_key(tumbling(timedelta(hours=2))).count().df)
    live.spark.conf.set("spark.sql.session.timeZone", zone)
    found = appended(keyed.window_fold(live, tumbling(timedelta(hours=2), late), lambda: {"n": 0}, step, "n long"), spark)
    assert rows(found.withColumnRenamed("n", "count")) == want
