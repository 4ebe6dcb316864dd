"""Stream results equal batch results on the same rows, over several micro-batches."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from relstream import LookupTable, RecordStream, UpsertTable, sessions, tumbling
from relstream.functions import mergeable as M
from frames import written
from relstream.streaming import keyed
from relstream.catalog.replay import appended, replay, updated

START = datetime(2024, 1, 1)
SIDES = lambda l, r: {"l": l["value"], "r": r["value"]}


def stream(spark, seed, n=240):
    """Times increase with seq; a fifth of the values are null; key 0 holds a third of the rows."""
    rng = random.Random(seed)
    rows = [
        (0 if rng.random() < 0.34 else rng.randrange(1, 8), None if rng.random() < 0.2 else rng.randrange(30),
         START + timedelta(minutes=7 * i, microseconds=i), 2 * i + seed % 2)
        for i in range(n)
    ]
    df = written(spark.createDataFrame(rows, "key int, value int, ts timestamp, seq long"), "events")
    return RecordStream(df, "key", "value")


def rows(df):
    return sorted([tuple(r) for r in df.select(*sorted(df.columns)).collect()], key=repr)


def test_replay_has_one_micro_batch_per_slice(spark):
    replayed = replay(stream(spark, 1), slices=3)
    seen = []
    query = replayed.df.writeStream.foreachBatch(lambda b, e: seen.append(b.count())).trigger(availableNow=True).start()
    query.awaitTermination()
    assert len(seen) == 4 and sum(seen) == 241 and seen[-1] == 1


def test_changes(spark):
    batch = stream(spark, 1)
    got = appended(keyed.changes(UpsertTable.of(replay(batch, flush=False))), spark)
    assert rows(got) == rows(UpsertTable.of(batch).changes())


def test_changes_ignore_updates_that_come_too_late(spark):
    batch = stream(spark, 1).filter(F.col("seq") >= 20)
    late = stream(spark, 1).rows().where("seq < 20")
    got = appended(keyed.changes(UpsertTable.of(replay(batch, late=late, flush=False))), spark)
    alive = got.groupBy("key").agg(F.sum("op").alias("n"), F.sum(F.col("op") * F.col("value")).alias("v")).where("n = 1")
    expected = UpsertTable.of(batch).latest().select("key", F.lit(1).alias("n"), F.col("value").alias("v"))
    assert {(r["key"], r["v"]) for r in expected.collect()} <= {(r["key"], r["v"]) for r in alive.collect()}


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("spread", [1, 3])
def test_join_table(spark, how, spread):
    both = stream(spark, 1).merge(stream(spark, 2))
    side = lambda flow, n: flow.filter(F.col("seq") % 2 == n)
    live = replay(both, flush=False)
    got = keyed.join_table(side(live, 1), UpsertTable.of(side(live, 0)), SIDES, how, spread=spread)
    expected = side(both, 1).join_table(UpsertTable.of(side(both, 0)), SIDES, how)
    assert rows(appended(got.rows(), spark)) == rows(expected.rows())


def test_join_table_by_mapper_with_missing_keys(spark):
    both = stream(spark, 1).merge(stream(spark, 2))
    side = lambda flow, n: flow.filter(F.col("seq") % 2 == n)
    on = {"k": F.when(F.col("value") > 9, F.col("value") % 8)}
    live = replay(both, flush=False)
    got = keyed.join_table(side(live, 1), UpsertTable.of(side(live, 0)), SIDES, "left", on)
    expected = side(both, 1).join_table(UpsertTable.of(side(both, 0)), SIDES, "left", on)
    assert rows(appended(got.rows(), spark)) == rows(expected.rows())


@pytest.mark.parametrize("how", ["inner", "left", "full"])
def test_join_changelog(spark, how):
    both = stream(spark, 1).merge(stream(spark, 2))
    side = lambda flow, n: UpsertTable.of(flow.filter(F.col("seq") % 2 == n))
    live = replay(both, flush=False)
    got = keyed.join_changelog(side(live, 1), side(live, 0), SIDES, how)
    assert rows(appended(got.rows(), spark)) == rows(side(both, 1).join_changelog(side(both, 0), SIDES, how).rows())


@pytest.mark.parametrize("how", ["inner", "left", "full"])
def test_join_stream(spark, how):
    left, right = stream(spark, 1), stream(spark, 2)
    window = timedelta(minutes=20)
    live = replay(left)
    got = live.join_stream(replay(right, session=live.spark), window, window, SIDES, how, late=timedelta(hours=2))
    assert rows(appended(got.rows(), spark)) == rows(left.join_stream(right, window, window, SIDES, how).rows())


def test_windows_and_sessions(spark):
    batch, late = stream(spark, 1), timedelta(hours=1)
    for windows in (lambda r: tumbling(timedelta(hours=6), r), lambda r: sessions(timedelta(minutes=40), r)):
        run = lambda flow, r: flow.windowed_by_key(windows(r)).aggregate(n=M.count(), top=M.max_(F.col("value"))).df
        assert rows(appended(run(replay(batch), late), spark)) == rows(run(batch, None))
        mapped = lambda flow, r: flow.windowed_by({"odd": F.col("value") % 2}, windows(r)).count().df
        assert rows(appended(mapped(replay(batch), late), spark)) == rows(mapped(batch, None))


def test_latest_and_counts(spark):
    batch = stream(spark, 1)
    live = lambda: UpsertTable.of(replay(batch, flush=False))
    latest = updated(live().latest_versions(), ["key"], spark).where("value is not null")
    assert rows(latest) == rows(UpsertTable.of(batch).latest())
    counts = keyed.changes(live()).groupBy((F.col("value") % 3).alias("g")).agg(F.sum("op").alias("count"))
    assert rows(updated(counts, ["g"], spark)) == rows(UpsertTable.of(batch).group_by({"g": F.col("value") % 3}).count().df)


def test_fold_with_failures_and_restarts(spark):
    batch = stream(spark, 1)

    def step(state, value):
        if value["value"] == 13:
            raise ValueError("unlucky")
        return None if value["value"] == 0 else {"sum": state["sum"] + value["value"]}

    folded = keyed.fold(replay(batch, flush=False), lambda: {"sum": 0}, step, "sum int")
    expected = {}
    for r in batch.df.where("value is not null").orderBy("seq").collect():
        try:
            state = expected.get(r["key"])
            expected[r["key"]] = step({"sum": 0} if state is None else state, {"value": r["value"]})
        except ValueError:
            pass
    got = {r["key"]: r["sum"] if r["live"] else None for r in updated(folded, ["key"], spark).collect()}
    assert got == {k: s and s["sum"] for k, s in expected.items()}


def test_lookup(spark):
    batch = stream(spark, 1)
    live = replay(batch, flush=False)
    table = lambda session: LookupTable(session.range(0, 6, 2).selectExpr("cast(id as int) key", "id * 10 value"), "key", "value")
    got = appended(live.join_lookup(table(live.spark), SIDES, "left").rows(), spark)
    assert rows(got) == rows(batch.join_lookup(table(spark), SIDES, "left").rows())


def test_streams_refuse_what_only_batches_can_do(spark):
    live = replay(stream(spark, 1, 20), flush=False)
    with pytest.raises(ValueError, match="keyed.fold"):
        live.group_by_key().reduce(lambda a, b: a)
    with pytest.raises(ValueError, match="late"):
        live.join_stream(live, timedelta(1), timedelta(1))


def logged(rows_, spark, key="k"):
    """A batch stream of (value, minute, seq) for one key."""
    data = [(key, v, START + timedelta(minutes=m), q) for v, m, q in rows_]
    return RecordStream(written(spark.createDataFrame(data, "key string, value string, ts timestamp, seq long"), "log"), "key", "value")


def test_late_updates_change_nothing_and_are_quarantined(spark):
    """The whole order counts: an older number at the same time is late as well."""
    on_time = logged([("l1", 0, 0), ("r1", 1, 1), ("l2", 5, 10)], spark)
    late = logged([("l-old", 5, 9), ("l-older", 1, 3)], spark).rows()
    live = replay(on_time, late=late, flush=False)
    left = UpsertTable.of(live.filter(F.col("value").startswith("l")))
    right = UpsertTable.of(live.filter(F.col("value").startswith("r")))
    joined = keyed.join_changelog(left, right, SIDES, "left")
    batch = UpsertTable.of(on_time.filter(F.col("value").startswith("l"))).join_changelog(
        UpsertTable.of(on_time.filter(F.col("value").startswith("r"))), SIDES, "left")
    assert rows(appended(joined.rows(), spark)) == rows(batch.rows())
    bad = appended(joined.quarantine().where("operator = 'join_changelog'"), spark)
    assert sorted((r["operator"], r["value"], r["seq"]) for r in bad.collect()) == [
        ("join_changelog", '{"value":"l-old"}', '{"seq":9}'), ("join_changelog", '{"value":"l-older"}', '{"seq":3}')]


def test_late_versions_are_not_seen_by_later_records(spark):
    on_time = logged([("v-new", 5, 10)], spark)
    late = logged([("v-old", 5, 9), ("s", 6, 11)], spark).rows()
    live = replay(on_time, late=late, flush=False)
    table = UpsertTable.of(live.filter(F.col("value").startswith("v")))
    joined = keyed.join_table(live.filter(F.col("value") == "s"), table, SIDES, "left", spread=2)
    assert [(r["l"], r["r"]) for r in appended(joined.df, spark).collect()] == [("s", "v-new")]
    assert [r["value"] for r in appended(joined.quarantine().where("operator = 'join_table'"), spark).collect()] == ['{"value":"v-old"}']


def test_table_counts_and_rekeying_through_the_api(spark):
    batch = stream(spark, 1)
    grouped = lambda flow: UpsertTable.of(flow).group_by({"odd": F.col("value") % 2}).totals(total=F.col("value"))
    got = updated(grouped(replay(batch, flush=False)).df, ["odd"], spark)
    assert rows(got) == rows(grouped(batch).df)
    rekeyed = lambda flow: UpsertTable.of(flow).map_keys({"tens": F.floor(F.col("value") / 10)})
    last = updated(rekeyed(replay(batch, flush=False)).latest_versions(), ["tens"], spark)
    assert rows(last.where("value IS NOT NULL")) == rows(rekeyed(batch).latest())
