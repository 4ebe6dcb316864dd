"""Keys on a stream share groups and states: what the engine does per group does not grow with the keys."""

from datetime import timedelta

import pytest

from relstream import RecordStream, UpsertTable, sessions
from relstream.catalog.replay import appended, replay
from relstream.plans.scratch import scratch_path
from relstream.streaming import keyed, running, windowed
from frames import written

HOUR = timedelta(hours=1)
ZERO, STEP, ADDED = lambda: {"n": 0}, lambda s, v: {"n": s["n"] + 1}, lambda a, b: {"n": a["n"] + b["n"]}


@pytest.mark.parametrize("run", [
    lambda stream: keyed.changes(UpsertTable.of(stream)),
    lambda stream: running.fold(stream, ZERO, STEP, "n long").df,
    lambda stream: windowed.session_fold(stream, sessions(HOUR, HOUR), ZERO, STEP, ADDED, "n long", spread=2).rows(),
])
def test_states_are_as_many_as_buckets(spark, run):
    df = spark.range(400).selectExpr("concat('k', id % 200) key", "int(id) value", "timestamp_seconds(1704067200 + id) ts", "id seq")
    live = replay(RecordStream(written(df, "events"), "key", "value"), slices=1, flush=False)
    live.spark.conf.set("relstream.state.buckets", "4")
    found = run(live)
    query = found.writeStream.format("noop").outputMode("append").option("checkpointLocation", scratch_path(spark, "checkpoint")) \
        .trigger(availableNow=True).start()
    query.awaitTermination()
    held = [sum(op.numRowsTotal for op in progress.stateOperators) for progress in query.recentProgress]
    assert 0 < max(held) <= 3 * 4  # a text and a timer, in up to two operators


def test_updates_without_time_are_late(spark):
    """They change nothing, and the numbers beside them in a bucket stay whole."""
    big = 2**60 + 1
    rows = [("a", 1, 5, big), ("b", 2, 6, big), ("a", 3, None, big + 1)]
    df = spark.createDataFrame(rows, "key string, value int, s int, seq long").selectExpr("key", "value", "timestamp_seconds(s) ts", "seq")
    given = RecordStream(written(df.where("ts IS NOT NULL"), "events"), "key", "value")
    live = replay(given, slices=1, late=df.where("ts IS NULL"), flush=False)
    live.spark.conf.set("relstream.state.buckets", "1")
    found = appended(keyed.changes(UpsertTable.of(live), with_late=True), spark)
    assert sorted((r["key"], r["op"], r["value"], r["seq"]) for r in found.collect()) == [("a", 0, 3, big + 1), ("a", 1, 1, big), ("b", 1, 2, big)]
