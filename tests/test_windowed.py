"""Windows and sessions of streams: equal to the batch, and what is late or fails is data."""

import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from relstream import RecordStream, hopping, sessions, tumbling, unlimited
from relstream.catalog.replay import appended, replay
from relstream.functions import mergeable as M
from relstream.streaming import windowed
from frames import written
from test_streaming import START, rows, stream

HOUR = timedelta(hours=1)
COUNT = (lambda: {"n": 0, "total": 0}, lambda s, v: {"n": s["n"] + 1, "total": s["total"] + v["value"]}, "n long, total long")
ADDED = lambda a, b: {"n": a["n"] + b["n"], "total": a["total"] + b["total"]}
AGGREGATES = {"n": M.count(), "total": M.sum_(F.col("value"))}


@pytest.mark.parametrize("zone, windows", [
    ("America/New_York", lambda r: tumbling(timedelta(hours=2), r)), ("Asia/Tokyo", lambda r: hopping(timedelta(hours=2), HOUR, r))])
def test_windows_equal_the_batch(spark, zone, windows):
    batch = stream(spark, 1)
    want = rows(batch.windowed_by_key(windows(None)).aggregate(**AGGREGATES).df)
    live = replay(batch, slices=4)
    live.spark.conf.set("spark.sql.session.timeZone", zone)
    assert rows(appended(windowed.window_fold(live, windows(HOUR), *COUNT).rows(), spark)) == want


@pytest.mark.parametrize("spread", [1, 4])
def test_sessions_equal_the_batch(spark, spread):
    batch, gap = stream(spark, 2), timedelta(minutes=20)
    want = rows(batch.windowed_by_key(sessions(gap)).aggregate(**AGGREGATES).df)
    found = windowed.session_fold(replay(batch, slices=4), sessions(gap, HOUR), *COUNT[:2], ADDED, COUNT[2], spread=spread)
    assert rows(appended(found.rows(), spark)) == want and len(want) > 20


def test_records_that_lag_count_in_windows_that_are_open(spark):
    """The watermark is at minute 130: a record of minute 125 is behind it, its window of two hours ends at 240."""
    at = lambda *minutes: spark.createDataFrame([("k", 1, START + timedelta(minutes=m), m) for m in minutes], "key string, value int, ts timestamp, seq long")
    live = replay(RecordStream(written(at(5, 190), "events"), "key", "value"), slices=1, late=at(125, 7))
    found = windowed.window_fold(live, tumbling(timedelta(hours=2), HOUR), *COUNT)
    assert sorted(r["n"] for r in appended(found.rows(), spark).collect()) == [1, 2]
    bad = appended(found.quarantine(), spark).collect()
    assert [(r["operator"], r["key"], r["value"], r["error"], r["seq"]) for r in bad] == [
        ("window_fold", '{"key":"k"}', '{"value":1}', "later than the watermark", '{"seq":7}')]


@pytest.mark.parametrize("spread", [1, 3])
def test_kept_and_quarantined_are_the_input(spark, spread):
    batch = stream(spark, 3).filter(F.col("value").isNotNull())
    late = batch.rows().where("seq % 7 = 0")
    on_time = batch.with_(df=batch.rows().where("seq % 7 <> 0"))

    def picky(state, value):
        if value["value"] == 13:
            raise ValueError("unlucky")
        return COUNT[1](state, value)

    total = batch.rows().count()
    unlucky = on_time.rows().where("value = 13").count()
    assert unlucky > 0
    window = windowed.window_fold(replay(on_time, late=late), tumbling(HOUR, HOUR), COUNT[0], picky, COUNT[2])
    session = windowed.session_fold(replay(on_time, late=late), sessions(timedelta(minutes=20), HOUR), COUNT[0], picky, ADDED, COUNT[2], spread=spread)
    for flow in (window, session):
        kept = appended(flow.rows(), spark).agg(F.sum("n")).first()[0]
        bad = appended(flow.quarantine(), spark)
        assert kept + bad.count() == total
        told = dict(map(tuple, bad.groupBy("error").count().collect()))
        assert told["ValueError: unlucky"] >= unlucky and told["later than the watermark"] > 20
        assert bad.select("seq").distinct().count() == bad.count()


def test_sessions_in_any_order_are_the_same():
    """Records in any order, and parts of them in any order, give the sessions of the sorted records."""
    rng = random.Random(5)
    for _ in range(200):
        gap, times = rng.randrange(1, 6), [rng.randrange(60) for _ in range(rng.randrange(1, 25))]
        expected = []
        for t in sorted(times):
            if expected and t <= expected[-1][1] + gap:
                expected[-1][1:] = [t, expected[-1][2] + 1]
            else:
                expected.append([t, t, 1])
        add = lambda s, v: s + 1
        one = windowed._Sessions(gap, lambda a, b: a + b)
        for t in times:
            assert one.add(t, {}, lambda: 0, add) == []
        parts = [windowed._Sessions(gap, lambda a, b: a + b) for _ in range(3)]
        for i, t in enumerate(times):
            parts[i % 3].add(t, {}, lambda: 0, add)
        joined = windowed._Sessions(gap, lambda a, b: a + b)
        every = [s for p in parts for s in zip(p.firsts, p.lasts, p.states)]
        rng.shuffle(every)
        for s in every:
            joined.put(*s)
        for found in (one, joined):
            assert list(map(list, zip(found.firsts, found.lasts, found.states))) == expected
        assert [list(s) for s in joined.closed(30)] == [s for s in expected if s[1] + gap < 30]


def test_failing_merges_keep_the_earlier_state():
    def refuse(a, b):
        raise KeyError("no")
    found = windowed._Sessions(5, refuse, [(0, 1, "early"), (10, 11, "later")])
    assert found.add(6, {}, str, lambda s, v: s + "!") == [("later", "KeyError: 'no'")]
    assert list(zip(found.firsts, found.lasts, found.states)) == [(0, 11, "early!")]


def test_a_hot_key_reaches_its_group_in_parts(spark):
    """Of 6,000 records of one key in one micro-batch, a row per part and session."""
    df = spark.range(6000).selectExpr("'hot' key", "int(id % 10) value", "timestamp_seconds(1704067200 + id + 100000 * (id div 3000)) ts", "id seq")
    live = replay(RecordStream(written(df, "events"), "key", "value"), slices=1)
    names, gap = windowed._Names(["at", "seq0"]), 60_000_000
    part = windowed._Part(names, gap, *COUNT[:2], ADDED)
    found = windowed.session_fold(live, sessions(timedelta(minutes=1), HOUR), *COUNT[:2], ADDED, COUNT[2], spread=8)
    got = [(r["n"], r["total"]) for r in appended(found.rows(), spark).collect()]
    assert got == [(3000, 13500)] * 2
    frame = df.selectExpr("unix_micros(ts) at", "seq seq0", "to_json(struct(value)) text").toPandas()
    passed = [list(part._results(("k", s), iter([frame[frame.index % 8 == s]]), 0)) for s in range(8)]
    assert [len(p) for p in passed] == [2] * 8
    assert sum(json.loads(row[3])["n"] for p in passed for row in p) == 6000


def test_refusals(spark):
    live = replay(stream(spark, 1, 20), flush=False)
    with pytest.raises(ValueError, match="never ends"):
        windowed.window_fold(live, unlimited(datetime(2024, 1, 1), HOUR), *COUNT)
    with pytest.raises(ValueError, match="retention"):
        windowed.window_fold(live, tumbling(HOUR), *COUNT)
    with pytest.raises(ValueError, match="event times"):
        windowed.window_fold(live.with_(ts=None), tumbling(HOUR, HOUR), *COUNT)
