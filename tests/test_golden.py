"""Golden sequences: filters, flow, table joins, stream joins, with failing functions."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from relstream import Joiner, LookupTable, RecordStream, TopicSpec, UpsertTable

CASE = [(1, "Record 1"), (2, "Record 2"), (3, None)]


def records(spark, rows, key="int"):
    data = [(k, v, i) for i, (k, v) in enumerate(rows)]
    return RecordStream(spark.createDataFrame(data, f"key {key}, value string, seq long"), "key", "value", None, "seq")


def sided(spark, rows, key="int"):
    """Two interleaved inputs from ('L' | 'R', key, value) rows, numbered by arrival."""
    frames = []
    for side in "LR":
        data = [(k, v, i) for i, (s, k, v) in enumerate(rows) if s == side]
        frames.append(spark.createDataFrame(data, f"key {key}, value string, seq long"))
    return [RecordStream(f, "key", "value", None, "seq") for f in frames]


def listed(flow):
    return [(r["key"], r["value"]) for r in flow.rows().orderBy(*flow.order).collect()]


value = F.col("value")
key = F.col("key")

FILTERS = {
    "filter": lambda f: f.filter((value != "") & (key > 1), requires=["value"]),
    "filter_not": lambda f: f.filter_not((value != "") & (key == 1), requires=["value"]),
    "filter_keys": lambda f: f.filter_keys(F.when(key == 2, True)),
    "filter_values": lambda f: f.filter_values((value != "") & (value == "Record 2"), requires=["value"]),
}


@pytest.mark.parametrize("name", FILTERS)
def test_stream_filters(spark, name):
    assert listed(FILTERS[name](records(spark, CASE))) == [(2, "Record 2")]


@pytest.mark.parametrize("name", FILTERS)
def test_table_filters(spark, name):
    table = UpsertTable.of(records(spark, CASE))
    assert listed(FILTERS[name](table)) == [(1, None), (2, "Record 2"), (3, None)]


def test_filter_keys_sees_only_keys(spark):
    with pytest.raises(Exception):
        records(spark, CASE).filter_keys(value == "Record 1")


def test_branch(spark):
    parts = records(spark, CASE).branch(key == 1, ((value != "") & (key > 1), ("value",)))
    assert [listed(p) for p in parts] == [[(1, "Record 1")], [(2, "Record 2")]]


def test_split(spark):
    rows = [(n, f"Record {n}") for n in (1, 2, 3)]
    yes, no = records(spark, rows).split(key == 1)
    assert listed(yes) == [(1, "Record 1")]
    assert listed(no) == [(2, "Record 2"), (3, "Record 3")]


def test_split_with_failing_predicate(spark):
    yes, no = records(spark, CASE).split((value != "") & (key == 2), requires=("value",))
    assert listed(yes) == [(2, "Record 2")]
    assert listed(no) == [(1, "Record 1")]


def test_merge_and_through(spark, tmp_path):
    a, b = records(spark, [(1, "Record 1")]), records(spark, [(2, "Record 2")])
    b = b.with_(df=b.df.withColumn("seq", F.col("seq") + 1))
    merged = a.merge(b)
    topic = TopicSpec(str(tmp_path / "topic"), merged.rows().schema)
    assert listed(merged.through(topic)) == [(1, "Record 1"), (2, "Record 2")]


def test_peek_passes_records_and_sees_them(spark):
    observation = Observation()
    flow = records(spark, [(1, "Record 1"), (2, None), (3, "Record 3")])
    peeked = flow.peek(observation, seen=F.count("value"), longest=F.max(F.length("value")))
    # No sort: its sampling would run the observed rows a second time.
    assert sorted(r["key"] for r in peeked.rows().collect()) == [1, 2, 3]
    assert observation.get == {"seen": 2, "longest": 8}


@pytest.mark.parametrize("kind", ["stream", "table"])
def test_foreach_survives_failures(spark, tmp_path, kind):
    flow = records(spark, [(1, "Record 1"), (2, None), (3, "Record 3")])
    flow = flow if kind == "stream" else UpsertTable.of(flow)
    out, bad = tmp_path / "seen", tmp_path / "bad"
    out.mkdir()

    def action(record):
        if record["value"] is None:
            raise ValueError("no value")
        (out / str(record["key"])).write_text(record["value"])

    flow.foreach(action, str(bad))
    assert {p.name: p.read_text() for p in out.iterdir()} == {"1": "Record 1", "3": "Record 3"}
    rejected = spark.read.parquet(str(bad)).collect()
    assert [(r["operator"], r["key"], r["error"]) for r in rejected] == [("foreach", '{"key":2}', "ValueError: no value")]


INTERLEAVED = [("L", 1, "Record 1"), ("R", 1, "Record 2"), ("L", 2, "Record 3"), ("R", 2, "Record 4"),
               ("L", 3, "Record 5"), ("R", 4, "Record 6")]

LEFT_GOLDEN = [(1, "Record 1 + null"), (1, "Record 1 + Record 2"), (2, None), (2, None), (3, "Record 5 + null")]


def plus(l, r):
    text = lambda side: F.coalesce(side["value"], F.lit("null"))
    return {"value": F.concat(text(l), F.lit(" + "), text(r))}


picky = Joiner(plus, valid=lambda l, r: ~l["value"].eqNullSafe("Record 3"))


@pytest.mark.parametrize("how, expected", [
    ("inner", [(1, "Record 1 + Record 2"), (2, None)]),
    ("left", LEFT_GOLDEN),
    ("full", [*LEFT_GOLDEN, (4, "null + Record 6")]),
])
def test_table_join_changelog(spark, how, expected):
    left, right = map(UpsertTable.of, sided(spark, INTERLEAVED))
    assert listed(left.join_changelog(right, picky, how)) == expected
    final = {k: v for k, v in expected if v is not None}
    assert dict(listed(left.join(right, picky, how).with_(seq=("seq",)))) == final


def test_table_foreign_join(spark):
    left, _ = map(UpsertTable.of, sided(spark, INTERLEAVED))
    right = UpsertTable.of(records(spark, [("Record 1", "Record 2"), ("Record 3", "Record 4"), ("Record 6", "Record 6")], "string"))
    on = {"fk": F.col("value")}
    assert dict(listed(left.join_foreign(right, on, picky, "inner"))) == {1: "Record 1 + Record 2"}
    assert dict(listed(left.join_foreign(right, on, picky, "left"))) == {1: "Record 1 + Record 2", 3: "Record 5 + null"}
    with pytest.raises(NotImplementedError):
        left.join_foreign(right, on, picky, "full")


def test_foreign_join_keeps_many_to_one(spark):
    left = UpsertTable.of(records(spark, [(1, "x"), (2, "x"), (3, "y")]))
    right = UpsertTable.of(records(spark, [("x", "X")], "string"))
    joined = left.join_foreign(right, {"fk": value}, plus)
    assert sorted(listed(joined)) == [(1, "x + X"), (2, "x + X")]


@pytest.mark.parametrize("how, rows, expected", [
    ("inner", [("L", 1, "A"), ("R", 1, "b"), ("L", 1, "C"), ("R", 1, None)], [(1, "A + b"), (1, "C + b"), (1, None)]),
    ("left", [("L", 1, "A"), ("R", 1, "b"), ("L", 1, None), ("R", 1, None)], [(1, "A + null"), (1, "A + b"), (1, None)]),
    ("full", [("L", 1, "A"), ("R", 1, "b"), ("L", 1, None), ("R", 1, None)],
     [(1, "A + null"), (1, "A + b"), (1, "null + b"), (1, None)]),
])
def test_table_join_with_deletes(spark, how, rows, expected):
    left, right = map(UpsertTable.of, sided(spark, rows))
    assert listed(left.join_changelog(right, plus, how)) == expected


@pytest.mark.parametrize("how, expected", [("inner", [(1, "C + b")]), ("left", [(1, "A + null"), (1, "C + b")])])
def test_stream_table_join(spark, how, expected):
    left, right = sided(spark, [("L", 1, "A"), ("R", 1, "b"), ("L", 1, "C")])
    assert listed(left.join_table(UpsertTable.of(right), plus, how)) == expected


def test_stream_table_join_sees_deletes(spark):
    left, right = sided(spark, [("R", 1, "b"), ("L", 1, "A"), ("R", 1, None), ("L", 1, "B"), ("L", None, "x"), ("L", 1, None)])
    table = UpsertTable.of(right)
    assert listed(left.join_table(table, plus, "left")) == [(1, "A + b"), (1, "B + null")]
    assert listed(left.join_table(table, plus, "inner")) == [(1, "A + b")]


def test_lookup_join(spark):
    left, right = sided(spark, [("R", 1, "b"), ("L", 1, "A"), ("L", 2, "B"), ("L", None, "x"), ("L", 1, None)])
    table = LookupTable.of(UpsertTable.of(right))
    assert listed(left.join_lookup(table, plus, "inner")) == [(1, "A + b")]
    assert listed(left.join_lookup(table, plus, "left")) == [(1, "A + b"), (2, "B + null")]


def timed(spark, rows):
    start = datetime(2024, 1, 1)
    data = [(k, v, start + timedelta(minutes=m), i) for i, (k, v, m) in enumerate(rows)]
    frame = spark.createDataFrame(data, "key string, value string, ts timestamp_ntz, seq long")
    return RecordStream(frame, "key", "value", "ts", "seq")


@pytest.mark.parametrize("how, expected", [
    ("inner", [("K2", "B + b")]),
    ("left", [("K1", "A + null"), ("K2", "B + b")]),
    ("full", [("K1", "A + null"), ("K2", "B + b"), ("K3", "null + c")]),
])
def test_stream_stream_join(spark, how, expected):
    left = timed(spark, [("K1", "A", 0), ("K2", "B", 1), (None, "x", 1), ("K2", None, 1)])
    right = timed(spark, [("K2", "b", 2), ("K3", "c", 3), (None, "x", 1), ("K2", None, 1)])
    window = timedelta(minutes=5)
    assert sorted(listed(left.join_stream(right, window, window, plus, how))) == expected


def test_interval_bounds_are_inclusive(spark):
    left = timed(spark, [("k", "l", 10)])
    right = timed(spark, [("k", str(m), m) for m in range(0, 30)])
    joined = left.join_stream(right, timedelta(minutes=3), timedelta(minutes=2), lambda l, r: {"value": r["value"]})
    assert sorted(int(v) for _, v in listed(joined)) == [7, 8, 9, 10, 11, 12]
