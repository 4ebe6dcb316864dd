"""Laws that hold on any data."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from relstream import RecordStream, UpsertTable
from frames import written

START = datetime(2024, 1, 1)


@pytest.fixture(scope="module", params=[11, 12])
def stream(spark, request):
    rng = random.Random(request.param)
    rows = [
        (rng.choice([None, *range(9)]), rng.choice([None, *range(20)]), START + timedelta(minutes=rng.randrange(90)), i)
        for i in range(400)
    ]
    df = spark.createDataFrame(rows, "key int, value int, ts timestamp_ntz, seq long").repartition(3)
    return RecordStream(written(df, "events"), "key", "value")


def ids(flow):
    return [r["seq"] for r in flow.rows().select("seq").collect()]


def test_filters_part_the_stream(stream):
    condition, needs = (F.col("value") > 7) | (F.col("key") < 3), ["key", "value"]
    kept, dropped = stream.filter(condition, needs), stream.filter_not(condition, needs)
    failed = [int(r[0]) for r in kept.quarantine().select(F.get_json_object("seq", "$.seq")).collect()]
    assert sorted(ids(kept) + ids(dropped) + failed) == list(range(400))
    assert kept.quarantine().count() == dropped.quarantine().count() == len(failed) > 0


def test_branches_are_disjoint_and_first_match_wins(stream):
    value = F.col("value")
    parts = [ids(p) for p in stream.branch(value > 12, value > 5, value.isNull())]
    together = sum(parts, [])
    assert len(together) == len(set(together))
    assert set(parts[1]) == {r["seq"] for r in stream.df.where("value > 5 and value <= 12").collect()}


def test_changes_replay_to_the_snapshot(stream):
    table = UpsertTable.of(stream)
    sums = table.changes().groupBy("key").agg(F.sum("op").alias("n"), F.sum(F.col("op") * F.col("value")).alias("v")).collect()
    assert {r["n"] for r in sums} <= {0, 1}
    assert {r["key"]: r["v"] for r in sums if r["n"]} == {r["key"]: r["value"] for r in table.latest().collect()}


def test_latest_is_the_last_row(stream):
    last = {}
    for r in sorted(stream.df.collect(), key=lambda r: (r["ts"], r["seq"])):
        if r["key"] is not None:
            last[r["key"]] = r["value"]
    table = UpsertTable.of(stream)
    assert {r["key"]: r["value"] for r in table.latest().collect()} == {k: v for k, v in last.items() if v is not None}
    # A table made directly from rows ignores rows without a key as well.
    direct = UpsertTable(stream.df, "key", "value")
    assert direct.latest().count() == table.latest().count()


def test_table_join_log_ends_in_the_join(stream):
    left, right = (UpsertTable.of(stream.filter(F.col("seq") % 2 == n)) for n in (0, 1))
    sides = lambda l, r: {"l": l["value"], "r": r["value"]}
    for how in ("inner", "left", "full"):
        log = left.join_changelog(right, sides, how)
        pairs = lambda df: sorted(((r["key"], r["l"], r["r"]) for r in df.collect()), key=repr)
        assert pairs(log.latest()) == pairs(left.join(right, sides, how).latest())


def test_group_aggregates_equal_summed_changes(stream):
    grouped = UpsertTable.of(stream).group_by({"g": F.col("value") % 4})
    summed = grouped.changes().groupBy("__g0").agg(F.sum("op").alias("n"), F.sum(F.col("op") * F.col("value")).alias("total"))
    direct = grouped.aggregate(n=F.count("*"), total=F.sum("value")).df
    assert sorted(map(tuple, summed.collect())) == sorted(map(tuple, direct.collect()))
