"""Splitting hot keys must not change any result."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from relstream import LookupTable, RecordStream, UpsertTable, sessions, tumbling
from relstream.functions import mergeable as M
from relstream.plans import ordered, skew
from frames import written

START = datetime(2024, 1, 1)
MOD = 1_000_003


def frame(spark, seed, n=900, tied=False):
    """Key 0 holds a third of the rows; some values are null; times may tie."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = 0 if rng.random() < 0.34 else rng.randrange(1, 30)
        minute = rng.randrange(40) if tied else rng.randrange(20_000)
        value = None if rng.random() < 0.15 else rng.randrange(50)
        rows.append((key, value, START + timedelta(minutes=minute), i))
    return written(spark.createDataFrame(rows, "key int, value int, ts timestamp_ntz, seq long").repartition(4), "events")


def stream(df):
    return RecordStream(df, "key", "value", "ts", "seq")


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def flows(spark):
    """Result frames of every operator that may split, over fresh data."""
    a, b = stream(frame(spark, 1)), stream(frame(spark, 2, 500))
    tied_a, tied_b = stream(frame(spark, 3, tied=True)), stream(frame(spark, 4, 400, tied=True))
    table, other = UpsertTable.of(b), UpsertTable.of(a)
    digest = lambda s, v: F.struct(((s["h"] * 31 + v["value"] + 1) % MOD).alias("h"), ((s["m"] * 31) % MOD).alias("m"))
    merge = lambda x, y: F.struct(((x["h"] * y["m"] + y["h"]) % MOD).alias("h"), ((x["m"] * y["m"]) % MOD).alias("m"))
    init = F.struct(F.lit(0).cast("long").alias("h"), F.lit(1).cast("long").alias("m"))
    gap = sessions(timedelta(minutes=90))
    sides = lambda l, r: {"l": l["value"], "r": r["value"]}
    foreign = UpsertTable.of(RecordStream(
        spark.createDataFrame([(i, f"v{i}", i) for i in range(0, 40, 2)], "pk int, name string, seq long"), "pk", "name", None, "seq"))
    owner = UpsertTable.of(a.map({"id": F.col("seq")}, {"fk": F.when(F.col("key") > 3, F.col("key")).otherwise(2)}))
    return {
        "changes": table.changes(),
        "changes_tied": UpsertTable.of(tied_a).changes(),
        "asof_inner": a.join_table(table, sides, "inner").df,
        "asof_left": a.join_table(table, sides, "left").df,
        "asof_tied": tied_a.join_table(UpsertTable.of(tied_b), sides, "left").df,
        "asof_mapped": a.join_table(table, sides, "left", on={"k": F.when(F.col("value") > 5, F.col("value") % 7)}).df,
        "table_changelog": other.join_changelog(UpsertTable.of(b.with_(df=b.df.withColumn("seq", F.col("seq") + 10_000))), sides, "full").df,
        "rekeyed": table.map_keys({"key2": F.col("value") % 5}).latest(),
        "fold": a.group_by_key().fold(init, digest, merge).df,
        "reduce": a.map_values({"lo": F.col("value"), "hi": F.col("value")}).group_by_key().reduce(
            lambda x, y: F.struct(x["lo"].alias("lo"), y["hi"].alias("hi"))).df,
        "window_fold": a.windowed_by_key(tumbling(timedelta(days=10))).fold(init, digest, merge).df,
        "table_fold": table.group_by({"g": F.col("value") % 3}).fold(
            F.struct(F.lit(0).alias("n"), F.lit(0).alias("peak")),
            lambda s, op, v: F.struct((s["n"] + op).alias("n"), F.greatest(s["peak"], s["n"] + op).alias("peak")),
            lambda x, y: F.struct((x["n"] + y["n"]).alias("n"), F.greatest(x["peak"], x["n"] + y["peak"]).alias("peak"))).df,
        "sessions": a.windowed_by_key(gap).aggregate(
            n=M.count(), total=M.sum_(F.col("value")), low=M.min_(F.col("value")), high=M.max_(F.col("value")),
            mean=M.avg(F.col("value")), opening=M.first(F.col("value"), "ts", "seq"), closing=M.last(F.col("value"), "ts", "seq")).df,
        "session_fold": a.windowed_by_key(gap).fold(init, digest, merge).df,
        "lookup_inner": a.join_lookup(LookupTable.of(foreign), lambda l, r: {"v": l["value"], "name": r["name"]}).df,
        "lookup_left": a.join_lookup(LookupTable.of(foreign), lambda l, r: {"v": l["value"], "name": r["name"]}, "left").df,
        "foreign_inner": owner.join_foreign(foreign, {"fk": F.col("fk")}).df,
        "foreign_left": owner.join_foreign(foreign, {"fk": F.col("fk")}, how="left").df,
    }


@pytest.fixture(scope="module")
def plain(spark):
    return {name: rows(df) for name, df in flows(spark).items()}


def test_split_equals_plain(spark, plain, split_hard, monkeypatch):
    monkeypatch.setattr(ordered, "BLOCK_ROWS", 7)
    found = []
    find = skew.hot_keys
    monkeypatch.setattr(skew, "hot_keys", lambda *a: found.append(find(*a)) or found[-1])
    split = {name: rows(df) for name, df in flows(spark).items()}
    assert found and all(found), "every flow should have met a hot key"
    for name, expected in plain.items():
        assert split[name] == expected, name
        assert expected, name


def test_chunks_follow_the_order(spark, split_hard):
    df = frame(spark, 5)
    chunks = skew.find_chunks(df, ["key"], ["ts", "seq"])
    chunked = chunks.assign(df).where("key = 0").orderBy("ts", "seq").collect()
    numbers = [r[skew.CHUNK] for r in chunked]
    assert numbers == sorted(numbers)
    sizes = [numbers.count(n) for n in set(numbers)]
    assert len(sizes) > 2 and max(sizes) < len(numbers) / 2


def test_small_input_is_not_examined(spark):
    assert skew.find_chunks(frame(spark, 6), ["key"], ["ts", "seq"]) is None


def test_folds_are_right(spark, split_hard, monkeypatch):
    """Against a plain loop, with blocks of a few rows."""
    monkeypatch.setattr(ordered, "BLOCK_ROWS", 3)
    df = frame(spark, 7)
    got = {r["key"]: r["text"] for r in stream(df).map_values({"text": F.col("value").cast("string")}).group_by_key().reduce(
        lambda a, b: F.struct(F.concat(a["text"], F.lit(","), b["text"]).alias("text"))).df.collect()}
    expected = {}
    for r in sorted(df.collect(), key=lambda r: (r["ts"], r["seq"])):
        if r["value"] is not None:
            expected.setdefault(r["key"], []).append(str(r["value"]))
    assert got == {k: ",".join(v) for k, v in expected.items()}


@pytest.mark.parametrize("split", [False, True])
def test_sessions_are_right(spark, request, split):
    if split:
        request.getfixturevalue("split_hard")
    df, gap = frame(spark, 8), timedelta(minutes=100)
    got = rows(stream(df).windowed_by_key(sessions(gap)).count().df)
    times = {}
    for r in df.collect():
        if r["value"] is not None:
            times.setdefault(r["key"], []).append(r["ts"])
    expected = []
    for key, found in times.items():
        found.sort()
        begin, size = found[0], 0
        for i, ts in enumerate(found):
            size += 1
            if i + 1 == len(found) or found[i + 1] > ts + gap:
                expected.append((key, begin, ts, size))
                begin, size = found[i + 1] if i + 1 < len(found) else None, 0
    assert got == sorted(expected, key=repr)


def test_session_gap_is_inclusive(spark):
    data = [("k", 1, START + timedelta(minutes=m), m) for m in (0, 10, 21)]
    df = spark.createDataFrame(data, "key string, value int, ts timestamp_ntz, seq long")
    got = rows(stream(df).windowed_by_key(sessions(timedelta(minutes=10))).count().df)
    assert [r[1:] for r in got] == [(START, START + timedelta(minutes=10), 2), (START + timedelta(minutes=21),) * 2 + (1,)]
    folded = stream(df).windowed_by_key(sessions(timedelta(minutes=10))).reduce(
        lambda a, b: F.struct((a["value"] + b["value"]).alias("value")))
    assert rows(folded.df) == got


@pytest.mark.parametrize("how", ["inner", "left", "full"])
def test_interval_join_against_brute_force(spark, how):
    left, right = frame(spark, 9, 300, tied=True), frame(spark, 10, 300, tied=True)
    before, after = timedelta(minutes=4), timedelta(minutes=1)
    got = stream(left).join_stream(stream(right), before, after, lambda l, r: {"l": l["value"], "r": r["value"]}, how)
    ls = [r for r in left.collect() if r["value"] is not None]
    rs = [r for r in right.collect() if r["value"] is not None]
    pairs = [(l, r) for l in ls for r in rs if l["key"] == r["key"] and l["ts"] - before <= r["ts"] <= l["ts"] + after]
    expected = [(l["key"], l["value"], r["value"], l["ts"], l["seq"]) for l, r in pairs]
    if how != "inner":
        met = {l["seq"] for l, _ in pairs}
        expected += [(l["key"], l["value"], None, l["ts"], l["seq"]) for l in ls if l["seq"] not in met]
    if how == "full":
        met = {r["seq"] for _, r in pairs}
        expected += [(r["key"], None, r["value"], r["ts"], r["seq"]) for r in rs if r["seq"] not in met]
    assert rows(got.df) == sorted(expected, key=repr)


KINDS = [("int", "bigint"), ("bigint", "int"), ("decimal(10,0)", "decimal(10,2)"), ("decimal(10,2)", "bigint"),
         ("date", "timestamp"), ("string", "int"), ("bigint", "double")]


def keyed_as(column, kind):
    day = F.date_add(F.lit("2024-01-01").cast("date"), column.cast("int"))
    return (day if kind in ("date", "timestamp") else column).cast(kind)


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("left,right", KINDS)
def test_lookups_find_keys_of_another_type_split_or_not(spark, request, left, right, how):
    records = frame(spark, 11, 300)
    stream_ = RecordStream(records.withColumn("key", keyed_as(F.col("key"), left)), "key", "value")
    names = spark.range(20).select(keyed_as(F.col("id"), right).alias("k"), F.concat(F.lit("n"), "id").alias("name"))

    def found():
        table = LookupTable(names, "k", "name")
        looked = stream_.join_lookup(table, lambda l, r: {"v": l["value"], "name": r["name"]}, how).df.select("seq", "name")
        rows_ = UpsertTable(records.select("seq", "key", "ts", F.lit(1).alias("one")), "seq", ("key",), "ts", ())
        foreign = rows_.join_foreign(UpsertTable(names, "k", "name", None, (), is_snapshot=True),
                                     {"k": keyed_as(F.col("key"), left)}, lambda l, r: {"name": r["name"]}, how)
        return rows(looked), rows(foreign.df.select("seq", "name"))

    plain = found()
    request.getfixturevalue("split_hard")
    assert found() == plain
    usable = records.where("value IS NOT NULL" + (" AND key < 20" if how == "inner" else ""))
    expected = [(r["seq"], f"n{r['key']}" if r["key"] < 20 else None) for r in usable.collect()]
    assert plain[0] == sorted(expected, key=repr)


def test_no_broadcast_is_asked_for_above_a_generator(spark):
    policy = skew.SplitPolicy()
    small = written(spark.range(1000), "small")
    assert skew.fits_broadcast(small.where("id > 3").select("id"), policy)
    exploded = small.select("id", F.explode(F.sequence(F.lit(0), F.lit(2000))).alias("n"))
    assert not skew.fits_broadcast(exploded, policy)
    assert not skew.fits_broadcast(small.join(small.withColumnRenamed("id", "b"), F.col("id") < F.col("b")), policy)


def test_pieces_are_of_absolute_size(spark, monkeypatch):
    spark.conf.set("relstream.split.min_bytes", "0")
    try:
        df = written(spark.range(60_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("key")), "keys")
        hot = skew.hot_keys(df, ["key"], skew.SplitPolicy(min_bytes=0, min_rows=100))
        (only,) = hot.values()
        assert 20_000 <= only.rows <= 20_010 and only.pieces >= 200
    finally:
        spark.conf.unset("relstream.split.min_bytes")
