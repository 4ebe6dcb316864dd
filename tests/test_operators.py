"""Maps, aggregates, error policy, sources and tables on small literal frames."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relstream import (
    Joiner, LookupTable, RecordStream, TopicSpec, UpsertTable, hopping, read_json_records, safe_udf, tumbling, unlimited,
)
from relstream.sources.sinks import encoded
from relstream.sources.topics import read_kafka_records
from frames import written
from relstream.plans.scratch import scratch_path

START = datetime(2024, 1, 1)
value = F.col("value")


def numbers(spark, rows):
    """(key, value, minute) rows, numbered by arrival."""
    data = [(k, v, START + timedelta(minutes=m), i) for i, (k, v, m) in enumerate(rows)]
    return RecordStream(spark.createDataFrame(data, "key string, value int, ts timestamp_ntz, seq long"), "key", "value")


def shown(df, *columns):
    return sorted([tuple(r) for r in df.select(*columns).collect()], key=repr)


# -- maps and their failures ---------------------------------------------------------------------

def test_map_values_keeps_null_results_unless_invalid(spark):
    flow = numbers(spark, [("a", 1, 0), ("b", 0, 0), ("c", None, 0)])
    inverse = {"inverse": F.try_divide(F.lit(12), value)}
    assert shown(flow.map_values(inverse).df, "key", "inverse") == [("a", 12.0), ("b", None), ("c", None)]
    strict = flow.map_values(inverse, valid=value != 0)
    assert shown(strict.df, "key", "inverse") == [("a", 12.0)]
    assert shown(strict.quarantine(), "operator", "key", "error") == [
        ("map_values", '{"key":"b"}', "map_values failed"), ("map_values", '{"key":"c"}', "map_values failed")]


def test_fallback_replaces_failed_results(spark):
    flow = numbers(spark, [("a", 1, 0), ("b", 0, 0)])
    mapped = flow.map_values({"x": F.try_divide(F.lit(12), value)}, valid=value != 0, fallback={"x": F.lit(-1.0)})
    assert shown(mapped.df, "key", "x") == [("a", 12.0), ("b", -1.0)]


def test_map_keys_drops_records_without_a_key(spark):
    flow = numbers(spark, [("a", 1, 0), ("b", None, 0)]).map_keys({"id": value})
    assert flow.key == ("id",) and flow.value == ("value",)
    assert shown(flow.df, "id") == [(1,)]
    assert flow.quarantine().count() == 1


def test_quarantine_collects_along_the_flow(spark):
    flow = numbers(spark, [("a", 1, 0), ("b", None, 0), (None, 3, 0)])
    flow = flow.filter(value > 0).map_keys({"key2": F.col("key")})
    assert shown(flow.quarantine(), "operator", "value") == [("filter", "{}"), ("map_keys", '{"value":3}')]


def test_flat_map_of_empty_and_failed_arrays(spark):
    flow = numbers(spark, [("a", 2, 0), ("b", 0, 0), ("c", None, 0)])
    repeated = F.when(value == 0, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(1), value))
    expanded = flow.flat_map_values("n", repeated)
    assert shown(expanded.df, "key", "n") == [("a", 1), ("a", 2)]
    assert shown(expanded.quarantine(), "key") == [('{"key":"c"}',)]
    pairs = F.transform(repeated, lambda n: F.struct(n.alias("k"), F.col("key").alias("v")))
    assert shown(flow.flat_map(pairs, ["k"], ["v"]).df, "k", "v") == [(1, "a"), (2, "a")]


def test_safe_udf_turns_exceptions_into_data(spark):
    parse = safe_udf(lambda n: 10 // n, "int")(value).alias("r")
    rows = numbers(spark, [("a", 5, 0), ("b", 0, 0), ("c", None, 0)]).rows().select("key", parse).select("key", "r.*")
    got = {r["key"]: (r["value"], (r["error"] or "").split(":")[0]) for r in rows.collect()}
    assert got == {"a": (2, ""), "b": (None, "ZeroDivisionError"), "c": (None, "TypeError")}


def test_a_column_has_one_role(spark):
    with pytest.raises(ValueError):
        RecordStream(spark.range(1), "id", "id", None, "id")


# -- aggregates ----------------------------------------------------------------------------------

def test_aggregates_ignore_records_without_key_or_value(spark):
    flow = numbers(spark, [("a", 1, 0), ("a", None, 1), (None, 5, 2), ("b", 2, 3)])
    assert shown(flow.group_by_key().count().df, "key", "count") == [("a", 1), ("b", 1)]


def test_reduce_and_fold_follow_the_order(spark):
    flow = numbers(spark, [("a", 1, 30), ("a", 2, 10), ("a", 3, 20), ("b", 9, 0)])
    text = flow.map_values({"t": value.cast("string")})
    joined = text.group_by_key().reduce(lambda x, y: F.struct(F.concat(x["t"], y["t"]).alias("t")))
    assert shown(joined.df, "key", "t") == [("a", "231"), ("b", "9")]


def test_failed_steps_keep_the_state(spark):
    flow = numbers(spark, [("a", 4, 0), ("a", 0, 1), ("a", 2, 2)])
    halve = lambda s, v: F.when(v["value"] != 0, F.struct((s["n"] + v["value"]).alias("n")))
    join = lambda x, y: F.struct((x["n"] + y["n"]).alias("n"))
    zero = F.struct(F.lit(0).alias("n"))
    assert shown(flow.group_by_key().fold(zero, halve, join).df, "n") == [(6,)]


def test_null_initial_state_and_failed_merge(spark, split_hard):
    rows = [("a", n, n) for n in range(40)]
    null = F.lit(None).cast("struct<n:int>")
    step = lambda s, v: F.struct(F.greatest(F.coalesce(s["n"], v["value"]), v["value"]).alias("n"))
    assert shown(numbers(spark, rows).group_by_key().fold(null, step, lambda x, y: null).df, "n")[0][0] is not None


def test_window_edges(spark):
    flow = numbers(spark, [("a", 1, 0), ("a", 1, 9), ("a", 1, 10), ("a", 1, 25)])
    at = lambda m: START + timedelta(minutes=m)
    ten = timedelta(minutes=10)
    assert shown(flow.windowed_by_key(tumbling(ten)).count().df, "window_start", "window_end", "count") == [
        (at(0), at(10), 2), (at(10), at(20), 1), (at(20), at(30), 1)]
    hops = flow.windowed_by_key(hopping(ten, timedelta(minutes=5))).count().df
    assert {r["window_start"]: r["count"] for r in hops.collect()} == {
        at(-5): 1, at(0): 2, at(5): 2, at(10): 1, at(20): 1, at(25): 1}
    assert shown(flow.windowed_by_key(unlimited(at(9))).count().df, "window_start", "window_end", "count") == [(at(9), None, 3)]


# -- tables --------------------------------------------------------------------------------------

def table(spark, rows, **options):
    return UpsertTable.of(numbers(spark, rows), **options)


UPDATES = [("a", 1, 0), ("b", 2, 1), ("a", 3, 2), ("b", None, 3), ("c", 1, 4), ("b", 5, 5), ("c", None, 6)]


def test_latest_with_deletes(spark):
    assert shown(table(spark, UPDATES).latest(), "key", "value") == [("a", 3), ("b", 5)]
    assert shown(table(spark, UPDATES, on_null="ignore").latest(), "key", "value") == [("a", 3), ("b", 5), ("c", 1)]


def test_changes_retract_what_they_replace(spark):
    changes = table(spark, UPDATES).changes().orderBy("seq", "op")
    assert [(r["key"], r["op"], r["value"]) for r in changes.collect()] == [
        ("a", 1, 1), ("b", 1, 2), ("a", -1, 1), ("a", 1, 3), ("b", -1, 2), ("c", 1, 1), ("b", 1, 5), ("c", -1, 1)]


def test_changes_add_up_to_the_snapshot(spark):
    found = table(spark, UPDATES)
    sums = found.changes().groupBy("key").agg(F.sum("op").alias("n"), F.sum(F.col("op") * value).alias("v"))
    assert shown(sums.where("n = 1"), "key", "v") == shown(found.latest(), "key", "value")
    assert shown(sums.where("n not in (0, 1)"), "key") == []


def test_group_counts_keep_emptied_groups(spark):
    grouped = table(spark, UPDATES).group_by({"parity": value % 2})
    assert shown(grouped.count().df, "parity", "count") == [(0, 0), (1, 2)]
    assert shown(grouped.aggregate(drop_empty=True, total=F.sum("value")).df, "parity", "total") == [(1, 8)]
    assert shown(grouped.reduce(empty={"low": F.lit(-1)}, low=F.min("value")).df, "parity", "low") == [(0, -1), (1, 3)]
    assert shown(table(spark, UPDATES).group_by_key().count().df, "key", "count") == [("a", 1), ("b", 1), ("c", 0)]


def test_group_changes_equal_group_aggregates(spark):
    grouped = table(spark, UPDATES).group_by({"parity": value % 2})
    sums = grouped.changes().groupBy("__g0").agg(F.sum("op").alias("n"))
    assert shown(sums, "__g0", "n") == shown(grouped.count().df, "parity", "count")


def test_table_fold_may_delete_groups(spark):
    grouped = table(spark, UPDATES).group_by({"parity": value % 2})
    add = lambda s, op, v: F.struct((s["n"] + op).alias("n"))
    both = lambda x, y: F.struct((x["n"] + y["n"]).alias("n"))
    zero = F.struct(F.lit(0).alias("n"))
    assert shown(grouped.fold(zero, add, both, deleted=lambda s: s["n"] == 0).df, "parity", "n") == [(1, 2)]


def test_rekeying_lets_the_last_change_win(spark):
    """a and b collide on 0; taking back a's old row deletes the key that b had written."""
    rows = [("a", 10, 0), ("b", 20, 1), ("a", 11, 2)]
    rekeyed = table(spark, rows).map_keys({"digit": value % 10})
    assert shown(rekeyed.latest(), "digit", "value") == [(1, 11)]


def test_rows_without_a_new_key_are_quarantined(spark):
    mapped = table(spark, [("a", 10, 0), ("b", 3, 1)]).map({"k": F.when(value > 5, value)}, {"v": value + 1})
    assert shown(mapped.latest(), "k", "v") == [(10, 11)]
    assert shown(mapped.quarantine(), "operator", "key") == [("map", '{"key":"b"}')]


def test_table_map_values_deletes_on_failure(spark):
    mapped = table(spark, [("a", 2, 0), ("b", 1, 1), ("b", 0, 2)]).map_values({"x": F.try_divide(F.lit(4), value)}, valid=value != 0)
    assert shown(mapped.latest(), "key", "x") == [("a", 2.0)]


def test_aggregate_results_are_tables(spark):
    counts = numbers(spark, [("a", 1, 0), ("a", 2, 1), ("b", 1, 2)]).group_by_key().count()
    sums = numbers(spark, [("a", 1, 0), ("c", 2, 1)]).group_by_key().aggregate(total=F.sum("value"))
    joined = counts.filter(F.col("count") > 1).join(sums, how="full")
    assert shown(joined.latest(), "key", "count", "total") == [("a", 2, 1), ("c", None, 2)]
    assert shown(counts.group_by({"n": F.col("count")}).count("keys").df, "n", "keys") == [(1, 1), (2, 1)]


def test_lookup_from_a_table_takes_its_live_rows(spark):
    lookup = LookupTable.of(table(spark, UPDATES))
    joined = numbers(spark, [("a", 7, 0), ("c", 8, 0)]).join_lookup(lookup, how="left")
    assert shown(joined.df, "key", "value", "value_right") == [("a", 7, 3), ("c", 8, None)]


def test_failed_join_function_gives_a_null_value(spark):
    lookup = LookupTable.of(table(spark, UPDATES))
    joiner = Joiner(lambda l, r: {"sum": l["value"] + r["value"]}, valid=lambda l, r: l["value"] != 7)
    joined = numbers(spark, [("a", 7, 0), ("b", 8, 0)]).join_lookup(lookup, joiner)
    assert shown(joined.df, "key", "sum") == [("a", None), ("b", 13)]


def test_snapshot_view(spark):
    table(spark, UPDATES).snapshot_as("now")
    assert shown(spark.sql("SELECT * FROM now"), "key", "value") == [("a", 3), ("b", 5)]


# -- sources and scratch -------------------------------------------------------------------------

def test_decoding_splits_good_from_malformed(spark):
    data = [(1, '{"n": 1, "extra": true}', 0), (2, '{"n": "x"}', 1), (3, "{", 2), (4, None, 3), (5, "null", 4), (6, "{}", 5)]
    df = spark.createDataFrame(data, "key int, raw string, seq long")
    flow = read_json_records(df, ["key"], "raw", "n int", None, ["seq"])
    assert shown(flow.df, "key", "n") == [(1, 1), (4, None), (5, None), (6, None)]
    assert shown(flow.quarantine(), "key") == [('{"key":2}',), ('{"key":3}',)]


@pytest.mark.parametrize("kind", ["parquet", "json", "orc"])
def test_topics_round_trip(spark, tmp_path, kind):
    flow = numbers(spark, [("a", 1, 0), ("b", None, 1)])
    flow = flow.with_(df=flow.df.withColumn("ts", F.col("ts").cast("timestamp")))
    topic = TopicSpec(str(tmp_path / "t"), flow.rows().schema, kind)
    assert shown(flow.through(topic).rows(), *flow.columns) == shown(flow.rows(), *flow.columns)


def test_scratch_follows_the_session(spark):
    before = spark.conf.get("spark.checkpoint.dir", None)
    path = scratch_path(spark, "x")
    assert path.startswith(before) if before else "relstream" in path
    assert written(spark.range(3), "numbers").count() == 3


def test_kafka_records_round_trip(spark):
    """The columns of the Kafka source and sink, without a broker."""
    flow = numbers(spark, [("a", 1, 0), ("b", None, 1)])
    sent = encoded(flow, TopicSpec("t", flow.rows().schema, "kafka"))
    assert sorted(map(tuple, sent.collect())) == [('{"key":"a"}', '{"value":1}'), ('{"key":"b"}', None)]
    bad = spark.createDataFrame([('{"key":"c"}', "{"), ("[", '{"value":2}')], "key string, value string")
    received = sent.unionByName(bad).select(
        F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"),
        F.lit(START).cast("timestamp").alias("timestamp"), F.monotonically_increasing_id().alias("offset"),
    )
    back = read_kafka_records(received, "key string", "value int")
    assert shown(back.df, "key", "value") == [("a", 1), ("b", None)]
    assert back.quarantine().count() == 2


# -- cases that failed once ----------------------------------------------------------------------

BIG = 2 ** 53 + 1


def test_whole_numbers_pass_python_functions_beside_nulls(spark, tmp_path):
    df = spark.createDataFrame([("a", BIG, 0), ("b", None, 1)], "key string, value long, seq long").coalesce(1)
    same = safe_udf(lambda x: x, "long")
    assert shown(df.select(same("value")["value"].alias("v")), "v") == [(BIG,), (None,)]
    assert df.select(same("value")["value"].alias("v")).schema["v"].dataType.typeName() == "long"

    def refuse(record):
        raise ValueError(type(record["value"]).__name__)

    RecordStream(df, "key", "value", None, "seq").foreach(refuse, str(tmp_path / "bad"))
    bad = spark.read.parquet(str(tmp_path / "bad"))
    assert shown(bad, "value", "error") == [('{"value":%d}' % BIG, "ValueError: int"), ("{}", "ValueError: NoneType")]


def test_a_result_of_the_wrong_type_is_its_records_failure(spark):
    df = spark.createDataFrame([(1,), (2,)], "x int").coalesce(1)
    odd = safe_udf(lambda x: "text" if x == 2 else x, "int")
    got = df.select(odd("x").alias("r")).select("r.value", F.col("r.error").isNull().alias("ok"))
    assert shown(got, "value", "ok") == [(1, True), (None, False)]


def test_emptied_and_null_groups(spark):
    df = spark.createDataFrame([("a", "x", None, 0), ("b", "y", "t", 1), ("b", None, None, 2), ("c", None, "z", 3)],
                               "key string, g string, s string, seq long")
    table = UpsertTable(df, "key", ("g", "s"), None, "seq")
    got = table.group_by({"g": F.col("g")}, valid=F.lit(True)).aggregate(top=F.max("s"), n=F.count("s")).df
    assert shown(got, "g", "top", "n") == [("x", None, 0), ("y", None, 0)]


def test_a_step_to_null_deletes_the_group_and_the_next_change_starts_anew(spark):
    df = spark.createDataFrame([("a", "g", 1, 0), ("a", None, None, 1), ("b", "g", 5, 2)], "key string, g string, v int, seq long")

    def step(state, op, row):
        total = state["t"] + op * row["v"]
        return F.when(total != 100, F.struct(total.alias("t")))

    merge = lambda a, b: F.struct((a["t"] + b["t"] - 100).alias("t"))
    folded = UpsertTable(df, "key", ("g", "v"), None, "seq").group_by({"g": F.col("g")}).fold(
        F.struct(F.lit(100).alias("t")), step, merge)
    assert shown(folded.df, "g", "t") == [("g", 105)]


@pytest.mark.parametrize("raw", ["", "  ", "\t", "\n \t"])
def test_blank_payloads_are_malformed(spark, raw):
    df = spark.createDataFrame([("a", raw, 0), ("b", "\tnull ", 1), ("c", None, 2), ("d", '{"a-b": {"x-y": 1}}', 3)],
                               "key string, raw string, seq long")
    flow = read_json_records(df, "key", "raw", T.StructType().add("a-b", T.StructType().add("x-y", T.IntegerType())), None, "seq")
    assert [r["key"] for r in flow.quarantine().collect()] == ['{"key":"a"}']
    assert sorted(r["key"] for r in flow.df.collect()) == ["b", "c", "d"]


def test_latest_of_values_that_have_no_order(spark):
    df = spark.createDataFrame([("a", {"x": 1}, 0), ("a", {"x": 2}, 1), ("b", {"y": 1}, 0), ("b", None, 1)],
                               "key string, m map<string,int>, seq long")
    latest = UpsertTable(df, "key", "m", None, "seq").latest()
    assert [(r["key"], r["m"]) for r in latest.collect()] == [("a", {"x": 2})]


def test_a_shared_failure_is_quarantined_once_and_to_the_microsecond(spark):
    at = datetime(2024, 1, 1, 1, 2, 3, 456789)
    df = spark.createDataFrame([("a", "{", at, 0), ("b", '{"k": 1}', at, 1)], "key string, raw string, ts timestamp, seq long")
    flow = read_json_records(df, "key", "raw", "k int", "ts", "seq")
    both = flow.filter(F.col("k") > 0).merge(flow.filter(F.col("k") <= 0))
    assert both.quarantine().count() == 1
    bad = RecordStream(df.select("key", F.col("ts").alias("when"), "ts", "seq"), "key", "when").map_values(
        {"x": F.col("when")}, valid=F.lit(False)).quarantine()
    assert all("456789" in r["value"] for r in bad.collect())


def test_updates_of_both_sides_may_tie(spark):
    left = UpsertTable(spark.createDataFrame([("k", "l", 0)], "key string, v string, seq long"), "key", "v", None, "seq")
    right = UpsertTable(spark.createDataFrame([("k", "r", 0)], "key string, w string, seq long"), "key", "w", None, "seq")
    log = left.join_changelog(right, lambda l, r: {"l": l["v"], "r": r["w"]}, "full").df
    assert shown(log, "l", "r") == [("l", "r"), ("l", None)]


def test_records_for_kafka_may_name_their_partition(spark):
    stream = numbers(spark, [("a", 1, 0), ("b", None, 1)])
    topic = TopicSpec("t", stream.rows().schema, "kafka", partition=F.length("key") % 4)
    assert shown(encoded(stream, topic), "key", "value", "partition") == [('{"key":"a"}', '{"value":1}', 1), ('{"key":"b"}', None, 1)]
    back = read_kafka_records(encoded(stream, topic).select("key", "value", F.lit(START).cast("timestamp").alias("timestamp"), F.lit(1).alias("offset")),
                              "key string", "value int")
    assert shown(back.df, "key", "value") == [("a", 1), ("b", None)]


def test_overlapping_windows_of_many_panes(spark):
    """A day sliding by a minute: records are aggregated per minute, not repeated 1,440 times."""
    from relstream.functions import mergeable as M
    stream = numbers(spark, [("k", 1, 0), ("k", 2, 0), ("k", 4, 700)])
    got = stream.windowed_by_key(hopping(timedelta(days=1), timedelta(minutes=1))).aggregate(n=M.count(), s=M.sum_(value))
    counts = {(r["n"], r["s"]): r["count"] for r in got.df.groupBy("n", "s").count().collect()}
    assert counts == {(2, 3): 700, (3, 7): 740, (1, 4): 700}
    odd = stream.windowed_by_key(hopping(timedelta(minutes=10), timedelta(minutes=4)))
    plain = odd.aggregate(n=F.count("value"), s=F.sum("value")).df
    assert shown(odd.aggregate(n=M.count(), s=M.sum_(value)).df, *plain.columns) == shown(plain, *plain.columns)


def test_folds_with_any_step(spark):
    stream = numbers(spark, [("a", 3, 0), ("a", 5, 1), ("a", 0, 2), ("a", 2, 3), ("b", 7, 0), ("c", -1, 0), (None, 1, 0)])

    def step(state, record):
        if record["value"] == 0:
            raise ValueError("left alone")
        return {"t": state["t"] ** 2 + record["value"]} if record["value"] > 0 else None

    got = stream.group_by_key().fold_any(lambda: {"t": 1}, step, "t long")
    assert shown(got.df, "key", "t") == [("a", (16 + 5) ** 2 + 2), ("b", 8)]


def test_old_scratch_is_cleared_and_new_scratch_stays(spark, tmp_path, monkeypatch):
    from relstream.plans import scratch
    monkeypatch.setattr(scratch, "_root", lambda spark: f"file://{tmp_path}")
    written(spark.range(3), "numbers")
    clear = scratch.clear_scratch
    assert clear(spark) == 0 and clear(spark, timedelta(seconds=-60)) == 1 and clear(spark) == 0


# -- Python functions: many records of one, and aggregates in partial states ---------------------------

def test_flat_map_any_is_all_or_nothing_per_record(spark):
    def letters(record):
        for k in range(record["value"]):
            yield {"letter": record["key"], "k": k}
            if record["value"] == 3:
                raise ValueError("three")

    flow = numbers(spark, [("a", 2, 0), ("b", 0, 1), ("c", 3, 2), ("d", None, 3), (None, 1, 4)])
    made = flow.flat_map_any(letters, "letter string", "k int, absent double")
    assert shown(made.df, "letter", "k", "absent") == [("a", 0, None), ("a", 1, None), (None, 0, None)]
    bad = {r["key"]: r["error"] for r in made.quarantine().where("operator = 'flat_map_any'").collect()}
    assert bad['{"key":"c"}'] == "ValueError: three" and bad['{"key":"d"}'].startswith("TypeError") and len(bad) == 2
    wrong = flow.flat_map_any(lambda record: [{"k": "not a number"}], "letter string", "k int")
    assert wrong.df.collect() == [] and wrong.quarantine().count() == 5
    assert numbers(spark, []).flat_map_any(letters, "letter string", "k int").df.collect() == []


@pytest.mark.parametrize("held", [1, 3, 1000])
def test_partial_states_are_merged_whatever_a_task_holds(spark, held):
    from relstream.plans.sequential import ERROR, partial_fold

    def add(state, given):
        if given["value"] % 10 == 7:
            raise ValueError("seven")
        return {"n": state["n"] + 1, "top": max(state["top"], given["value"])}

    def both(a, b):
        return {"n": a["n"] + b["n"], "top": max(a["top"], b["top"])}

    rows = spark.range(3000).selectExpr("IF(id % 3 = 0, 'hot', CAST(id % 13 AS STRING)) AS key", "id AS value", "id AS seq").repartition(5)
    found = partial_fold(rows, ["key"], ["seq"], ["value"], lambda: {"n": 0, "top": -1}, add, both, "n long, top long", held)
    expected: dict = {}
    for k in range(3000):
        if k % 10 != 7:
            key = "hot" if k % 3 == 0 else str(k % 13)
            n, top = expected.get(key, (0, -1))
            expected[key] = (n + 1, max(top, k))
    assert {r["key"]: (r["n"], r["top"]) for r in found.where(F.col(ERROR).isNull()).collect()} == expected
    assert found.where(F.col(ERROR) == "ValueError: seven").count() == 300


def test_aggregate_any_keeps_what_a_merge_fails_on(spark):
    def refuse(a, b):
        raise ValueError("no merge")

    flow = numbers(spark, [("a", k, k) for k in range(8)] + [("b", 1, 9)])
    spread = flow.with_(df=flow.df.repartition(4, "seq"))
    made = spread.group_by_key().aggregate_any(lambda: {"n": 0}, lambda s, v: {"n": s["n"] + 1}, refuse, "n long")
    kept, bad = dict(shown(made.df, "key", "n")), made.quarantine().where("operator = 'aggregate_any'").collect()
    assert set(kept) == {"a", "b"} and kept["b"] == 1 and bad and all(r["error"] == "ValueError: no merge" for r in bad)
    empty = numbers(spark, []).group_by_key().aggregate_any(lambda: {"n": 0}, lambda s, v: None, refuse, "n long")
    assert empty.df.collect() == []
    gone = flow.group_by_key().aggregate_any(lambda: {"n": 0}, lambda s, v: None, refuse, "n long")
    assert gone.df.collect() == []
