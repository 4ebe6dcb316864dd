"""Streaming twins: the same results from replayed micro-batches."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from relstream import Joiner, RecordStream, TopicSpec, UpsertTable, hopping, sessions, tumbling
from relstream.catalog import aggregates, joins, stateless, tables  # noqa: F401
from relstream.catalog.registry import EVENTS, QUERIES, events, query
from relstream.functions import mergeable as M
from relstream.plans.scratch import scratch_path
from relstream.sources.topics import read_json_records
from relstream.streaming import keyed, running, windowed
from relstream.catalog.replay import appended, replay, updated

DAY, SIX_HOURS, HALF_HOUR = timedelta(days=1), timedelta(hours=6), timedelta(minutes=30)
LATE = timedelta(hours=1)


def twin(name: str, of: str):
    """Registers a streaming query that must give what the batch query gives."""
    return query(name, QUERIES[of].sql)


def local_time(df):
    """Streams carry instants; the tables hold local times, which are the same in UTC."""
    return df.select(*[
        F.col(f.name).cast("timestamp_ntz").alias(f.name) if f.dataType.typeName() == "timestamp" else F.col(f.name)
        for f in df.schema
    ])


def users(spark, folder) -> UpsertTable:
    return UpsertTable.of(replay(events(spark, folder), flush=False), deleted=F.col("event_type") == "error")


@query("stream_filter_to_topic", f"SELECT * FROM ({EVENTS}) WHERE event_type <> 'view' AND cents > 2000")
def stream_filter_to_topic(spark, folder):
    """A stateless flow written to a topic that another query reads."""
    flow = replay(events(spark, folder)).filter((F.col("event_type") != "view") & (F.col("cents") > 2000))
    topic = TopicSpec(scratch_path(spark, "topic"), flow.rows().schema, partition_by=("event_type",))
    writing = flow.to(topic, scratch_path(spark, "checkpoint"))
    writing.processAllAvailable()
    writing.stop()
    return local_time(topic.read(spark)).select("user_id", "event_type", "cents", "ts", "event_id")


@query("stream_through", f"SELECT * FROM ({EVENTS}) WHERE cents > 2000 AND event_type <> 'view'")
def stream_through(spark, folder):
    """One query writes to a topic, a second one goes on from there."""
    flow = replay(events(spark, folder), flush=False).filter(F.col("cents") > 2000)
    topic = TopicSpec(scratch_path(spark, "topic"), flow.rows().schema)
    spark.createDataFrame([], topic.schema).write.parquet(topic.location)  # the reader needs the folder
    onward, writing = flow.through(topic)
    writing.processAllAvailable()
    writing.stop()
    return local_time(appended(onward.filter(F.col("event_type") != "view").rows(), spark))


@twin("stream_table_snapshot", "table_latest")
def stream_table_snapshot(spark, folder):
    """The state of a running table, kept up to date by its query."""
    table = users(spark, folder)
    topic = TopicSpec(scratch_path(spark, "state"), table.rows().schema)
    keeping = table.save_snapshot(topic)
    keeping.processAllAvailable()
    keeping.stop()
    return local_time(table.read_state(topic, spark).rows())


@twin("stream_decode", "source_decode")
def stream_decode(spark, folder):
    raw = RecordStream(stateless.raw_events(spark, folder), "user_id", "raw", "ts", "event_id")
    replayed = replay(raw, flush=False)
    return local_time(appended(read_json_records(replayed.df, ["user_id"], "raw", "k int", "ts", ["event_id"]).rows(), spark))


@twin("stream_foreach", "foreach_audit")
def stream_foreach(spark, folder):
    flow = replay(events(spark, folder), flush=False)
    path = scratch_path(spark, "foreach")
    writer = flow.foreach(stateless.refuse_errors, path).option("checkpointLocation", scratch_path(spark, "checkpoint"))
    writer.trigger(availableNow=True).start().awaitTermination()
    event = F.get_json_object("seq", "$.event_id").cast("long").alias("event_id")
    return spark.read.parquet(path).select("operator", "key", "error", event)


@twin("stream_latest", "table_latest")
def stream_latest(spark, folder):
    table = users(spark, folder)
    last = updated(table.latest_versions(), table.key, spark)
    return local_time(last.where(F.col("event_type").isNotNull()))


@twin("stream_count", "count")
def stream_count(spark, folder):
    table = users(spark, folder)
    return updated(table.to_stream().group_by_key().count().df, table.key, spark)


@twin("stream_tumbling_count", "tumbling_count")
def stream_tumbling_count(spark, folder):
    stream = replay(events(spark, folder))
    return local_time(appended(stream.windowed_by_key(tumbling(DAY, LATE)).count().df, spark))


@twin("stream_hopping_aggregate", "hopping_aggregate")
def stream_hopping_aggregate(spark, folder):
    grouped = replay(events(spark, folder)).windowed_by_key(hopping(DAY, SIX_HOURS, LATE))
    found = grouped.aggregate(total=M.sum_(F.col("cents")), n=M.count(), low=M.min_(F.col("cents")))
    return local_time(appended(found.df, spark))


@twin("stream_session_aggregate", "session_aggregate")
def stream_session_aggregate(spark, folder):
    grouped = replay(events(spark, folder)).windowed_by_key(sessions(SIX_HOURS, LATE))
    found = grouped.aggregate(
        total=M.sum_(F.col("cents")), n=M.count(), low=M.min_(F.col("cents")),
        opened=M.first(F.col("event_type"), "ts", "event_id"), closed=M.last(F.col("event_type"), "ts", "event_id"))
    return local_time(appended(found.df, spark))


@query("stream_late_drop", f"""
    WITH counted AS (SELECT *, {aggregates.TUMBLING} FROM ({EVENTS})),
    edge AS (SELECT max(ts) - INTERVAL 10 DAY AS watermark FROM events WHERE event_type <> 'error')
    SELECT event_type AS kind, window_start, window_end, count(*) AS count FROM counted, edge
    WHERE event_type <> 'error' OR window_end > watermark GROUP BY ALL""")
def stream_late_drop(spark, folder):
    """Errors arrive after everything else; those older than the retention are not counted."""
    stream = events(spark, folder)
    late = stream.rows().where("event_type = 'error'")
    replayed = replay(stream.filter(F.col("event_type") != "error"), late=late)
    grouped = replayed.windowed_by({"kind": F.col("event_type")}, tumbling(DAY, timedelta(days=10)))
    return local_time(appended(grouped.count().df, spark))


def stream_interval(how: str):
    def build(spark, folder):
        clicks = replay(events(spark, folder, "click"))
        purchases = replay(events(spark, folder, "purchase"), session=clicks.spark)
        joiner = lambda l, r: {"clicked": l["cents"], "bought": r["cents"]}
        flow = clicks.join_stream(purchases, HALF_HOUR, HALF_HOUR, joiner, how, late=LATE)
        return local_time(appended(flow.rows(), spark))
    twin(f"stream_interval_{how}", f"join_interval_{how}")(build)


for _how in ("inner", "left", "full"):
    stream_interval(_how)


def stream_asof(how: str):
    def build(spark, folder):
        stream = replay(events(spark, folder, "purchase", "view"), flush=False)
        views = UpsertTable.of(stream.filter(F.col("event_type") == "view"))
        flow = keyed.join_table(stream.filter(F.col("event_type") == "purchase"), views, joins.SEEN, how, spread=2)
        return local_time(appended(flow.rows(), spark))
    twin(f"stream_asof_{how}", f"join_asof_{how}")(build)


def stream_lookup(how: str):
    def build(spark, folder):
        stream = replay(events(spark, folder), flush=False)
        table = joins.builders(stream.spark, folder)
        return local_time(appended(stream.join_lookup(table, joins.NAMED, how).rows(), spark))
    twin(f"stream_lookup_{how}", f"join_lookup_{how}")(build)


for _how in ("inner", "left"):
    stream_asof(_how)
    stream_lookup(_how)


@twin("stream_table_join", "table_join_changelog")
def stream_table_join(spark, folder):
    stream = replay(events(spark, folder, "click", "purchase"), flush=False)

    def last_of(kind: str, deleted_above: int) -> UpsertTable:
        records = stream.filter(F.col("event_type") == kind).map_values({"cents": F.col("cents")})
        return UpsertTable.of(records, deleted=F.col("cents") > deleted_above)

    total = lambda l, r: l["cents"] + F.coalesce(r["cents"], F.lit(0))
    joiner = Joiner(lambda l, r: {"total": total(l, r), "paired": r["cents"].isNotNull()}, lambda l, r: total(l, r) != 5000)
    return local_time(appended(keyed.join_changelog(last_of("click", 8000), last_of("purchase", 5000), joiner, "left").rows(), spark))


@twin("stream_table_changes", "table_changes")
def stream_table_changes(spark, folder):
    return local_time(appended(keyed.changes(users(spark, folder)), spark))


@query("stream_table_count", QUERIES["table_reduce_sum"].sql.replace("SELECT kind,", "SELECT kind, count(user_id) AS count,", 1))
def stream_table_count(spark, folder):
    """Retraction in one query: change rows from keyed state, summed per group."""
    grouped = users(spark, folder).group_by({"kind": F.col("event_type")})
    return updated(grouped.totals(cents=F.col("cents")).df, ["kind"], spark)


@twin("stream_table_map_keys", "table_map_keys")
def stream_table_map_keys(spark, folder):
    """A re-keyed table on a stream: its log, of which the last version of each new key counts."""
    slot = F.concat_ws("-", "event_type", F.floor(F.col("cents") / 1000))
    table = users(spark, folder).map_keys({"slot": slot})
    last = updated(table.latest_versions(), table.key, spark)
    return local_time(last.where(F.col("event_type").isNotNull()).drop("op"))


@twin("stream_changelog_late", "table_changes")
def stream_changelog_late(spark, folder):
    """Every tenth event comes once more, after all others: nothing changes, and the late ones are marked."""
    stream = events(spark, folder)
    late = stream.rows().where("event_id % 10 = 0")
    table = UpsertTable.of(replay(stream, late=late, flush=False), deleted=F.col("event_type") == "error")
    found = appended(keyed.changes(table, with_late=True), spark)
    return local_time(found.where("op <> 0"))


@twin("stream_asof_late", "join_asof_left")
def stream_asof_late(spark, folder):
    """Views that come once more after all others replace no later view."""
    stream = events(spark, folder, "purchase", "view")
    replayed = replay(stream, late=stream.rows().where("event_type = 'view' AND event_id % 10 = 0"), flush=False)
    views = UpsertTable.of(replayed.filter(F.col("event_type") == "view"))
    flow = keyed.join_table(replayed.filter(F.col("event_type") == "purchase"), views, joins.SEEN, "left", spread=2)
    return local_time(appended(flow.rows(), spark))


@query("stream_fold", f"""
    SELECT user_id, count(*) AS n, list_reduce(list_prepend(CAST(0 AS BIGINT), list(cents ORDER BY ts, event_id)),
           lambda a, x: (a * a + x) % {aggregates.PRIME}) AS digest
    FROM ({EVENTS}) GROUP BY user_id""")
def stream_fold(spark, folder):
    """A step that no merge can undo: the state is squared."""
    def step(state, value):
        return {"n": state["n"] + 1, "digest": (state["digest"] ** 2 + value["cents"]) % aggregates.PRIME}

    stream = replay(events(spark, folder), flush=False)
    folded = keyed.fold(stream, lambda: {"n": 0, "digest": 0}, step, "n long, digest long")
    return updated(folded, ["user_id"], spark).drop("live")


@query("stream_table_fold", f"""
    SELECT event_type AS kind, CAST(sum(op) AS BIGINT) AS n, CAST(sum(op * cents) AS BIGINT) AS total
    FROM ({QUERIES['table_changes'].sql}) GROUP BY event_type HAVING sum(op) > 0""")
def stream_table_fold(spark, folder):
    """Any adder and subtractor: change rows go through a topic, a second query folds them."""
    changes = appended(keyed.changes(users(spark, folder)), spark)
    log = RecordStream(
        changes.select(F.col("event_type").alias("kind"), "op", "cents", "ts",
                       (F.col("event_id") * 2 + F.col("op")).alias("at")),
        "kind", ("op", "cents"), "ts", "at")

    def step(state, value):
        n, total = state["n"] + value["op"], state["total"] + value["op"] * value["cents"]
        return {"n": n, "total": total} if n else None

    folded = keyed.fold(replay(log, flush=False), lambda: {"n": 0, "total": 0}, step, "n long, total long")
    return updated(folded, ["kind"], spark).where("live").drop("live")


@twin("stream_tumbling_fold", "tumbling_any")
def stream_tumbling_fold(spark, folder):
    """Any step inside day windows, with state that goes once a window is out."""
    stream = replay(events(spark, folder))
    found = keyed.window_fold(stream, tumbling(DAY, LATE), lambda: aggregates.ZERO, aggregates.square, "n long, digest long")
    return local_time(appended(found, spark))


@query("stream_session_fold", aggregates.session_sql("user_id", """
    count(*) AS n, list_reduce(list_prepend(CAST(0 AS BIGINT), list(cents ORDER BY ts, event_id)),
    lambda a, x: (a * 31 + x) % 1000003) AS digest"""))
def stream_session_fold(spark, folder):
    """A step and a merger inside sessions."""
    prime = aggregates.PRIME

    def step(state, value):
        return {"n": state["n"] + 1, "digest": (state["digest"] * 31 + value["cents"]) % prime}

    def merge(a, b):
        return {"n": a["n"] + b["n"], "digest": (a["digest"] * pow(31, b["n"], prime) + b["digest"]) % prime}

    found = keyed.session_fold(replay(events(spark, folder)), sessions(SIX_HOURS, LATE), lambda: aggregates.ZERO, step, merge,
                               "n long, digest long")
    return local_time(appended(found, spark))


def stream_table_fk_join(how: str):
    def build(spark, folder):
        """Users' last events against the last purchase of the user that they point at; both sides change all the time."""
        stream = replay(events(spark, folder), flush=False)
        left = UpsertTable.of(stream.filter(F.col("event_type") != "purchase"), deleted=F.col("cents") > 9000)
        right = UpsertTable.of(stream.filter(F.col("event_type") == "purchase"), deleted=F.col("cents") > 8000)
        joiner = lambda l, r: {"cents": l["cents"], "bought": r["cents"]}
        joined = running.join_foreign(left, right, {"u": F.col("cents") % 150}, joiner, how, spread=2)
        log = appended(joined.rows(), spark)
        return joined.with_(df=log, rejects=()).latest().select("user_id", "cents", "bought")
    query(f"stream_table_fk_join_{how}", f"""
        WITH l AS (SELECT user_id, arg_max(cents, (ts, event_id)) AS cents FROM ({EVENTS}) WHERE event_type <> 'purchase' GROUP BY user_id),
        r AS (SELECT user_id AS u, arg_max(cents, (ts, event_id)) AS bought FROM ({EVENTS}) WHERE event_type = 'purchase' GROUP BY user_id)
        SELECT user_id, cents, bought FROM (SELECT * FROM l WHERE cents <= 9000) {how} JOIN (SELECT * FROM r WHERE bought <= 8000)
        ON u = cents % 150""")(build)


for _how in ("inner", "left"):
    stream_table_fk_join(_how)


def _last_versions(table, spark):
    """The current rows of a running table, by its log."""
    return local_time(table.with_(df=appended(table.rows(), spark), rejects=()).latest())


@twin("stream_table_reduce", "table_reduce_sum")
def stream_table_reduce(spark, folder):
    """Adder and subtractor over the rows' own column, in one query; groups that empty keep 0."""
    grouped = users(spark, folder).map_values({"cents": F.col("cents"), "event_type": F.col("event_type")}).group_by({"kind": F.col("event_type")})
    reduced = running.reduce(grouped, lambda a, b: {**a, "cents": a["cents"] + b["cents"]}, lambda a, b: {**a, "cents": a["cents"] - b["cents"]})
    return _last_versions(reduced, spark).select("kind", "cents")


@twin("stream_table_aggregate", "table_aggregate")
def stream_table_aggregate(spark, folder):
    """Any state with an adder and a subtractor, which deletes an emptied group; its next row starts it again."""
    def add(state, value):
        return {"n": state["n"] + 1, "total": state["total"] + value["cents"]}

    def subtract(state, value):
        return {"n": state["n"] - 1, "total": state["total"] - value["cents"]} if state["n"] > 1 else None

    grouped = users(spark, folder).group_by({"band": F.floor(F.col("cents") / 1000)})
    found = running.aggregate(grouped, lambda: {"n": 0, "total": 0}, add, subtract, "n long, total long")
    return _last_versions(found, spark).select("band", "n", "total")


def of_kind(stream, kind: str):
    """Records of one kind, and the one without a value that ends a replay."""
    return stream.with_(df=stream.df.where((F.col("event_type") == kind) | F.col("event_type").isNull()))


def stream_asof_out_of_order(how: str):
    def build(spark, folder):
        """Rows arrive up to three hours late, in an order of their own; every purchase still sees the view of its time."""
        given = events(spark, folder, "purchase", "view")
        delay = F.expr("make_dt_interval(0, 0, 0, cast(pmod(xxhash64(event_id), 10800) as decimal(8, 0)))")
        arriving = RecordStream(given.rows().withColumn("arrival", F.col("ts") + delay), given.key, (*given.value, "ts"), "arrival", given.seq)
        live = replay(arriving, slices=5)
        # The record that ends the replay has no time but its arrival.
        df = live.df.withColumn("ts", F.coalesce(F.col("ts").cast("timestamp"), F.col("arrival")))
        stream = RecordStream(df, given.key, given.value, "ts", given.seq)
        views = UpsertTable.of(of_kind(stream, "view"))
        flow = running.join_versions(of_kind(stream, "purchase"), views, joins.SEEN, how, late=timedelta(hours=4), spread=2)
        return local_time(appended(flow.rows(), spark))
    twin(f"stream_asof_out_of_order_{how}", f"join_asof_{how}")(build)


for _how in ("inner", "left"):
    stream_asof_out_of_order(_how)


def _with_stream_failures(table, spark, *columns):
    """A running fold's last states with its failures, written by two queries of one flow."""
    bad = appended(table.quarantine(), spark)
    last = table.with_(df=appended(table.rows(), spark), rejects=()).latest()
    return aggregates.with_failures(last, bad).select(*columns, "failed")


@twin("stream_fold_error_quarantine", "fold_error_quarantine")
def stream_fold_error_quarantine(spark, folder):
    stream = replay(events(spark, folder), flush=False)
    folded = running.fold(stream, lambda: {"n": 0, "total": 0}, aggregates.picky, "n long, total long")
    return _with_stream_failures(folded, spark, "user_id", "n", "total")


@twin("stream_reduce_error_quarantine", "reduce_error_quarantine")
def stream_reduce_error_quarantine(spark, folder):
    reduced = running.reduce_records(replay(events(spark, folder), flush=False), aggregates.larger)
    return _with_stream_failures(reduced, spark, "user_id", "cents")


@twin("stream_state_view", "table_latest")
def stream_state_view(spark, folder):
    """The live rows of a running table out of its query's state; nothing is written."""
    table, checkpoint = users(spark, folder), scratch_path(spark, "checkpoint")
    holding = table.keep_state(checkpoint)
    holding.processAllAvailable()
    holding.stop()
    return local_time(table.state_view(checkpoint, spark=spark).rows())


@twin("stream_compacted_snapshot", "table_latest")
def stream_compacted_snapshot(spark, folder):
    """The state of a running table in files, with a new base after every second micro-batch."""
    table = UpsertTable.of(replay(events(spark, folder), slices=5, flush=False), deleted=F.col("event_type") == "error")
    topic = TopicSpec(scratch_path(spark, "state"), table.rows().schema)
    keeping = table.save_snapshot(topic, compact_every=2)
    keeping.processAllAvailable()
    keeping.stop()
    return local_time(table.read_state(topic, spark).rows())


@query("stream_late_quarantine", f"""
    WITH counted AS (SELECT *, {aggregates.TUMBLING} FROM ({EVENTS})),
    edge AS (SELECT max(ts) - INTERVAL 10 DAY AS watermark FROM events WHERE event_type <> 'error')
    SELECT event_type AS kind, window_start, count(*) FILTER (event_type <> 'error' OR window_end > watermark) AS count,
           count(*) FILTER (event_type = 'error' AND window_end <= watermark) AS late
    FROM counted, edge GROUP BY ALL""")
def stream_late_quarantine(spark, folder):
    """Errors arrive after everything else; those whose day is out are in the quarantine, and no event is lost."""
    given = events(spark, folder)
    replayed = replay(given.filter(F.col("event_type") != "error"), late=given.rows().where("event_type = 'error'"))
    stream = RecordStream(replayed.df.withColumnRenamed("event_type", "kind"), "kind", "cents", "ts", "event_id")
    folded = windowed.window_fold(stream, tumbling(DAY, timedelta(days=10)), lambda: {"n": 0}, lambda s, v: {"n": s["n"] + 1}, "n long")
    kept = appended(folded.rows(), spark).select("kind", "window_start", F.col("n").alias("count"), F.lit(0).cast("long").alias("late"))
    day = F.window("ts", "1 day")["start"].alias("window_start")
    refused = appended(folded.quarantine(), spark).where("operator = 'window_fold'").select(
        F.get_json_object("key", "$.kind").alias("kind"), day, F.lit(0).cast("long").alias("count"), F.lit(1).cast("long").alias("late"))
    both = kept.unionByName(refused).groupBy("kind", "window_start").agg(F.sum("count").alias("count"), F.sum("late").alias("late"))
    return local_time(both)


@query("stream_session_spread", aggregates.session_sql("user_id", "count(*) AS n, CAST(sum(cents) AS BIGINT) AS total, max(cents) AS top"))
def stream_session_spread(spark, folder):
    """Sessions whose records are dealt out to eight groups a key, each of which passes on its own sessions."""
    def step(state, value):
        return {"n": state["n"] + 1, "total": state["total"] + value["cents"], "top": max(state["top"], value["cents"])}

    def merge(a, b):
        return {"n": a["n"] + b["n"], "total": a["total"] + b["total"], "top": max(a["top"], b["top"])}

    found = windowed.session_fold(replay(events(spark, folder)), sessions(SIX_HOURS, LATE), lambda: {"n": 0, "total": 0, "top": -1 << 62},
                                  step, merge, "n long, total long, top long", spread=8)
    return local_time(appended(found.rows(), spark))
