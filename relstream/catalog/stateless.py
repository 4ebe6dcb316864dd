"""Sources, sinks, filters, maps, flow and their error policies."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from relstream import RecordStream, TopicSpec, decode_json, encode_json, read_json_records, safe_udf
from relstream.catalog.registry import EVENTS, QUERIES, VERSIONS, events, query, read, users
from relstream.plans.scratch import scratch_path
from relstream.sources.topics import JSON_TIMES

# The events table has no malformed text: an error's properties lose their closing brace.
RAW = "CASE WHEN event_type = 'error' THEN replace(props, '}', '') ELSE props END"


def raw_events(spark, folder):
    return read(spark, folder, "events").select("user_id", F.expr(RAW).alias("raw"), "ts", "event_id")


def decoded(spark, folder) -> RecordStream:
    return read_json_records(raw_events(spark, folder), ["user_id"], "raw", "k int", "ts", ["event_id"])


@query("source_decode", f"""
    SELECT user_id, CAST(json_extract(raw, '$.k') AS INTEGER) AS k, ts, event_id
    FROM (SELECT *, {RAW} AS raw FROM events) WHERE json_valid(raw)""")
def source_decode(spark, folder):
    return decoded(spark, folder).rows()


@query("source_quarantine", f"""
    SELECT 'deserialize' AS operator, '{{"user_id":' || user_id || '}}' AS key, raw,
           'malformed value' AS error, ts, '{{"event_id":' || event_id || '}}' AS seq
    FROM (SELECT *, {RAW} AS raw FROM events) WHERE NOT json_valid(raw)""")
def source_quarantine(spark, folder):
    return decoded(spark, folder).quarantine().select(
        "operator", "key", F.get_json_object("value", "$.raw").alias("raw"), "error",
        F.col("ts").cast("timestamp_ntz").alias("ts"), "seq",
    )


@query("json_decode", """
    SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, CAST(NULL AS VARCHAR) AS missing FROM events""")
def json_decode(spark, folder):
    parsed = decode_json(F.col("props"), "k int, missing string")
    return read(spark, folder, "events").select("event_id", parsed.alias("p")).select("event_id", "p.k", "p.missing")


@query("json_encode", f"""
    SELECT event_id, CASE WHEN event_type IS NOT NULL
           THEN '{{"event_type":"' || event_type || '","cents":' || cents || '}}' END AS json
    FROM ({VERSIONS})""")
def json_encode(spark, folder):
    return users(spark, folder).to_stream().rows().select("event_id", encode_json(["event_type", "cents"]).alias("json"))


@query("sink_roundtrip", EVENTS)
def sink_roundtrip(spark, folder):
    stream = events(spark, folder)
    topic = TopicSpec(scratch_path(spark, "topic"), stream.rows().schema, "json", JSON_TIMES)
    stream.to(topic)
    return topic.read(spark)


@query("sink_through", f"SELECT * FROM ({EVENTS}) WHERE event_type = 'purchase'")
def sink_through(spark, folder):
    stream = events(spark, folder)
    topic = TopicSpec(scratch_path(spark, "topic"), stream.rows().schema, partition_by=("event_type",))
    return stream.through(topic).filter(F.col("event_type") == "purchase").rows()


# -- filters -------------------------------------------------------------------------------------

@query("filter", f"SELECT * FROM ({EVENTS}) WHERE cents > 2000 AND event_type <> 'view'")
def filter_(spark, folder):
    return events(spark, folder).filter((F.col("cents") > 2000) & (F.col("event_type") != "view")).rows()


@query("filter_not", f"SELECT * FROM ({VERSIONS}) WHERE event_type IS NOT NULL AND cents IS NOT NULL AND NOT (cents > 2000 AND event_type <> 'view')")
def filter_not(spark, folder):
    condition = (F.col("cents") > 2000) & (F.col("event_type") != "view")
    return users(spark, folder).to_stream().filter_not(condition, requires=["event_type", "cents"]).rows()


@query("filter_keys", "SELECT event_type, user_id, ts, event_id FROM events WHERE event_type IN ('click', 'purchase')")
def filter_keys(spark, folder):
    by_type = events(spark, folder).map({"event_type": F.col("event_type")}, {"user_id": F.col("user_id")})
    return by_type.filter_keys(F.col("event_type").isin("click", "purchase")).rows()


@query("filter_values", f"SELECT * FROM ({EVENTS}) WHERE event_type = 'click' AND cents < 5000")
def filter_values(spark, folder):
    return events(spark, folder).filter_values((F.col("event_type") == "click") & (F.col("cents") < 5000)).rows()


@query("filter_error", f"""
    SELECT CASE WHEN hour(ts) < 12 OR cents > 5000 THEN 'kept' ELSE 'dropped' END AS part, *
    FROM ({VERSIONS}) WHERE cents IS NOT NULL
    UNION ALL
    SELECT 'failed', user_id, NULL, NULL, NULL, event_id FROM ({VERSIONS}) WHERE cents IS NULL""")
def filter_error(spark, folder):
    """The predicate fails on a null value: such records are in neither part, but quarantined."""
    condition = (F.hour("ts") < 12) | (F.col("cents") > 5000)
    stream = users(spark, folder).to_stream()
    kept, dropped = stream.filter(condition, ["cents"]), stream.filter_not(condition, ["cents"])
    label = lambda rows, name: rows.select(F.lit(name).alias("part"), "*")
    failed = kept.quarantine().select(
        F.get_json_object("key", "$.user_id").cast("long").alias("user_id"),
        F.get_json_object("seq", "$.event_id").cast("long").alias("event_id"),
    )
    parts = label(kept.rows(), "kept").unionByName(label(dropped.rows(), "dropped"))
    return parts.unionByName(label(failed, "failed"), allowMissingColumns=True)


# -- maps ----------------------------------------------------------------------------------------

@query("map_keys", f"SELECT event_type || '-' || hour(ts) AS bucket, cents, ts, event_id FROM ({EVENTS})")
def map_keys(spark, folder):
    stream = events(spark, folder)
    bucket = F.concat_ws("-", "event_type", F.hour("ts").cast("string"))
    return stream.map_keys({"bucket": bucket}).rows().drop("event_type")


@query("map_values", f"SELECT user_id, upper(event_type) AS kind, cents * 2 AS doubled, ts, event_id FROM ({EVENTS})")
def map_values(spark, folder):
    return events(spark, folder).map_values({"kind": F.upper("event_type"), "doubled": F.col("cents") * 2}).rows()


@query("map", f"SELECT event_type AS kind, user_id AS who, cents, ts, event_id FROM ({EVENTS})")
def map_(spark, folder):
    new_value = {"who": F.col("user_id"), "cents": F.col("cents")}
    return events(spark, folder).map({"kind": F.col("event_type")}, new_value).rows()


@query("flat_map", f"""
    SELECT unnest(CASE WHEN event_type = 'error' THEN [] ELSE [event_type, 'all'] END) AS topic, cents, ts, event_id
    FROM ({EVENTS})""")
def flat_map(spark, folder):
    pair = F.array(*[F.struct(t.alias("topic"), F.col("cents").alias("cents")) for t in (F.col("event_type"), F.lit("all"))])
    records = F.when(F.col("event_type") == "error", F.slice(pair, 1, 0)).otherwise(pair)
    return events(spark, folder).flat_map(records, ["topic"], ["cents"]).rows()


def coins(record):
    """One record per kind of coin that the cents are paid in; some amounts fail on the way."""
    rest = record["cents"]
    for coin in (50, 20, 1):
        yield {"coin": coin, "number": rest // coin, "kind": record["event_type"]}
        if rest % 97 == 0:
            raise ValueError("cents")
        rest %= coin


COINS = f"""
    SELECT coin, CAST(CASE coin WHEN 50 THEN cents // 50 WHEN 20 THEN cents % 50 // 20 ELSE cents % 50 % 20 END AS BIGINT) AS number,
           event_type AS kind, ts, event_id
    FROM ({EVENTS}), (VALUES (50), (20), (1)) AS c(coin)
    WHERE cents % 97 <> 0 AND cents % 50 % 97 <> 0 AND cents % 50 % 20 % 97 <> 0"""


@query("flat_map_udtf", COINS)
def flat_map_udtf(spark, folder):
    return events(spark, folder).flat_map_any(coins, "coin int", "number long, kind string").rows()


@query("flat_map_values", """
    SELECT word, count(*) AS count FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents)
    WHERE word <> '' GROUP BY word""")
def flat_map_values(spark, folder):
    docs = read(spark, folder, "documents").select("doc_id", "text", F.col("doc_id").alias("at"))
    words = RecordStream(docs, "doc_id", "text", None, "at").flat_map_values("word", F.split("text", " ", -1))
    return words.filter(F.col("word") != "").map({"word": F.col("word")}, {"one": F.lit(1)}).group_by_key().count().df


def _kept_and_rejected(flow, *columns):
    """Result records and quarantine rows of one flow in one frame."""
    kept = flow.rows().select(F.lit("ok").alias("part"), *columns, "event_id")
    bad = flow.quarantine().select(
        F.col("operator").alias("part"), *[F.lit(None).cast(flow.df.schema[c].dataType).alias(c) for c in columns],
        F.get_json_object("seq", "$.event_id").cast("long").alias("event_id"),
    )
    return kept.unionByName(bad)


@query("map_keys_error", f"""
    SELECT CASE WHEN event_type IS NULL THEN 'map_keys' ELSE 'ok' END AS part, event_type, event_id FROM ({VERSIONS})""")
def map_keys_error(spark, folder):
    flow = users(spark, folder).to_stream().map_keys({"event_type": F.col("event_type")})
    return _kept_and_rejected(flow, "event_type")


@query("map_values_error", f"""
    SELECT CASE WHEN cents IN (1000, 2000) THEN 'map_values' ELSE 'ok' END AS part,
           CASE WHEN cents NOT IN (1000, 2000) THEN 1000000 // abs((cents - 1000) * (cents - 2000)) END AS ratio, event_id
    FROM ({EVENTS})""")
def map_values_error(spark, folder):
    """Division by zero: `try_divide` is null, which `valid` turns into a failure."""
    gap = F.abs((F.col("cents") - 1000) * (F.col("cents") - 2000))
    ratio = F.floor(F.try_divide(F.lit(1000000), gap)).cast("long")
    return _kept_and_rejected(events(spark, folder).map_values({"ratio": ratio}, valid=gap != 0), "ratio")


@query("map_error", f"""
    SELECT CASE WHEN number IS NULL THEN 'map' ELSE 'ok' END AS part, number, event_id
    FROM (SELECT event_id, try_cast(split_part(raw, ':', 2) AS INTEGER) AS number
          FROM (SELECT event_id, CASE WHEN event_type = 'view' THEN 'who:?' ELSE 'who:' || user_id END AS raw FROM events))""")
def map_error(spark, folder):
    df = read(spark, folder, "events")
    raw = F.when(F.col("event_type") == "view", "who:?").otherwise(F.concat(F.lit("who:"), F.col("user_id").cast("string")))
    stream = RecordStream(df.select("user_id", raw.alias("raw"), "ts", "event_id"), "user_id", "raw", "ts", "event_id")
    number = F.split_part("raw", F.lit(":"), F.lit(2)).try_cast("int")
    return _kept_and_rejected(stream.map({"number": number}, {"raw": F.col("raw")}), "number")


@query("map_values_udf", f"""
    SELECT CASE WHEN json_valid(raw) THEN 'ok' ELSE 'map_values' END AS part,
           CASE WHEN json_valid(raw) THEN CAST(json_extract(raw, '$.k') AS BIGINT) END AS k, event_id
    FROM (SELECT *, {RAW} AS raw FROM events)""")
def map_values_udf(spark, folder):
    """A Python function that raises on malformed text."""
    parse = safe_udf(lambda text: json.loads(text)["k"], "long")(F.col("raw"))
    stream = RecordStream(raw_events(spark, folder), "user_id", "raw", "ts", "event_id")
    parsed = stream.map_values({"r": parse})
    return _kept_and_rejected(parsed.map_values({"k": F.col("r.value")}, valid=F.col("r.error").isNull()), "k")


@query("flat_map_error", f"""
    SELECT 'ok' AS part, unnest([cents, -cents]) AS amount, event_id FROM ({VERSIONS}) WHERE cents IS NOT NULL
    UNION ALL
    SELECT 'flat_map_values', NULL, event_id FROM ({VERSIONS}) WHERE cents IS NULL""")
def flat_map_error(spark, folder):
    amounts = F.when(F.col("cents").isNotNull(), F.array(F.col("cents"), -F.col("cents")))
    return _kept_and_rejected(users(spark, folder).to_stream().flat_map_values("amount", amounts), "amount")


@query("flat_map_udtf_error", f"""
    SELECT 'ok' AS part, number, event_id FROM ({COINS})
    UNION ALL
    SELECT 'flat_map_any', NULL, event_id FROM ({EVENTS})
    WHERE cents % 97 = 0 OR cents % 50 % 97 = 0 OR cents % 50 % 20 % 97 = 0""")
def flat_map_udtf_error(spark, folder):
    return _kept_and_rejected(events(spark, folder).flat_map_any(coins, "coin int", "number long, kind string"), "number")


# -- flow ----------------------------------------------------------------------------------------

def _numbered(parts):
    first, *others = [p.rows().select(F.lit(i).alias("branch"), "*") for i, p in enumerate(parts)]
    for other in others:
        first = first.unionByName(other)
    return first


@query("branch", f"""
    SELECT CASE WHEN cents IS NOT NULL AND cents > 5000 THEN 0 WHEN hour(ts) < 12 THEN 1 ELSE 2 END AS branch, *
    FROM ({VERSIONS}) WHERE coalesce(cents > 5000, FALSE) OR hour(ts) < 12 OR event_type = 'view'""")
def branch(spark, folder):
    stream = users(spark, folder).to_stream()
    parts = stream.branch((F.col("cents") > 5000, ("cents",)), F.hour("ts") < 12, F.col("event_type") == "view")
    return _numbered(parts)


@query("branch_once", QUERIES["branch"].sql)
def branch_once(spark, folder):
    """The branches written in one pass, each read from its own folder."""
    stream = users(spark, folder).to_stream()
    return _numbered(stream.branch_through((F.col("cents") > 5000, ("cents",)), F.hour("ts") < 12, F.col("event_type") == "view"))


@query("split", f"""
    SELECT cents > 2000 AND hour(ts) < 12 AS matches, * FROM ({VERSIONS}) WHERE cents IS NOT NULL""")
def split(spark, folder):
    yes, no = users(spark, folder).to_stream().split((F.col("cents") > 2000) & (F.hour("ts") < 12), ("cents",))
    return yes.rows().select(F.lit(True).alias("matches"), "*").unionByName(no.rows().select(F.lit(False).alias("matches"), "*"))


@query("split_once", f"""
    SELECT CASE WHEN cents IS NULL THEN 'split' WHEN cents > 2000 AND hour(ts) < 12 THEN 'yes' ELSE 'no' END AS part, event_id FROM ({VERSIONS})""")
def split_once(spark, folder):
    """Both halves and the quarantine of one pass: every version is in exactly one of them."""
    yes, no = users(spark, folder).to_stream().split_through((F.col("cents") > 2000) & (F.hour("ts") < 12), ("cents",))
    failed = yes.quarantine().select(F.col("operator").alias("part"), F.get_json_object("seq", "$.event_id").cast("long").alias("event_id"))
    halves = [p.df.select(F.lit(name).alias("part"), "event_id") for name, p in (("yes", yes), ("no", no))]
    return halves[0].unionByName(halves[1]).unionByName(failed)


def remainder(cents: int) -> int:
    if cents % 97 == 0:
        raise ValueError("cents")
    return cents * cents % 1009


@query("map_values_once", f"""
    SELECT CASE WHEN cents % 97 = 0 THEN 'map_values' ELSE 'ok' END AS part,
           CASE WHEN cents % 97 <> 0 THEN cents * cents % 1009 END AS number, event_id FROM ({EVENTS})""")
def map_values_once(spark, folder):
    """A Python function that is called once per record; results and failures are read from what it gave."""
    made = {"made": safe_udf(remainder, "long")("cents")}
    flow = events(spark, folder).map_through(value={"number": F.col("made.value")}, valid=F.col("made.error").isNull(), compute=made)
    return _kept_and_rejected(flow, "number")


@query("merge", f"SELECT * FROM ({EVENTS}) WHERE event_type = 'click' UNION ALL SELECT * FROM ({EVENTS}) WHERE cents > 2000")
def merge(spark, folder):
    stream = events(spark, folder)
    return stream.filter(F.col("event_type") == "click").merge(stream.filter(F.col("cents") > 2000)).rows()


@query("peek", VERSIONS)
def peek(spark, folder):
    """The metric fails on null values; the records pass all the same."""
    stream = users(spark, folder).to_stream()
    return stream.peek("flow", seen=F.count("cents"), ratio=F.sum(F.try_divide(F.lit(1), F.col("cents")))).rows()


def refuse_errors(record: dict) -> None:
    if record["event_type"] in (None, "error"):
        raise ValueError("refused")


def _refused(spark, flow):
    path = scratch_path(spark, "foreach")
    flow.foreach(refuse_errors, path)
    return spark.read.parquet(path).select("operator", "key", "error", F.get_json_object("seq", "$.event_id").cast("long").alias("event_id"))


REFUSED = """
    SELECT 'foreach' AS operator, '{"user_id":' || user_id || '}' AS key, 'ValueError: refused' AS error, event_id
    FROM events WHERE event_type = 'error'"""


@query("foreach_audit", REFUSED)
def foreach_audit(spark, folder):
    """The action refuses some records: they are its audit trail."""
    return _refused(spark, events(spark, folder))


@query("table_foreach", REFUSED)
def table_foreach(spark, folder):
    return _refused(spark, users(spark, folder))


BLANKED = "CASE WHEN event_id % 11 = 0 THEN '' WHEN event_id % 13 = 0 THEN '  ' WHEN event_id % 17 = 0 THEN 'null' ELSE props END"


@query("source_decode_blank", f"""
    SELECT 'quarantined' AS fate, count(*) AS n FROM (SELECT {BLANKED} AS raw FROM events) WHERE trim(raw) = ''
    UNION ALL SELECT 'null', count(*) FROM (SELECT {BLANKED} AS raw FROM events) WHERE raw = 'null'
    UNION ALL SELECT 'decoded', count(*) FROM (SELECT {BLANKED} AS raw FROM events) WHERE trim(raw) <> '' AND raw <> 'null'""")
def source_decode_blank(spark, folder):
    """An empty payload is malformed; only JSON null is a null value."""
    raw = F.when(F.col("event_id") % 11 == 0, "").when(F.col("event_id") % 13 == 0, "  ").when(F.col("event_id") % 17 == 0, "null")
    df = read(spark, folder, "events").withColumn("raw", raw.otherwise(F.col("props")))
    flow = read_json_records(df, ["user_id"], "raw", "k int", "ts", ["event_id"])
    fates = [("quarantined", flow.quarantine()), ("null", flow.rows().where("k IS NULL")), ("decoded", flow.rows().where("k IS NOT NULL"))]
    counts = [rows.agg(F.count("*").alias("n")).select(F.lit(fate).alias("fate"), "n") for fate, rows in fates]
    return counts[0].unionAll(counts[1]).unionAll(counts[2])


@query("map_values_udf_bigint", """
    SELECT user_id, CASE WHEN event_id % 3 <> 0 THEN 9007199254740993 + event_id END AS big, event_id FROM events""")
def map_values_udf_bigint(spark, folder):
    """Whole numbers beyond a double's precision pass a Python function beside nulls."""
    same = safe_udf(lambda x: x, "long")
    big = F.when(F.col("event_id") % 3 != 0, F.col("event_id") + F.lit(9007199254740993))
    mapped = events(spark, folder).map_values({"big": same(big)["value"]})
    return mapped.df.select("user_id", "big", "event_id")


@query("merge_quarantine_once", f"""
    SELECT operator, count(*) AS n FROM (SELECT 'deserialize' AS operator FROM (SELECT {RAW} AS raw FROM events)
    WHERE NOT json_valid(raw)) GROUP BY operator""")
def merge_quarantine_once(spark, folder):
    """Two branches of one decoded stream share its failures; merged, each is there once."""
    flow = decoded(spark, folder)
    both = flow.filter(F.col("k") < 50).merge(flow.filter(F.col("k") >= 50))
    return both.quarantine().groupBy("operator").agg(F.count("*").alias("n"))
