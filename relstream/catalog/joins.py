"""Joins whose left side is a stream."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from relstream import Joiner, LookupTable, UpsertTable
from relstream.catalog.registry import EVENTS, events, query, read

HALF_HOUR = timedelta(minutes=30)


def interval(how: str):
    def build(spark, folder):
        clicks, purchases = events(spark, folder, "click"), events(spark, folder, "purchase")
        joiner = lambda l, r: {"clicked": l["cents"], "bought": r["cents"]}
        return clicks.join_stream(purchases, HALF_HOUR, HALF_HOUR, joiner, how).rows()
    query(f"join_interval_{how}", interval_sql(how))(build)


def interval_sql(how: str) -> str:
    return f"""
        SELECT coalesce(l.user_id, r.user_id) AS user_id, l.cents AS clicked, r.cents AS bought,
               coalesce(l.ts, r.ts) AS ts, coalesce(l.event_id, r.event_id) AS event_id
        FROM (SELECT * FROM ({EVENTS}) WHERE event_type = 'click') l
        {how} JOIN (SELECT * FROM ({EVENTS}) WHERE event_type = 'purchase') r
        ON l.user_id = r.user_id AND r.ts BETWEEN l.ts - INTERVAL 30 MINUTE AND l.ts + INTERVAL 30 MINUTE"""


for _how in ("inner", "left", "full"):
    interval(_how)


@query("join_lookup_mixed_types", """
    SELECT e.user_id, e.event_type, c.c_name AS name, e.event_id
    FROM events e JOIN customer c ON CAST(e.user_id AS DECIMAL(12, 2)) = c.c_custkey""")
def join_lookup_mixed_types(spark, folder):
    """A key with a scale finds a whole-number key."""
    stream = events(spark, folder).map_keys({"user": F.col("user_id").cast("decimal(12,2)")})
    customers = read(spark, folder, "customer").select("c_custkey", "c_name")
    joined = stream.join_lookup(LookupTable(customers, "c_custkey", "c_name"),
                                lambda l, r: {"event_type": l["event_type"], "name": r["c_name"]})
    return joined.df.select(F.col("user").cast("long").alias("user_id"), "event_type", "name", "event_id")


SEEN = lambda l, r: {"bought": l["cents"], "viewed": r["cents"]}


def asof_sql(how: str) -> str:
    return f"""
        SELECT l.user_id, l.cents AS bought, r.cents AS viewed, l.ts, l.event_id
        FROM (SELECT * FROM ({EVENTS}) WHERE event_type = 'purchase') l
        ASOF {how} JOIN (SELECT * FROM ({EVENTS}) WHERE event_type = 'view') r
        ON l.user_id = r.user_id AND l.ts >= r.ts"""


def views(spark, folder) -> UpsertTable:
    return UpsertTable.of(events(spark, folder, "view"))


def asof(how: str):
    def build(spark, folder):
        return events(spark, folder, "purchase").join_table(views(spark, folder), SEEN, how).rows()
    query(f"join_asof_{how}", asof_sql(how))(build)


def asof_mapped(how: str):
    def build(spark, folder):
        purchases = events(spark, folder, "purchase").map(
            {"event_type": F.col("event_type")}, {"user_id": F.col("user_id"), "cents": F.col("cents")})
        joiner = lambda l, r: {"user_id": l["user_id"], **SEEN(l, r)}
        return purchases.join_table(views(spark, folder), joiner, how, on={"u": F.col("user_id")}).rows()
    query(f"join_asof_mapped_{how}", f"SELECT 'purchase' AS event_type, * FROM ({asof_sql(how)})")(build)


def builders(spark, folder) -> LookupTable:
    customers = read(spark, folder, "customer").where("c_mktsegment = 'BUILDING'")
    return LookupTable(customers, "c_custkey", ("c_name", "c_nationkey"))


NAMED = lambda l, r: {"cents": l["cents"], "name": r["c_name"]}


def lookup_sql(how: str, columns: str = "user_id") -> str:
    return f"""
        SELECT {columns}, cents, c_name AS name, ts, event_id FROM ({EVENTS})
        {how} JOIN (SELECT * FROM customer WHERE c_mktsegment = 'BUILDING') ON user_id = c_custkey"""


def lookup(how: str):
    def build(spark, folder):
        return events(spark, folder).join_lookup(builders(spark, folder), NAMED, how).rows()
    query(f"join_lookup_{how}", lookup_sql(how))(build)


def lookup_mapped(how: str):
    def build(spark, folder):
        stream = events(spark, folder).map(
            {"event_type": F.col("event_type")}, {"user_id": F.col("user_id"), "cents": F.col("cents")})
        return stream.join_lookup(builders(spark, folder), NAMED, how, on={"u": F.col("user_id")}).rows()
    query(f"join_lookup_mapped_{how}", lookup_sql(how, "event_type"))(build)


for _how in ("inner", "left"):
    asof(_how)
    asof_mapped(_how)
    lookup(_how)
    lookup_mapped(_how)


@query("join_key_error", f"""
    SELECT 'inner' AS how, user_id, cents, c_name AS name, event_id FROM ({EVENTS})
    JOIN (SELECT * FROM customer WHERE c_mktsegment = 'BUILDING') ON user_id = c_custkey AND event_type <> 'error'
    UNION ALL
    SELECT 'left', user_id, cents, c_name, event_id FROM ({EVENTS})
    LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment = 'BUILDING') ON user_id = c_custkey AND event_type <> 'error'
    UNION ALL
    SELECT 'quarantine', user_id, NULL, NULL, event_id FROM ({EVENTS}) WHERE event_type = 'error'""")
def join_key_error(spark, folder):
    """The mapper yields no key for errors: they match nothing, and an inner join quarantines them."""
    stream, table = events(spark, folder), builders(spark, folder)
    on = {"u": F.when(F.col("event_type") != "error", F.col("user_id"))}
    inner, left = (stream.join_lookup(table, NAMED, how, on) for how in ("inner", "left"))
    parts = [
        flow.rows().select(F.lit(how).alias("how"), "user_id", "cents", "name", "event_id")
        for how, flow in (("inner", inner), ("left", left))
    ]
    bad = inner.quarantine().select(
        F.lit("quarantine").alias("how"),
        F.get_json_object("key", "$.user_id").cast("long").alias("user_id"),
        F.lit(None).cast("long").alias("cents"), F.lit(None).cast("string").alias("name"),
        F.get_json_object("seq", "$.event_id").cast("long").alias("event_id"),
    )
    return parts[0].unionByName(parts[1]).unionByName(bad)


@query("join_error_quarantine", f"""
    SELECT 'join_lookup' AS operator, 'join function failed' AS error, '{{"user_id":' || user_id || '}}' AS key, event_id
    FROM ({EVENTS}) JOIN customer ON user_id = c_custkey WHERE cents = 0 OR cents % 7 = 0""")
def join_error_quarantine(spark, folder):
    """A join function that refuses some pairs."""
    customers = LookupTable(read(spark, folder, "customer").select("c_custkey", "c_name"), "c_custkey", "c_name")
    joiner = Joiner(lambda l, r: {"name": r["c_name"]}, valid=lambda l, r: l["cents"] % 7 != 0)
    bad = events(spark, folder).join_lookup(customers, joiner).quarantine()
    return bad.select("operator", "error", "key", F.get_json_object("seq", "$.event_id").cast("long").alias("event_id"))


@query("branch_error_quarantine", f"""
    SELECT 'branch' AS operator, event_id FROM ({EVENTS}) WHERE cents % 5 <> 0 AND event_type = 'error'""")
def branch_error_quarantine(spark, folder):
    """The second condition cannot be evaluated for errors; records of the first branch never reach it."""
    known = F.when(F.col("event_type") != "error", F.col("cents") > 100)
    branches = events(spark, folder).branch(F.col("cents") % 5 == 0, known)
    bad = branches[0].merge(branches[1]).quarantine()
    return bad.select("operator", F.get_json_object("seq", "$.event_id").cast("long").alias("event_id"))
