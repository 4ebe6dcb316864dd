"""Named queries over the shared tables, each with the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relstream import RecordStream, UpsertTable

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    build: Build
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    def register(build: Build) -> Build:
        QUERIES[name] = Query(build, sql)
        return build
    return register


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def cents(column: str):
    """A double amount as whole cents, so that sums do not depend on the order of addition."""
    return F.round(F.col(column) * 100).cast("long")


def events(spark: SparkSession, folder: str, *kinds: str) -> RecordStream:
    """Events as records of their user; with `kinds`, only those event types."""
    df = read(spark, folder, "events")
    if kinds:
        df = df.where(F.col("event_type").isin(*kinds))
    rows = df.select("user_id", "event_type", cents("value").alias("cents"), "ts", "event_id")
    return RecordStream(rows, "user_id", ("event_type", "cents"), "ts", "event_id")


def users(spark: SparkSession, folder: str, on_null: str = "delete") -> UpsertTable:
    """Each user's last event as a table; an error deletes the user's row."""
    return UpsertTable.of(events(spark, folder), deleted=F.col("event_type") == "error", on_null=on_null)


# SQL twins of the two inputs above.
EVENTS = "SELECT user_id, event_type, CAST(round(value * 100) AS BIGINT) AS cents, ts, event_id FROM events"
VERSIONS = f"""
    SELECT user_id, CASE WHEN event_type <> 'error' THEN event_type END AS event_type,
           CASE WHEN event_type <> 'error' THEN cents END AS cents, ts, event_id
    FROM ({EVENTS})"""
LATEST = f"""
    SELECT * FROM ({VERSIONS})
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""
CHANGES = f"""
    WITH v AS (
      SELECT *, lag(event_type) OVER w AS old_type, lag(cents) OVER w AS old_cents
      FROM ({VERSIONS}) WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
    SELECT user_id, -1 AS op, old_type AS event_type, old_cents AS cents, ts, event_id FROM v WHERE old_type IS NOT NULL
    UNION ALL
    SELECT user_id, 1, event_type, cents, ts, event_id FROM v WHERE event_type IS NOT NULL"""
