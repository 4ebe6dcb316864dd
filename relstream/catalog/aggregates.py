"""Grouped, windowed and session aggregates of streams, and retracting aggregates of tables."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from relstream import hopping, sessions, tumbling, unlimited
from relstream.catalog.registry import CHANGES, EVENTS, LATEST, VERSIONS, events, query, users
from relstream.functions import mergeable as M

DAY, SIX_HOURS = timedelta(days=1), timedelta(hours=6)
PRIME = 1_000_003
TOTAL = "CAST(sum(cents) AS BIGINT)"


@query("count", f"SELECT user_id, count(*) AS count FROM ({VERSIONS}) WHERE event_type IS NOT NULL GROUP BY user_id")
def count(spark, folder):
    """Records without a value are not counted."""
    return users(spark, folder).to_stream().group_by_key().count().df


@query("group_by_mapped_count", f"""
    SELECT event_type AS kind, CAST(hour(ts) AS BIGINT) AS hour, count(*) AS count FROM ({VERSIONS})
    WHERE event_type IS NOT NULL GROUP BY ALL""")
def group_by_mapped_count(spark, folder):
    """Records for which the mapper yields no key are ignored."""
    stream = users(spark, folder).to_stream()
    return stream.group_by({"kind": F.col("event_type"), "hour": F.hour("ts").cast("long")}).count().df


@query("reduce_max", f"SELECT user_id, max(cents) AS cents FROM ({EVENTS}) GROUP BY user_id")
def reduce_max(spark, folder):
    return events(spark, folder).group_by_key().aggregate(cents=F.max("cents")).df


@query("aggregate", f"""
    SELECT user_id, count(*) AS n, {TOTAL} AS total, min(cents) AS low, max(cents) AS high,
           count(DISTINCT event_type) AS kinds, arg_max(event_type, (ts, event_id)) AS last_type
    FROM ({EVENTS}) GROUP BY user_id""")
def aggregate(spark, folder):
    return events(spark, folder).group_by_key().aggregate(
        n=F.count("*"), total=F.sum("cents"), low=F.min("cents"), high=F.max("cents"),
        kinds=F.count_distinct("event_type"),
        last_type=F.max_by("event_type", F.struct("ts", "event_id")),
    ).df


# An order-sensitive value: the polynomial digest of a run of amounts, with the factor that appends
# a run to it. Appending is associative but not commutative.

def single(amount: Column) -> dict[str, Column]:
    return {"digest": amount % PRIME, "factor": F.lit(31).cast("long")}


def append(a: Column, b: Column) -> Column:
    return F.struct(
        ((a["digest"] * b["factor"] + b["digest"]) % PRIME).alias("digest"),
        ((a["factor"] * b["factor"]) % PRIME).alias("factor"),
    )


def digest_sql(group: str, source: str, extra: str = "") -> str:
    return f"""SELECT {group}, list_reduce(list_prepend(CAST(0 AS BIGINT), list(cents ORDER BY ts, event_id)),
               lambda a, x: (a * 31 + x) % {PRIME}) AS digest {extra} FROM ({source}) GROUP BY ALL"""


@query("reduce_fold", digest_sql("user_id", EVENTS))
def reduce_fold(spark, folder):
    runs = events(spark, folder).map_values(single(F.col("cents")))
    return runs.group_by_key().reduce(append).df.drop("factor")


def empty() -> Column:
    return F.struct(F.lit(0).cast("long").alias("digest"), F.lit(1).cast("long").alias("factor"))


def extend(state: Column, value: Column) -> Column:
    return append(state, F.struct(*[c.alias(n) for n, c in single(value["cents"]).items()]))


@query("aggregate_fold", digest_sql("event_type AS kind", EVENTS))
def aggregate_fold(spark, folder):
    """Folds a few large groups to another type."""
    grouped = events(spark, folder).group_by({"kind": F.col("event_type")})
    return grouped.fold(empty(), extend, append).df.drop("factor")


@query("aggregate_error", digest_sql("user_id", f"SELECT * FROM ({EVENTS}) WHERE event_type <> 'error'"))
def aggregate_error(spark, folder):
    """The step fails on errors, which leaves the state as it was."""
    step = lambda state, value: F.when(value["event_type"] != "error", extend(state, value))
    return events(spark, folder).group_by_key().fold(empty(), step, append).df.drop("factor")


# -- time windows --------------------------------------------------------------------------------

TUMBLING = "date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end"
HOPPED = f"""
    SELECT * EXCLUDE (starts), starts AS window_start, starts + INTERVAL 1 DAY AS window_end FROM (
      SELECT *, unnest([time_bucket(INTERVAL 6 HOUR, ts) - i * INTERVAL 6 HOUR FOR i IN range(4)]) AS starts FROM ({EVENTS}))"""


@query("tumbling_count", f"SELECT user_id, {TUMBLING}, count(*) AS count FROM ({EVENTS}) GROUP BY ALL")
def tumbling_count(spark, folder):
    return events(spark, folder).windowed_by_key(tumbling(DAY)).count().df


@query("hopping_count", f"SELECT user_id, window_start, window_end, count(*) AS count FROM ({HOPPED}) GROUP BY ALL")
def hopping_count(spark, folder):
    return events(spark, folder).windowed_by_key(hopping(DAY, SIX_HOURS)).count().df


@query("unlimited_count", f"""
    SELECT user_id, TIMESTAMP '2024-01-10' AS window_start, CAST(NULL AS TIMESTAMP) AS window_end, count(*) AS count
    FROM ({EVENTS}) WHERE ts >= TIMESTAMP '2024-01-10' GROUP BY ALL""")
def unlimited_count(spark, folder):
    return events(spark, folder).windowed_by_key(unlimited(datetime(2024, 1, 10))).count().df


@query("window_mapped_count", f"SELECT event_type AS kind, {TUMBLING}, count(*) AS count FROM ({EVENTS}) GROUP BY ALL")
def window_mapped_count(spark, folder):
    return events(spark, folder).windowed_by({"kind": F.col("event_type")}, tumbling(DAY)).count().df


@query("tumbling_reduce", f"SELECT user_id, {TUMBLING}, max(cents) AS cents FROM ({EVENTS}) GROUP BY ALL")
def tumbling_reduce(spark, folder):
    return events(spark, folder).windowed_by_key(tumbling(DAY)).aggregate(cents=F.max("cents")).df


@query("tumbling_fold", digest_sql(f"user_id, {TUMBLING}", EVENTS))
def tumbling_fold(spark, folder):
    return events(spark, folder).windowed_by_key(tumbling(DAY)).fold(empty(), extend, append).df.drop("factor")


@query("hopping_aggregate", f"""
    SELECT user_id, window_start, window_end, {TOTAL} AS total, count(*) AS n, min(cents) AS low
    FROM ({HOPPED}) GROUP BY ALL""")
def hopping_aggregate(spark, folder):
    grouped = events(spark, folder).windowed_by_key(hopping(DAY, SIX_HOURS))
    return grouped.aggregate(total=M.sum_(F.col("cents")), n=M.count(), low=M.min_(F.col("cents"))).df


@query("hopping_fold", digest_sql("user_id, window_start, window_end", HOPPED))
def hopping_fold(spark, folder):
    """An ordered fold in overlapping windows, from the states of their panes."""
    return events(spark, folder).windowed_by_key(hopping(DAY, SIX_HOURS)).fold(empty(), extend, append).df.drop("factor")


def square(state: dict, value: dict) -> dict:
    """A step that no merge can undo: the state is squared."""
    return {"n": state["n"] + 1, "digest": (state["digest"] ** 2 + value["cents"]) % PRIME}


def squared_sql(group: str, source: str) -> str:
    return f"""SELECT {group}, count(*) AS n, list_reduce(list_prepend(CAST(0 AS BIGINT), list(cents ORDER BY ts, event_id)),
               lambda a, x: (a * a + x) % {PRIME}) AS digest FROM ({source}) GROUP BY ALL"""


ZERO = {"n": 0, "digest": 0}


@query("aggregate_any", squared_sql("user_id", EVENTS))
def aggregate_any(spark, folder):
    return events(spark, folder).group_by_key().fold_any(lambda: ZERO, square, "n long, digest long").df


@query("hopping_any", squared_sql("user_id, window_start, window_end", HOPPED))
def hopping_any(spark, folder):
    return events(spark, folder).windowed_by_key(hopping(DAY, SIX_HOURS)).fold_any(lambda: ZERO, square, "n long, digest long").df


@query("tumbling_any", squared_sql(f"user_id, {TUMBLING}", EVENTS))
def tumbling_any(spark, folder):
    return events(spark, folder).windowed_by_key(tumbling(DAY)).fold_any(lambda: ZERO, square, "n long, digest long").df


# -- sessions ------------------------------------------------------------------------------------

def session_sql(key: str, columns: str) -> str:
    return f"""
        WITH marked AS (
          SELECT *, {key} AS k, CASE WHEN ts <= lag(ts) OVER (PARTITION BY {key} ORDER BY ts, event_id) + INTERVAL 6 HOUR THEN 0 ELSE 1 END AS opens
          FROM ({EVENTS})),
        numbered AS (SELECT *, sum(opens) OVER (PARTITION BY k ORDER BY ts, event_id) AS session FROM marked)
        SELECT k AS {key}, min(ts) AS session_start, max(ts) AS session_end, {columns} FROM numbered GROUP BY k, session"""


@query("session_count", session_sql("user_id", "count(*) AS count"))
def session_count(spark, folder):
    return events(spark, folder).windowed_by_key(sessions(SIX_HOURS)).count().df


@query("session_mapped_count", session_sql("event_type", "count(*) AS count"))
def session_mapped_count(spark, folder):
    return events(spark, folder).windowed_by({"event_type": F.col("event_type")}, sessions(SIX_HOURS)).count().df


@query("session_reduce", session_sql("user_id", "max(cents) AS cents"))
def session_reduce(spark, folder):
    return events(spark, folder).windowed_by_key(sessions(SIX_HOURS)).aggregate(cents=M.max_(F.col("cents"))).df


@query("session_aggregate", session_sql("user_id", f"""
    {TOTAL} AS total, count(*) AS n, min(cents) AS low, arg_min(event_type, (ts, event_id)) AS opened,
    arg_max(event_type, (ts, event_id)) AS closed"""))
def session_aggregate(spark, folder):
    return events(spark, folder).windowed_by_key(sessions(SIX_HOURS)).aggregate(
        total=M.sum_(F.col("cents")), n=M.count(), low=M.min_(F.col("cents")),
        opened=M.first(F.col("event_type"), "ts", "event_id"), closed=M.last(F.col("event_type"), "ts", "event_id"),
    ).df


@query("session_fold", session_sql("user_id", f"""
    list_reduce(list_prepend(CAST(0 AS BIGINT), list(cents ORDER BY ts, event_id)), lambda a, x: (a * 31 + x) % {PRIME}) AS digest"""))
def session_fold(spark, folder):
    """A custom aggregator with its merger."""
    return events(spark, folder).windowed_by_key(sessions(SIX_HOURS)).fold(empty(), extend, append).df.drop("factor")


# -- tables --------------------------------------------------------------------------------------

SEEN = f"SELECT DISTINCT event_type AS kind FROM ({VERSIONS}) WHERE event_type IS NOT NULL"


def table_sql(columns: str) -> str:
    return f"""SELECT kind, {columns} FROM ({SEEN}) LEFT JOIN (SELECT * FROM ({LATEST})
               WHERE event_type IS NOT NULL) ON kind = event_type GROUP BY kind"""


def by_kind(spark, folder):
    return users(spark, folder).group_by({"kind": F.col("event_type")})


@query("table_count", table_sql("count(user_id) AS count"))
def table_count(spark, folder):
    return by_kind(spark, folder).count().df


def picky(state, value):
    """A step that fails on some records, and leaves them to the quarantine."""
    if value["cents"] % 97 == 0:
        raise ValueError("cents")
    return {"n": state["n"] + 1, "total": state["total"] + value["cents"]}


def larger(a, b):
    """A reduction that fails on some pairs."""
    if b["cents"] % 97 == 0:
        raise ValueError("cents")
    return a if a["cents"] >= b["cents"] else b


FOLD_ERRORS = f"""
    SELECT user_id, CAST(count(*) FILTER (cents % 97 <> 0) AS BIGINT) AS n, CAST(sum(cents) FILTER (cents % 97 <> 0) AS BIGINT) AS total,
           CAST(count(*) FILTER (cents % 97 = 0) AS BIGINT) AS failed FROM ({EVENTS}) GROUP BY user_id HAVING n > 0"""
REDUCE_ERRORS = f"""
    WITH n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1 AS opens FROM ({EVENTS}))
    SELECT user_id, max(cents) FILTER (opens OR cents % 97 <> 0) AS cents, CAST(count(*) FILTER (NOT opens AND cents % 97 = 0) AS BIGINT) AS failed
    FROM n GROUP BY user_id"""


def with_failures(table, failures):
    """Each key's result with the number of its quarantined records."""
    user = F.get_json_object("key", "$.user_id").cast("long").alias("user_id")
    counted = failures.select(user).groupBy("user_id").agg(F.count("*").alias("failed"))
    return table.join(counted, "user_id", "left").withColumn("failed", F.coalesce("failed", F.lit(0)))


@query("fold_error_quarantine", FOLD_ERRORS)
def fold_error_quarantine(spark, folder):
    folded = events(spark, folder).group_by_key().fold_any(lambda: {"n": 0, "total": 0}, picky, "n long, total long")
    return with_failures(folded.df, folded.quarantine())


def joined_counts(a, b):
    return {"n": a["n"] + b["n"], "total": a["total"] + b["total"]}


@query("aggregate_merge_any", FOLD_ERRORS)
def aggregate_merge_any(spark, folder):
    """Partial states of each task are merged; what a step fails on is counted from the quarantine."""
    made = events(spark, folder).group_by_key().aggregate_any(lambda: {"n": 0, "total": 0}, picky, joined_counts, "n long, total long")
    return with_failures(made.df, made.quarantine())


@query("hopping_merge_any", f"""
    SELECT user_id, window_start, window_end, count(*) AS n, {TOTAL} AS total FROM ({HOPPED}) GROUP BY ALL""")
def hopping_merge_any(spark, folder):
    add = lambda state, value: {"n": state["n"] + 1, "total": state["total"] + value["cents"]}
    windowed = events(spark, folder).windowed_by_key(hopping(DAY, SIX_HOURS))
    return windowed.aggregate_any(lambda: {"n": 0, "total": 0}, add, joined_counts, "n long, total long").df


@query("reduce_error_quarantine", REDUCE_ERRORS)
def reduce_error_quarantine(spark, folder):
    reduced = events(spark, folder).group_by_key().reduce_any(larger)
    return with_failures(reduced.df, reduced.quarantine()).select("user_id", "cents", "failed")


@query("table_reduce_sum", table_sql("CAST(coalesce(sum(cents), 0) AS BIGINT) AS cents"))
def table_reduce_sum(spark, folder):
    return by_kind(spark, folder).reduce(cents=F.sum("cents")).df


@query("table_aggregate", f"""
    SELECT CAST(cents // 1000 AS BIGINT) AS band, count(*) AS n, {TOTAL} AS total FROM ({LATEST})
    WHERE event_type IS NOT NULL GROUP BY band""")
def table_aggregate(spark, folder):
    """A subtractor that deletes an emptied group."""
    grouped = users(spark, folder).group_by({"band": F.floor(F.col("cents") / 1000)})
    return grouped.aggregate(drop_empty=True, n=F.count("*"), total=F.sum("cents")).df


@query("table_aggregate_fold", f"""
    SELECT kind, CAST(arg_max(n, (ts, event_id, op)) AS BIGINT) AS n, CAST(greatest(0, max(n)) AS BIGINT) AS peak,
           CAST(greatest(0, max(total)) AS BIGINT) AS peak_total
    FROM (SELECT event_type AS kind, ts, event_id, op, sum(op) OVER w AS n, sum(op * cents) OVER w AS total FROM ({CHANGES})
          WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id, op))
    GROUP BY kind""")
def table_aggregate_fold(spark, folder):
    """The most rows, and the largest total, that a group ever had: the order of changes matters."""
    zero = F.lit(0).cast("long")
    init = F.struct(*[zero.alias(n) for n in ("n", "total", "peak", "peak_total")])

    def state(n: Column, total: Column, peak: Column, peak_total: Column) -> Column:
        return F.struct(n.alias("n"), total.alias("total"), peak.alias("peak"), peak_total.alias("peak_total"))

    def step(s: Column, op: Column, value: Column) -> Column:
        n, total = s["n"] + op, s["total"] + op * value["cents"]
        return state(n, total, F.greatest(s["peak"], n), F.greatest(s["peak_total"], total))

    def merge(a: Column, b: Column) -> Column:
        return state(a["n"] + b["n"], a["total"] + b["total"], F.greatest(a["peak"], a["n"] + b["peak"]),
                     F.greatest(a["peak_total"], a["total"] + b["peak_total"]))

    return by_kind(spark, folder).fold(init, step, merge).df.drop("total")
