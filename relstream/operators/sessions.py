"""Session aggregation that splits the sessions of hot keys by time and joins them again.

Grouping by `session_window` sends all rows of a key to one task. When a key is hot its rows are cut
into consecutive chunks, sessions are built per chunk, and only the first and the last session of
each chunk can continue in a neighbouring chunk: those alone meet again per key.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from relstream.functions.mergeable import Mergeable
from relstream.operators.windows import WINDOW, SessionWindows
from relstream.plans.ordered import fold_groups
from relstream.plans.skew import CHUNK, find_chunks

START, END = "session_start", "session_end"


def _state(name: str, part: str) -> str:
    return f"__{name}__{part}"


def aggregate_sessions(df: DataFrame, keys: list[str], order: list[str], ts: str, spec: SessionWindows,
                       aggs: dict[str, Mergeable]) -> DataFrame:
    """One row per key and session: key, session_start, session_end (its last record), aggregates."""
    partial = [c.alias(_state(n, p)) for n, m in aggs.items() for p, c in m.partial.items()]
    chunks = find_chunks(df, keys, order)
    group = keys if chunks is None else [*keys, CHUNK]
    source = df if chunks is None else chunks.assign(df)
    found = (
        source.groupBy(*group, spec.of(ts).alias(WINDOW)).agg(*partial)
        .withColumns({START: F.col(f"{WINDOW}.start"), END: F.col(f"{WINDOW}.end") - F.lit(spec.gap)})
        .drop(WINDOW)
    )
    if chunks is not None:
        merged = [
            c.alias(_state(n, p)) for n, m in aggs.items()
            for p, c in m.merge(lambda part, n=n: F.col(_state(n, part))).items()
        ]
        found = _merge_edges(found, keys, spec.gap, merged)
    return found.select(*keys, START, END, *[
        m.finish(lambda part, n=n: F.col(_state(n, part))).alias(n) for n, m in aggs.items()
    ])


def fold_sessions(df: DataFrame, keys: list[str], order: list[str], ts: str, spec: SessionWindows, row: Column,
                  state: str, start: Callable, step: Callable, merge: Callable) -> DataFrame:
    """As `aggregate_sessions`, with an ordered fold; `merge` joins the states of adjoining parts."""
    chunks = find_chunks(df, keys, order)
    group = keys if chunks is None else [*keys, CHUNK]
    source = df.withColumn("__row", row)
    source = source if chunks is None else chunks.assign(source)
    along = W.partitionBy(*group).orderBy(*order)
    previous = F.lag(ts).over(along)
    opens = previous.isNull() | (F.col(ts) > previous + F.lit(spec.gap))
    marked = source.withColumn("__opens", opens.cast("long"))
    marked = marked.withColumn("__session", F.sum("__opens").over(along))
    spanned = F.struct(F.col(ts).alias("first"), F.col(ts).alias("last"), F.col("__row").alias("row"))

    def joined(first: Column, last: Column, value: Column) -> Column:
        return F.struct(first.alias("first"), last.alias("last"), value.alias("state"))

    found = fold_groups(
        marked, [*group, "__session"], order, spanned, "__span",
        lambda r: joined(r["first"], r["last"], start(r["row"])),
        lambda s, r: joined(s["first"], r["last"], step(s["state"], r["row"])),
        lambda a, b: joined(a["first"], b["last"], merge(a["state"], b["state"])),
    ).select(*group, F.col("__span.first").alias(START), F.col("__span.last").alias(END), F.col("__span.state").alias(state))
    if chunks is None:
        return found.select(*keys, START, END, state)
    parts = F.array_sort(F.collect_list(F.struct(START, state))).alias("__parts")
    states = F.transform("__parts", lambda p: p[state])
    return (
        _merge_edges(found, keys, spec.gap, [parts])
        .withColumn(state, F.aggregate(F.slice(states, 2, F.size(states)), F.element_at(states, 1), merge))
        .select(*keys, START, END, state)
    )


def _merge_edges(found: DataFrame, keys: list[str], gap: timedelta, merged: list[Column]) -> DataFrame:
    """Joins sessions that meet across chunk boundaries.

    The sessions inside a chunk keep the chunk as their lane and are final. Lane -1 holds at most two
    sessions per chunk of a key, so no lane outgrows a chunk.
    """
    within = W.partitionBy(*keys, CHUNK).orderBy(START)
    edge = (F.row_number().over(within) == 1) | F.lead(START).over(within).isNull()
    laned = found.withColumn("__lane", F.when(edge, F.lit(-1)).otherwise(F.col(CHUNK)))
    along = W.partitionBy(*keys, "__lane").orderBy(START)
    reach = F.max(END).over(along.rowsBetween(W.unboundedPreceding, -1))
    opens = F.coalesce(F.col(START) > reach + F.lit(gap), F.lit(True))
    return (
        laned.withColumn("__opens", opens.cast("long"))
        .withColumn("__group", F.sum("__opens").over(along))
        .groupBy(*keys, "__lane", "__group")
        .agg(F.min(START).alias("__first"), F.max(END).alias("__last"), *merged)
        .withColumnsRenamed({"__first": START, "__last": END})
    )
