"""Per-key ordered computations that stay balanced when one key holds much of the data."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from relstream.functions.search import leading
from relstream.plans.skew import CHUNK, Chunks, SplitPolicy, find_chunks

# Rows that one collected block of an ordered fold may hold.
BLOCK_ROWS = 4096


@dataclass(frozen=True)
class Carried:
    """Last non-null `column` among the key's rows up to the current one (or before it)."""

    column: Column
    inclusive: bool = True


def carry_forward(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                  carried: dict[str, Carried], policy: SplitPolicy | None = None) -> DataFrame:
    """Adds each carried column to every row.

    The plain form is one shuffle by key and a running window. When a key is hot its rows are cut
    into consecutive chunks that run as separate groups, and each chunk starts from the last values
    of the chunks before it. Those start values are pre-aggregated on the map side and number at
    most one per chunk, so they are broadcast: the rows still move once.
    """
    keys, order = list(keys), list(order)
    chunks = find_chunks(df, keys, order, policy)
    group = keys if chunks is None else [*keys, CHUNK]
    source = df if chunks is None else chunks.assign(df)
    running = W.partitionBy(*group).orderBy(*order)
    upto = running.rowsBetween(W.unboundedPreceding, W.currentRow)
    before = running.rowsBetween(W.unboundedPreceding, -1)
    result = source.select("*", *[
        F.last(c.column, ignorenulls=True).over(upto if c.inclusive else before).alias(name)
        for name, c in carried.items()
    ])
    if chunks is None:
        return result
    starts = _chunk_starts(df, keys, order, carried, chunks)
    joined = result.join(F.broadcast(starts), [*keys, CHUNK], "left")
    return joined.select(*df.columns, *[F.coalesce(n, f"__start_{n}").alias(n) for n in carried])


def _chunk_starts(df: DataFrame, keys: list[str], order: list[str], carried: dict[str, Carried],
                  chunks: Chunks) -> DataFrame:
    """Per hot key and chunk: the carried values with which the chunk begins."""
    point = F.struct(*order)
    set_any = F.coalesce(*[F.when(c.column.isNotNull(), F.lit(True)) for c in carried.values()])
    summary = (
        chunks.assign_hot(df.where(set_any), last="__last_chunk")
        .groupBy(*keys, CHUNK)
        .agg(F.max("__last_chunk").alias("__last_chunk"), *[
            F.max_by(c.column, F.when(c.column.isNotNull(), point)).alias(f"__start_{name}")
            for name, c in carried.items()
        ])
    )
    along = W.partitionBy(*keys).orderBy(CHUNK)
    filled = summary.select(
        *keys,
        (F.col(CHUNK) + 1).alias("__from"),
        F.coalesce(F.lead(CHUNK).over(along), "__last_chunk").alias("__to"),
        *[F.last(f"__start_{n}", ignorenulls=True).over(along.rowsBetween(W.unboundedPreceding, 0)).alias(f"__start_{n}")
          for n in carried],
    )
    return (
        filled.where("__from <= __to")
        .withColumn(CHUNK, F.explode(F.sequence("__from", "__to")))
        .drop("__from", "__to")
    )


def last_known(rows: DataFrame, versions: DataFrame, keys: Sequence[str], times: Sequence[str],
               ties: Sequence[str], version: str, state: str, how: str) -> DataFrame:
    """Adds to each row the key's last `version` at or before its `times`; `how` is inner or left.

    Among versions of one time the last by `ties` counts.

    For versions small enough to broadcast: each key's history is one sorted array, searched per row,
    and the rows are not shuffled at all.
    """
    keys = list(keys)
    history = versions.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct(*times, *ties, version))).alias("__history")
    )
    here = F.struct(*[F.col(c) for c in times])
    seen = leading(F.col("__history"), lambda v: F.struct(*[v[c].alias(c) for c in times]) <= here)
    joined = rows.join(F.broadcast(history), keys, how)
    return joined.withColumn(state, F.get("__history", seen - 1)[version]).drop("__history")


def ordered_fold(df: DataFrame, group: Sequence[str], order: Sequence[str], row: Column, state: str,
                 start: Callable[[Column], Column], step: Callable[[Column, Column], Column],
                 merge: Callable[[Column, Column], Column], policy: SplitPolicy | None = None,
                 sizing: DataFrame | None = None) -> DataFrame:
    """Folds each group's rows in order into a column `state`; no task ever holds a whole group.

    `start(first_row)` begins a run, `step(state, row)` extends it, `merge(earlier, later)` joins the
    states of two consecutive runs and must be associative. A hot group is cut into chunks that fold
    on their own; only their states, at most one per chunk, meet again. Hot groups are looked for in
    `sizing`, a cheaper frame whose groups are about as large as those of `df`, where one is given.
    """
    group, order = list(group), list(order)
    chunks = find_chunks(df if sizing is None else sizing, group, order, policy)
    rows = df.select(*group, *order, row.alias("__row"))
    if chunks is None:
        return fold_groups(rows, group, order, F.col("__row"), state, start, step, merge)
    parts = fold_groups(chunks.assign(rows), [*group, CHUNK], order, F.col("__row"), "__state", start, step, merge)
    return merge_runs(parts, group, CHUNK, state, merge)


def fold_groups(df: DataFrame, group: Sequence[str], order: Sequence[str], row: Column, state: str,
                start: Callable, step: Callable, merge: Callable) -> DataFrame:
    """`ordered_fold` for groups that one task can stream through.

    Rows are numbered and collected in blocks of `BLOCK_ROWS`, block states are merged in blocks
    again, so memory stays bounded. All steps share the partitioning of the one shuffle by group.
    """
    group, order = list(group), list(order)
    number = F.row_number().over(W.partitionBy(*group).orderBy(*order)) - 1
    blocks = (
        df.select(*group, *order, row.alias("__row"))
        .withColumn("__block", F.floor(number / BLOCK_ROWS))
        .groupBy(*group, "__block")
        .agg(F.array_sort(F.collect_list(F.struct(*order, "__row"))).alias("__sorted"))
        .select(*group, "__block", F.transform("__sorted", lambda r: r["__row"]).alias("__rows"))
        .select(*group, "__block", _fold("__rows", start, step).alias("__state"))
    )
    wider = blocks.withColumn("__outer", F.floor(F.col("__block") / BLOCK_ROWS))
    return merge_runs(merge_runs(wider, [*group, "__outer"], "__block", "__state", merge),
                       group, "__outer", state, merge)


def merge_runs(runs: DataFrame, group: list[str], position: str, state: str, merge: Callable) -> DataFrame:
    """Merges the `__state` of each group's runs in the order of `position`."""
    collected = runs.groupBy(*group).agg(
        F.array_sort(F.collect_list(F.struct(position, "__state"))).alias("__sorted")
    )
    states = F.transform("__sorted", lambda s: s["__state"])
    merged = F.aggregate(F.slice(states, 2, F.size(states)), F.element_at(states, 1), merge)
    return collected.select(*group, merged.alias(state))


def _fold(rows: str, start: Callable, step: Callable) -> Column:
    rest = F.slice(F.col(rows), 2, F.size(rows))
    return F.aggregate(rest, start(F.element_at(rows, 1)), step)

