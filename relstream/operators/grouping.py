"""Grouped streams and tables, and their aggregates."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relstream.functions.mergeable import Mergeable, count
from relstream.functions.predicates import all_of
from relstream.functions.times import complete, interval_text
from relstream.operators.sessions import END, START, aggregate_sessions, fold_sessions
from relstream.operators.tables import OP
from relstream.operators.windows import WINDOW, SessionWindows, TimeWindows, UnlimitedWindows
from relstream.plans.ordered import merge_runs, ordered_fold
from relstream.plans.sequential import ERROR, FAILED, partial_fold, sequential_fold
from relstream.sources.topics import JSON_TIMES


def _keep_old(step: Callable) -> Callable:
    """A failed (null) step leaves the state as it was."""
    return lambda state, row: F.coalesce(step(state, row), state)


def _either(merge: Callable) -> Callable:
    """A failed (null) merge yields the first state there is."""
    return lambda a, b: F.coalesce(merge(a, b), a, b)


class StreamGroupOps:

    def group_by_key(self) -> GroupedRecords:
        return GroupedRecords(self)

    def group_by(self, key: dict[str, Column], valid: Column | None = None) -> GroupedRecords:
        """Groups by computed columns; a record that yields no key is ignored and quarantined."""
        return self.map_keys(key, valid).group_by_key()

    def windowed_by_key(self, windows: TimeWindows | UnlimitedWindows | SessionWindows):
        kind = GroupedSessions if isinstance(windows, SessionWindows) else GroupedRecords
        return kind(self, windows)

    def windowed_by(self, key: dict[str, Column], windows, valid: Column | None = None):
        """As `windowed_by_key`, by computed columns; a record that yields no key is quarantined."""
        if self.df.isStreaming and windows.retention is not None:
            # Records that the mapper drops advance the watermark too.
            marked = self.rows().withWatermark(self.ts, interval_text(windows.retention))
            return self.with_(df=marked).windowed_by(key, replace(windows, retention=None), valid)
        return self.map_keys(key, valid).windowed_by_key(windows)


@dataclass(frozen=True)
class _Grouped:
    stream: object
    windows: object = None

    def _rows(self) -> DataFrame:
        """Records with a key and a value; on a stream, with the watermark of the retention."""
        return complete(self.stream, self.windows and self.windows.retention)

    def _table(self, df: DataFrame, extra_key: tuple[str, ...]):
        from relstream.model import UpsertTable
        key = (*self.stream.key, *extra_key)
        value = tuple(c for c in df.columns if c not in key)
        return UpsertTable(df, key, value, None, (), self.stream.rejects, is_snapshot=True)


@dataclass(frozen=True)
class GroupedRecords(_Grouped):
    """Records grouped by key, or by key and time window.

    Results are tables keyed by the group; windows add `window_start` and `window_end` to the key.
    """

    def count(self, name: str = "count"):
        return self.aggregate(**{name: count()})

    def aggregate(self, **aggs: Column | Mergeable):
        """Built-in aggregates, combined on the map side before the shuffle.

        Overlapping windows of a batch are put together from panes if all aggregates are `Mergeable`:
        records are aggregated once per pane, and only the panes are repeated per window.
        """
        columns = [_as_column(a).alias(n) for n, a in aggs.items()]
        rows = self._rows()
        keys = list(self.stream.key)
        if self.windows is None:
            return self._table(rows.groupBy(*keys).agg(*columns), ())
        if self._in_panes and all(isinstance(a, Mergeable) for a in aggs.values()):
            return self._flat(_from_panes(self.windows, rows, keys, self.stream.ts, aggs))
        windowed = self.windows.assign(rows, self.stream.ts)
        return self._flat(windowed.groupBy(*keys, WINDOW).agg(*columns))

    def reduce(self, combine: Callable[[Column, Column], Column]):
        """Combines value structs in order with `combine(earlier, later)`, which must be associative.

        `combine` returns a struct of the value columns; where it is null the earlier one is kept.
        Prefer `aggregate` when a built-in says the same.
        """
        return self._fold(lambda row: row, _keep_old(combine), _either(combine))

    def fold(self, init: Column, step: Callable[[Column, Column], Column],
             merge: Callable[[Column, Column], Column]):
        """Ordered fold `step(state, value)` from `init`; the state is a struct, its fields the result.

        `merge(earlier, later)` joins the states of two consecutive runs of records, which is what
        lets one group be folded by many tasks. For steps that cannot be merged see
        `streaming.keyed.fold`.
        """
        return self._fold(lambda row: _keep_old(step)(init, row), _keep_old(step), _either(merge))

    def _fold(self, start: Callable, step: Callable, merge: Callable):
        rows = self._rows()
        if rows.isStreaming:
            raise ValueError("an ordered fold over a stream is streaming.keyed.fold")
        group = list(self.stream.key)
        windows = self.windows.panes() if self._in_panes else self.windows
        if windows is not None:
            rows = windows.assign(rows, self.stream.ts)
            group.append(WINDOW)
        folded = ordered_fold(rows, group, self.stream.order, F.struct(*self.stream.value), "__state", start, step, merge)
        if self._in_panes:
            # A window's state is that of its panes, merged in their order.
            panes = self.windows.over(folded.withColumnRenamed(WINDOW, "__pane"), "__pane")
            folded = merge_runs(panes, group, "__pane", "__state", merge)
        folded = folded.select(*group, "__state.*")
        return self._table(folded, ()) if self.windows is None else self._flat(folded)

    @property
    def _in_panes(self) -> bool:
        return isinstance(self.windows, TimeWindows) and self.windows.overlap and not self.stream.df.isStreaming

    def fold_any(self, init: Callable[[], dict], step: Callable[[dict, dict], dict | None],
                 state_schema: T.StructType | str):
        """Ordered fold with a Python `step(state, value)` that no `merge` can split (batch).

        The records are sorted within their partition and one state is carried along, so no group is
        held; a key's records are one task's work, as such a step allows no other way. A step that
        raises leaves the state alone and the record goes to the quarantine; None deletes the group, which
        starts from `init()` again.
        """
        return self._sequential("fold_any", init, step, state_schema)

    def reduce_any(self, combine: Callable[[dict, dict], dict | None]):
        """`fold_any` over values of the stream's own columns: a group starts with its first value (batch)."""
        schema = T.StructType([self.stream.df.schema[v] for v in self.stream.value])
        return self._sequential("reduce_any", None, combine, schema)

    def aggregate_any(self, init: Callable[[], dict], step: Callable[[dict, dict], dict | None],
                      merge: Callable[[dict, dict], dict | None], state_schema: T.StructType | str):
        """Python aggregate that does not depend on order: `step(state, value)` makes partial states before the shuffle,
        `merge(state, state)` joins them (batch).

        One row per group and task is shuffled, so a key in a third of all records is no large group. A step or a merge that
        raises leaves the state alone; its record, or the state that could not be merged, goes to the quarantine. None deletes
        the group's state for now.
        """
        fold = lambda rows, group: partial_fold(rows, group, self.stream.order, self.stream.value, init, step, merge, state_schema)
        return self._folded("aggregate_any", fold, "on a stream this is streaming.keyed.fold")

    def _sequential(self, operator: str, init: Callable | None, step: Callable, state_schema: T.StructType | str):
        fold = lambda rows, group: sequential_fold(rows, group, self.stream.order, self.stream.value, init, step, state_schema)
        return self._folded(operator, fold, "on a stream this is streaming.keyed.fold, streaming.running.fold or reduce_records")

    def _folded(self, operator: str, fold: Callable[[DataFrame, list[str]], DataFrame], instead: str):
        rows = self._rows()
        if rows.isStreaming:
            raise ValueError(instead)
        group = list(self.stream.key)
        if self.windows is not None:
            rows = self.windows.assign(rows, self.stream.ts)
            group.append(WINDOW)
        tagged = fold(rows, group)
        folded = tagged.where(F.col(ERROR).isNull()).drop(ERROR, FAILED)
        table = self._table(folded, ()) if self.windows is None else self._flat(folded)
        return table.with_(rejects=(*table.rejects, self._refused(operator, tagged.where(F.col(ERROR).isNotNull()))))

    def _refused(self, operator: str, tagged: DataFrame) -> DataFrame:
        """Quarantine rows of a fold, from what it gave out beside its states."""
        at = F.col(FAILED)[self.stream.ts].cast("timestamp") if self.stream.ts else F.lit(None).cast("timestamp")
        return tagged.select(
            F.lit(operator).alias("operator"), F.to_json(F.struct(*self.stream.key), JSON_TIMES).alias("key"), F.col(FAILED)["value"].alias("value"),
            F.col(ERROR).alias("error"), at.alias("ts"), F.to_json(F.struct(*[F.col(FAILED)[s].alias(s) for s in self.stream.seq]), JSON_TIMES).alias("seq"))

    def _flat(self, df: DataFrame):
        rest = [c for c in df.columns if c not in (*self.stream.key, WINDOW)]
        bounds = [F.col(f"{WINDOW}.start").alias("window_start"), F.col(f"{WINDOW}.end").alias("window_end")]
        return self._table(df.select(*self.stream.key, *bounds, *rest), ("window_start", "window_end"))


@dataclass(frozen=True)
class GroupedSessions(_Grouped):
    """Records grouped by key and session; `session_start` and `session_end` join the key.

    `session_end` is the time of the session's last record.
    """

    def count(self, name: str = "count"):
        return self.aggregate(**{name: count()})

    def aggregate(self, **aggs: Mergeable):
        """Mergeable aggregates, see `functions.mergeable`: sessions of hot keys are built in parts."""
        result = aggregate_sessions(self._rows(), list(self.stream.key), list(self.stream.order), self.stream.ts,
                                    self.windows, aggs)
        return self._table(result, (START, END))

    def reduce(self, combine: Callable[[Column, Column], Column]):
        return self._fold(lambda row: row, _keep_old(combine), _either(combine))

    def fold(self, init: Column, step: Callable[[Column, Column], Column],
             merge: Callable[[Column, Column], Column]):
        """Ordered fold inside each session; `merge` joins parts that turn out to be one session."""
        return self._fold(lambda row: _keep_old(step)(init, row), _keep_old(step), _either(merge))

    def _fold(self, start: Callable, step: Callable, merge: Callable):
        rows = self._rows()
        if rows.isStreaming:
            raise ValueError("on a stream use aggregate, or streaming.keyed.fold")
        folded = fold_sessions(rows, list(self.stream.key), list(self.stream.order), self.stream.ts, self.windows,
                               F.struct(*self.stream.value), "__state", start, step, merge)
        return self._table(folded.select(*self.stream.key, START, END, "__state.*"), (START, END))


def _from_panes(windows: TimeWindows, rows: DataFrame, keys: list[str], ts: str, aggs: dict[str, Mergeable]) -> DataFrame:
    name = lambda n, part: f"__{n}_{part}"
    panes = windows.panes().assign(rows, ts).groupBy(*keys, WINDOW).agg(
        *[column.alias(name(n, part)) for n, agg in aggs.items() for part, column in agg.partial.items()])
    spread = windows.over(panes.withColumnRenamed(WINDOW, "__pane"), "__pane")
    merged = spread.groupBy(*keys, WINDOW).agg(*[
        column.alias(name(n, part)) for n, agg in aggs.items()
        for part, column in agg.merge(lambda p, n=n: F.col(name(n, p))).items()])
    return merged.select(*keys, WINDOW, *[agg.finish(lambda p, n=n: F.col(name(n, p))).alias(n) for n, agg in aggs.items()])


def _as_column(agg: Column | Mergeable) -> Column:
    """A Mergeable as one plain aggregate column: its finish over its partial aggregates."""
    if isinstance(agg, Mergeable):
        return agg.finish(lambda part: agg.partial[part])
    return agg


def _starts_at_zero(agg: Column) -> bool:
    """Whether the aggregate of no rows is 0: a count or a sum."""
    return re.match(r"Column<'(count|count_if|sum|try_sum|approx_count_distinct)\(", str(agg), re.I) is not None


class TableGroupOps:

    def group_by(self, key: dict[str, Column], valid: Column | None = None) -> GroupedTable:
        """Groups the rows by computed columns; rows that yield no key are ignored and quarantined."""
        valid = all_of(c.isNotNull() for c in key.values()) if valid is None else F.coalesce(valid, F.lit(False))
        failed = self.rows().where(self.has_value & ~valid)
        table = self.with_(rejects=(*self.rejects, self.reject("group_by", failed, "no group key")))
        return GroupedTable(table, key, valid)

    def group_by_key(self) -> GroupedTable:
        return GroupedTable(self, {k: F.col(k) for k in self.key}, F.lit(True))


@dataclass(frozen=True)
class GroupedTable:
    """Table rows under a group key. An update moves a row: out of its old group, into its new one."""

    table: object
    key: dict[str, Column]
    valid: Column

    def _grouped(self, rows: DataFrame) -> DataFrame:
        """Adds the group key as `__g0…`, apart from the row's own columns."""
        keyed = rows.where(self.valid & all_of(c.isNotNull() for c in self.key.values()))
        return keyed.select("*", *[c.alias(f"__g{i}") for i, c in enumerate(self.key.values())])

    @property
    def _names(self) -> list[str]:
        return [f"__g{i}" for i in range(len(self.key))]

    def changes(self) -> DataFrame:
        """Change rows under their group key `__g…`: -1 in the group left, +1 in the group entered."""
        return self._grouped(self.table.changes())

    def count(self, name: str = "count"):
        """Live rows per group; a group that has emptied stays with 0."""
        return self.totals(name)

    def totals(self, count: str = "count", **sums: Column):
        """Live rows and sums over them per group, also on a stream: each change takes back what it replaces.

        On a stream the result is in update mode, one row per group that changed. Sums over no values are 0.
        """
        if not self.table.df.isStreaming:
            plain = {n: F.coalesce(F.sum(c), F.lit(0)) for n, c in sums.items()}
            zero = {n: F.lit(0) for n in sums}
            return self.aggregate(zero, **{count: F.count(F.lit(1))}, **plain)
        changes = self.changes()
        found = changes.groupBy(*self._names).agg(
            F.sum(OP).alias(count), *[F.coalesce(F.sum(F.col(OP) * c), F.lit(0)).alias(n) for n, c in sums.items()])
        return self._snapshot(found)

    def aggregate(self, empty: dict[str, Column] | None = None, drop_empty: bool = False, **aggs: Column):
        """Aggregates of the live rows per group.

        Rows without a group key are in no group. For an aggregate whose subtractor undoes its adder, retracting each replaced row gives the
        aggregate over the rows alive now, so no change rows are built: one pre-aggregated pass finds
        the live rows and another the groups ever seen. In a group that has emptied counts and sums
        are 0 and other aggregates null, or the column given in `empty`; `drop_empty` removes it
        instead. A group with live rows keeps its aggregates as they are, null ones too.
        """
        self._batch_only("aggregate", "totals, or running.aggregate with an adder and a subtractor")
        names = self._names
        live = self._grouped(self.table.latest()).groupBy(*names).agg(*[c.alias(n) for n, c in aggs.items()])
        if not drop_empty:
            seen = self._grouped(self.table.rows().where(self.table.has_value)).select(*names).distinct()
            spare = {n: F.lit(0) for n, c in aggs.items() if _starts_at_zero(c)} | (empty or {})
            found = seen.join(live.withColumn("__live", F.lit(True)), names, "left")
            live = found.select(*names, *[
                F.when(F.col("__live"), F.col(n)).otherwise(spare.get(n, F.lit(None))).alias(n) for n in aggs
            ])
        return self._snapshot(live)

    def reduce(self, empty: dict[str, Column] | None = None, **aggs: Column):
        """`aggregate` under the name of the value columns it reduces."""
        return self.aggregate(empty, False, **aggs)

    def fold(self, init: Column, step: Callable[[Column, Column, Column], Column],
             merge: Callable[[Column, Column], Column], deleted: Callable[[Column], Column] | None = None):
        """Ordered fold over the change rows: `step(state, op, value)` with `op` -1 or +1.

        Retractions come before additions at one time. Where `step` gives null the group is deleted,
        and its next change starts from `init` again. `merge(earlier, later)` joins the states of
        consecutive runs, each from `init`; a failed (null) merge keeps the earlier. A group that is
        deleted, or whose final state satisfies `deleted`, is absent.
        """
        self._batch_only("fold", "running.aggregate")
        value = F.struct(F.col(OP).alias("op"), F.struct(*self.table.value).alias("value"))

        # A run's state with a mark whether the group was deleted in it: what came before such a run does not matter.
        def taken(since, state, row):
            after = step(F.coalesce(state, init), row["op"], row["value"])
            return F.struct((since | after.isNull()).alias("anew"), after.alias("state"))

        def start(row):
            return taken(F.lit(False), F.lit(None).cast(kind), row)

        def take(run, row):
            return taken(run["anew"], run["state"], row)

        def joined(a, b):
            both = F.coalesce(merge(a["state"], b["state"]), a["state"], b["state"])
            state = F.when(b["anew"] | a["state"].isNull(), b["state"]).otherwise(both)
            return F.struct((a["anew"] | b["anew"]).alias("anew"), state.alias("state"))

        kind = self.table.spark.range(0).select(init.alias("s")).schema["s"].dataType
        # Every version adds one change to its group and later takes one back, so the versions show
        # how large the groups are without building the changes.
        versions = self._grouped(self.table.rows().where(self.table.has_value)).withColumn(OP, F.lit(1))
        folded = ordered_fold(
            self.changes(), self._names, (*self.table.order, OP), value, "__run", start, take, joined, sizing=versions,
        ).select(*self._names, F.col("__run.state").alias("__state")).where(F.col("__state").isNotNull())
        if deleted is not None:
            folded = folded.where(~F.coalesce(deleted(F.col("__state")), F.lit(False)))
        return self._snapshot(folded.select(*self._names, "__state.*"))

    def _batch_only(self, operator: str, instead: str) -> None:
        if self.table.df.isStreaming:
            raise ValueError(f"{operator} on a running table cannot take rows back: use {instead} (relstream.streaming)")

    def _snapshot(self, df: DataFrame):
        from relstream.model import UpsertTable
        named = df.withColumnsRenamed(dict(zip(self._names, self.key)))
        value = tuple(c for c in named.columns if c not in self.key)
        return UpsertTable(named, tuple(self.key), value, None, (), self.table.rejects, is_snapshot=True)
