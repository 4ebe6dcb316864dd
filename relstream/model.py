"""The data model: record streams, upsert tables, lookup tables, topics.

All of them are thin immutable descriptions of a DataFrame; every operator returns a new one and
nothing runs until an action or a sink.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relstream.functions.predicates import all_null, all_of, all_present
from relstream.operators.flow import FlowOps
from relstream.operators.grouping import StreamGroupOps, TableGroupOps
from relstream.operators.joins import StreamJoinOps
from relstream.operators.parts import PartOps
from relstream.operators.stateless import StreamMapOps
from relstream.operators.table_joins import TableJoinOps
from relstream.operators.tables import TableOps
from relstream.sources.sinks import StreamSinkOps, TableSinkOps
from relstream.sources.topics import JSON_TIMES


@dataclass(frozen=True)
class _Keyed:
    """Key columns, value columns, and the columns that order rows of one key.

    `ts` is the event time (optional), `seq` the tiebreak. A record has no value when all value
    columns are null, and no key when any key column is.
    """

    df: DataFrame
    key: tuple[str, ...]
    value: tuple[str, ...]
    ts: str | None = "ts"
    seq: tuple[str, ...] = ("seq",)
    rejects: tuple[DataFrame, ...] = field(default=(), compare=False)

    def __post_init__(self):
        for name in ("key", "value", "seq"):
            given = getattr(self, name)
            object.__setattr__(self, name, (given,) if isinstance(given, str) else tuple(given))
        if len(set(self.columns)) != len(self.columns):
            raise ValueError(f"a column has more than one role: {self.columns}")

    @property
    def order(self) -> tuple[str, ...]:
        return self.seq if self.ts is None else (self.ts, *self.seq)

    @property
    def columns(self) -> tuple[str, ...]:
        return (*self.key, *self.value, *self.order)

    @property
    def has_key(self) -> Column:
        return all_present(self.key)

    @property
    def has_value(self) -> Column:
        return ~all_null(self.value)

    @property
    def spark(self):
        return self.df.sparkSession

    def rows(self) -> DataFrame:
        """Key, value and order columns only, so that scans read nothing else."""
        return self.df.select(*self.columns)

    def value_struct(self) -> Column:
        """The value as one struct, NULL where the record has none."""
        return F.when(self.has_value, F.struct(*self.value))

    def with_(self, **changes):
        return replace(self, **changes)

    def all_rejects(self, *others) -> tuple[DataFrame, ...]:
        """The quarantine of this flow and of others, what they share only once: flows of one source share its failures."""
        found = list(self.rejects)
        for other in others:
            found += [r for r in other.rejects if not any(r is known for known in found)]
        return tuple(found)

    def quarantine(self) -> DataFrame:
        """Records given up by this flow so far: `operator, key, value, error, ts, seq`."""
        if not self.rejects:
            raise ValueError("no operator of this flow can reject a record")
        first, *others = self.rejects
        for other in others:
            first = first.unionByName(other)
        return first

    def reject(self, operator: str, rows: DataFrame, error: Column | str) -> DataFrame:
        """Quarantine rows for `rows`, which has this object's columns."""
        text = F.lit(error) if isinstance(error, str) else error
        return rows.select(
            F.lit(operator).alias("operator"),
            F.to_json(F.struct(*self.key), JSON_TIMES).alias("key"),
            F.to_json(F.struct(*self.value), JSON_TIMES).alias("value"),
            text.alias("error"),
            (F.col(self.ts) if self.ts else F.lit(None).cast("timestamp")).cast("timestamp").alias("ts"),
            F.to_json(F.struct(*self.seq), JSON_TIMES).alias("seq"),
        )


@dataclass(frozen=True)
class RecordStream(StreamMapOps, FlowOps, PartOps, StreamJoinOps, StreamGroupOps, StreamSinkOps, _Keyed):
    """An append-only stream of independent records, batch or streaming."""


@dataclass(frozen=True)
class UpsertTable(TableOps, TableJoinOps, TableGroupOps, TableSinkOps, _Keyed):
    """A table as the log of its versions: the latest row of a key counts, a null value deletes it.

    `is_snapshot` says that `df` already has one live row per key.
    """

    is_snapshot: bool = False

    def rows(self) -> DataFrame:
        """As for streams, but rows without a key are no rows of a table."""
        return super().rows().where(self.has_key)

    @staticmethod
    def of(stream: RecordStream, deleted: Column | None = None, on_null: str = "delete") -> UpsertTable:
        """Reads a stream as a table. Records without a key are ignored.

        `deleted` marks further rows as deletes; `on_null` says whether a null value deletes the key
        (`"delete"`) or is skipped (`"ignore"`).
        """
        if on_null not in ("delete", "ignore"):
            raise ValueError("on_null is 'delete' or 'ignore'")
        rows = stream.rows()
        if deleted is not None:
            kept = F.coalesce(~deleted, F.lit(True))
            # One projection: `deleted` may read a value column that it also clears.
            rows = rows.select(*stream.key, *[F.when(kept, F.col(v)).alias(v) for v in stream.value], *stream.order)
        if on_null == "ignore":
            rows = rows.where(~all_null(stream.value))
        return UpsertTable(rows, stream.key, stream.value, stream.ts, stream.seq, stream.rejects)


@dataclass(frozen=True)
class LookupTable:
    """A static table with one row per key, joinable only from the right of a stream."""

    df: DataFrame
    key: tuple[str, ...]
    value: tuple[str, ...]

    def __post_init__(self):
        for name in ("key", "value"):
            given = getattr(self, name)
            object.__setattr__(self, name, (given,) if isinstance(given, str) else tuple(given))

    @staticmethod
    def of(table: UpsertTable) -> LookupTable:
        return LookupTable(table.latest(), table.key, table.value)

    def rows(self) -> DataFrame:
        return self.df.select(*self.key, *self.value).where(all_of(F.col(k).isNotNull() for k in self.key))
