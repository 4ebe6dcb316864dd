"""Upsert tables: current state, change rows, filters and maps.

A table is its log. Row-wise operators rewrite the log and keep it a log; re-keying needs to know
what a version replaced, so it goes through the change rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relstream.functions.predicates import all_of, strict
from relstream.plans.ordered import Carried, carry_forward

OP = "op"


def _orderable(kind: T.DataType) -> bool:
    """Whether values of the type can be compared: anything without a map or a variant in it."""
    if isinstance(kind, T.StructType):
        return all(_orderable(f.dataType) for f in kind)
    if isinstance(kind, T.ArrayType):
        return _orderable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


class TableOps:

    # -- state and changes -----------------------------------------------------------------------

    def latest_versions(self) -> DataFrame:
        """The last version of every key, deletes included.

        The maximum is pre-aggregated before the shuffle, so a key with many versions is no burden.
        """
        if self.is_snapshot:
            return self.rows()
        rows = self.rows()
        if _orderable(rows.select(*self.value).schema):
            # The order columns lead the struct; values are compared only between versions that tie.
            last = F.max(F.struct(*self.order, *self.value))
        else:  # maps have no order: their text decides between versions that tie
            last = F.max_by(F.struct(*self.value, *self.order), F.struct(*self.order, F.to_json(F.struct(*self.value))))
        return rows.groupBy(*self.key).agg(last.alias("__last")).select(
            *self.key, *[F.col("__last")[c].alias(c) for c in (*self.value, *self.order)]
        )

    def latest(self) -> DataFrame:
        """The live rows: one per key that is not deleted."""
        return self.latest_versions().where(self.has_value)

    def snapshot(self):
        """This table reduced to its live rows."""
        return self.with_(df=self.latest(), is_snapshot=True)

    def snapshot_as(self, name: str) -> DataFrame:
        """Makes the live rows queryable in SQL as the temporary view `name`."""
        current = self.latest()
        current.createOrReplaceTempView(name)
        return current

    def changes(self) -> DataFrame:
        """Every version as change rows: `op = -1` takes the replaced value back, `+1` adds the new.

        Per key the values of `op` add up to 1 while the key lives and to 0 once it is deleted.
        """
        if self.df.isStreaming:
            from relstream.streaming import keyed
            return keyed.changes(self)
        if self.is_snapshot:
            return self.rows().where(self.has_value).withColumn(OP, F.lit(1))
        new, old = F.struct(*self.value), F.col("__old")
        rows = carry_forward(
            self.rows(), self.key, self.order,
            {"__old": Carried(F.struct(self.value_struct().alias("v")), inclusive=False)},
        )
        pair = F.array(
            F.when(old["v"].isNotNull(), F.struct(F.lit(-1).alias(OP), old["v"].alias("v"))),
            F.when(self.has_value, F.struct(F.lit(1).alias(OP), new.alias("v"))),
        )
        return (
            rows.select(*self.key, F.explode(pair).alias("__change"), *self.order)
            .where(F.col("__change").isNotNull())
            .select(*self.key, f"__change.{OP}", "__change.v.*", *self.order)
        )

    def to_stream(self):
        """The log as plain records: every version, deletes as records without a value."""
        from relstream.model import RecordStream
        return RecordStream(self.rows(), self.key, self.value, self.ts, self.seq, self.rejects)

    def foreach(self, action: Callable[[dict], None], quarantine_path: str | None = None):
        """Calls `action` with each version, deletes included; see the stream operator."""
        return self.to_stream().foreach(action, quarantine_path)

    # -- filters ---------------------------------------------------------------------------------

    def filter(self, condition: Column, requires: Iterable[str] = ()):
        """Rejected rows, and those whose condition failed, become deletes; the failed ones are quarantined as well."""
        return self._keep("filter", strict(condition, requires))

    def filter_not(self, condition: Column, requires: Iterable[str] = ()):
        return self._keep("filter_not", ~strict(condition, requires))

    def filter_keys(self, condition: Column, requires: Iterable[str] = ()):
        self.df.select(*self.key).select(condition)
        return self.filter(condition, requires)

    def filter_values(self, condition: Column, requires: Iterable[str] = ()):
        self.df.select(*self.value).select(condition)
        return self.filter(condition, requires)

    def _keep(self, operator: str, condition: Column):
        kept = F.coalesce(condition, F.lit(False))
        values = [F.when(kept, F.col(v)).alias(v) for v in self.value]
        failed = self.reject(operator, self.rows().where(self.has_value & condition.isNull()), f"{operator} failed")
        return self.with_(df=self.rows().select(*self.key, *values, *self.order), rejects=(*self.rejects, failed))

    # -- maps ------------------------------------------------------------------------------------

    def map_values(self, value: dict[str, Column], valid: Column | None = None,
                   fallback: dict[str, Column] | None = None):
        """New value columns; deletes stay deletes and a failed result becomes one."""
        valid = F.lit(True) if valid is None else F.coalesce(valid, F.lit(False))
        live = self.has_value
        spare = fallback or {}
        columns = [
            F.when(live & valid, c).when(live, spare.get(n, F.lit(None))).alias(n) for n, c in value.items()
        ]
        failed = self.rows().where(live & ~valid)
        rejects = self.rejects if fallback else (*self.rejects, self.reject("map_values", failed, "map_values failed"))
        df = self.rows().select(*self.key, *columns, *self.order)
        return self.with_(df=df, value=tuple(value), rejects=rejects)

    def map_keys(self, key: dict[str, Column], valid: Column | None = None):
        """Re-keys the table; see `map`."""
        return self._rekeyed("map_keys", key, None, valid)

    def map(self, key: dict[str, Column], value: dict[str, Column], valid: Column | None = None):
        """New key and value. When rows collide on a new key the last change of any of them wins.

        A change takes back the old row before it adds the new one, so a taken-back row deletes the
        new key even if another row had written it. Rows without a new key are quarantined.
        """
        return self._rekeyed("map", key, value, valid)

    def _rekeyed(self, operator: str, key: dict[str, Column], value: dict[str, Column] | None,
                 valid: Column | None):
        if valid is None:
            valid = all_of(c.isNotNull() for c in key.values())
        valid = F.coalesce(valid, F.lit(False))
        changes = self.changes()
        values = value or {v: F.col(v) for v in self.value}
        added = F.col(OP) == 1
        log = changes.where(valid).select(
            *[c.alias(n) for n, c in key.items()],
            *[F.when(added, c).alias(n) for n, c in values.items()],
            *self.order, OP,
        )
        failed = changes.where(added & ~valid)
        rejects = (*self.rejects, self.reject(operator, failed, f"{operator} failed"))
        # `op` is the last order column: at one time the retraction comes before the addition.
        return self.with_(df=log, key=tuple(key), value=tuple(values), seq=(*self.seq, OP),
                          rejects=rejects, is_snapshot=False)
