"""Filters and maps over record streams."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relstream.functions.predicates import all_of, strict
from relstream.functions.safe import safe_udf
from relstream.functions.times import above_watermark

_VALID = "__valid"


def _guard(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


class StreamMapOps:
    """Conditions are boolean columns; `requires` names columns without which they count as failed.

    For the maps, `valid` tells failed results from legitimate nulls. Failed records are dropped and
    go to `quarantine()`, unless `fallback` supplies columns to use instead. Quarantine frames are
    lazy: they cost nothing until they are read.
    """

    # -- filters ---------------------------------------------------------------------------------

    def filter(self, condition: Column, requires: Iterable[str] = ()):
        """Keeps records whose condition is true; false and failed ones are dropped."""
        return self._filtered("filter", strict(condition, requires))

    def filter_not(self, condition: Column, requires: Iterable[str] = ()):
        """Keeps records whose condition is false; a failed condition drops the record here too."""
        return self._filtered("filter_not", ~strict(condition, requires))

    def _filtered(self, operator: str, condition: Column):
        failed = self.reject(operator, self.rows().where(condition.isNull()), f"{operator} failed")
        return self.with_(df=self.rows().where(condition), rejects=(*self.rejects, failed))

    def filter_keys(self, condition: Column, requires: Iterable[str] = ()):
        self._only(condition, self.key)
        return self.filter(condition, requires)

    def filter_values(self, condition: Column, requires: Iterable[str] = ()):
        self._only(condition, self.value)
        return self.filter(condition, requires)

    def _only(self, condition: Column, allowed: tuple[str, ...]) -> None:
        """Resolves the condition against the allowed columns, so a wrong one fails at once."""
        self.df.select(*allowed).select(condition)

    # -- maps ------------------------------------------------------------------------------------

    def map_keys(self, key: dict[str, Column], valid: Column | None = None,
                 fallback: dict[str, Column] | None = None):
        """New key columns. Without `valid`, a null new key counts as failed."""
        return self._mapped("map_keys", key, None, valid, fallback)

    def map_values(self, value: dict[str, Column], valid: Column | None = None,
                   fallback: dict[str, Column] | None = None):
        """New value columns. Without `valid`, every result is kept, nulls included."""
        return self._mapped("map_values", None, value, valid, fallback)

    def map(self, key: dict[str, Column], value: dict[str, Column], valid: Column | None = None,
            fallback: dict[str, Column] | None = None):
        """New key and value columns. Without `valid`, a null new key counts as failed."""
        return self._mapped("map", key, value, valid, fallback)

    def _mapped(self, operator: str, key: dict[str, Column] | None, value: dict[str, Column] | None,
                valid: Column | None, fallback: dict[str, Column] | None):
        new = {**(key or {}), **(value or {})}
        if valid is None:
            valid = all_of(c.isNotNull() for c in key.values()) if key else F.lit(True)
        tested = self.rows().select("*", _guard(above_watermark(self, valid)).alias(_VALID))
        rejects = self.rejects
        if fallback is None:
            failed = tested.where(~F.col(_VALID))
            rejects = (*rejects, self.reject(operator, failed, f"{operator} failed"))
            tested = tested.where(_VALID)
        else:
            new = {n: F.when(F.col(_VALID), c).otherwise(fallback.get(n, F.lit(None))) for n, c in new.items()}
        keys = tuple(key) if key else self.key
        # A key column may take over the name of a value column, which then is the key only.
        values = tuple(v for v in (value or self.value) if v not in keys)
        kept = [n for n in (*keys, *values) if n not in new]
        df = tested.select(*[c.alias(n) for n, c in new.items()], *kept, *self.order)
        return self.with_(df=df, key=keys, value=values, rejects=rejects)

    def flat_map(self, records: Column, key: Iterable[str], value: Iterable[str], fallback: Column | None = None):
        """Each record becomes the structs of the array `records`; an empty one yields none.

        A null array counts as failed: no records, and the input goes to `quarantine()`, unless
        `fallback` gives an array to use instead.
        """
        key, value = tuple(key), tuple(value)
        records = records if fallback is None else F.coalesce(records, fallback)
        rows, rejects = self._expandable("flat_map", records)
        df = (
            rows.select(F.explode(records).alias("__r"), *self.order)
            .select(*[F.col("__r")[n].alias(n) for n in (*key, *value)], *self.order)
        )
        return self.with_(df=df, key=key, value=value, rejects=rejects)

    def flat_map_values(self, name: str, values: Column, fallback: Column | None = None):
        """Each record becomes one record per element of `values`, under the same key; `fallback` as for `flat_map`."""
        values = values if fallback is None else F.coalesce(values, fallback)
        rows, rejects = self._expandable("flat_map_values", values)
        df = rows.select(*self.key, F.explode(values).alias(name), *self.order)
        return self.with_(df=df, value=(name,), rejects=rejects)

    def flat_map_any(self, records: Callable[[dict], Iterable[dict]], key: str, value: str):
        """Each record, as a dict, becomes the dicts that a Python function gives or yields, in batches of Arrow columns.

        `key` and `value` are the DDL schemas of the results; a field that is not given is null. A call that raises, also
        after it has yielded some, gives no records: its input goes to `quarantine()` with the error. So do results
        that the schema cannot hold. Prefer `flat_map` where a `Column` can say the same.
        """
        keys, values = (T._parse_datatype_string(schema) for schema in (key, value))
        names, fields = list(self.columns), T.StructType([*keys, *values])
        made = safe_udf(lambda *row: list(records(dict(zip(names, row)))), T.ArrayType(fields))(*names)
        rows = self.rows().withColumn("__out", made)
        failed = F.col("__out.error").isNotNull()
        df = (
            rows.where(~failed).select(F.explode("__out.value").alias("__r"), *self.order)
            .select(*[F.col("__r")[n].alias(n) for n in fields.names], *self.order)
        )
        rejected = self.reject("flat_map_any", rows.where(failed), F.col("__out.error"))
        return self.with_(df=df, key=tuple(keys.names), value=tuple(values.names), rejects=(*self.rejects, rejected))

    def _expandable(self, operator: str, array: Column):
        failed = self.rows().where(array.isNull())
        return self.rows(), (*self.rejects, self.reject(operator, failed, f"{operator} failed"))
