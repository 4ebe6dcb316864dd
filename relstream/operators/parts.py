"""Branches, splits and maps in one pass: each record is decided once, written once under its part, and every part is read from there.

The lazy forms in `flow` and `stateless` scan their input again for every branch and for the quarantine, and call a Python function
anew each time. Here the input is scanned once and a function is called once per record (a task that is repeated writes its part
anew), so a function that does not always give the same answer still puts a record in one part.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relstream.functions.predicates import all_of, strict
from relstream.plans.scratch import scratch_path

_PART, _FAILED, _MET = "part", "failed", "__met"
#: The part of records that are in none.
_NONE = -1


class _Parts:
    """A table with the folders `part=<number>/failed=<boolean>`."""

    def __init__(self, decided: DataFrame, path: str | None, checkpoint: str | None):
        spark, self.path = decided.sparkSession, path or scratch_path(decided.sparkSession, "parts")
        self.streaming, self.writing = decided.isStreaming, None
        rest = [f for f in decided.schema if f.name not in (_PART, _FAILED)]
        self.schema = T.StructType([*rest, T.StructField(_PART, T.IntegerType()), T.StructField(_FAILED, T.BooleanType())])
        kept = decided.where((F.col(_PART) != _NONE) | F.col(_FAILED))
        if self.streaming:
            # A reading query may start before the first file is there: it needs the folder.
            spark.createDataFrame([], self.schema).write.mode("append").partitionBy(_PART, _FAILED).parquet(self.path)
            self.writing = kept.writeStream.format("parquet").outputMode("append").partitionBy(_PART, _FAILED) \
                .option("checkpointLocation", checkpoint or scratch_path(spark, "checkpoint")).start(self.path)
        else:
            kept.write.mode("overwrite").partitionBy(_PART, _FAILED).parquet(self.path)
        self.spark = spark

    def where(self, condition: Column) -> DataFrame:
        reader = self.spark.readStream if self.streaming else self.spark.read
        return reader.schema(self.schema).parquet(self.path).where(condition).drop(_PART, _FAILED)


class PartOps:
    """`path` is a folder for the parts, a new one below `spark.checkpoint.dir` if not given; it is overwritten by a batch.

    `compute` names columns that are evaluated once per record and that conditions and maps then read, for Python functions
    above all. On a stream the writing query is started and the results read the folder as streams of their own, for other
    queries: the result comes as `(result, writing)`.
    """

    def _computed(self, compute: dict[str, Column] | None) -> DataFrame:
        taken = set(self.columns) & set(compute or {})
        if taken or {_PART, _FAILED} & {*self.columns, *(compute or {})}:
            raise ValueError(f"computed columns need names of their own: {sorted(taken) or (_PART, _FAILED)}")
        return self.rows().withColumns(compute) if compute else self.rows()

    def _divided(self, operator: str, rows: DataFrame, part: Column, failed: Column, parts: int, path: str | None, checkpoint: str | None):
        decided = rows.select(*self.columns, part.cast("int").alias(_PART), failed.alias(_FAILED))
        written = _Parts(decided, path, checkpoint)
        rejected = self.reject(operator, written.where(F.col(_FAILED)), f"{operator} failed")
        found = [self.with_(df=written.where(F.col(_PART) == n), rejects=(*self.rejects, rejected)) for n in range(parts)]
        return (found, written.writing) if self.df.isStreaming else found

    def branch_through(self, *conditions: Column | tuple[Column, tuple[str, ...]], compute: dict[str, Column] | None = None,
                       path: str | None = None, checkpoint: str | None = None):
        """`branch` in one pass. A record with a failed condition is in the quarantine, and in the branch of a later true one."""
        given = [c if isinstance(c, tuple) else (c, ()) for c in conditions]
        rows = self._computed(compute).withColumn(_MET, F.array(*[strict(c, requires) for c, requires in given]))
        met = [F.col(_MET)[n] for n in range(len(given))]
        part, failed, tried = F.lit(_NONE), F.lit(False), F.lit(True)
        for number, condition in reversed(list(enumerate(met))):
            part = F.when(condition, number).otherwise(part)
        for condition in met:
            failed = failed | (tried & condition.isNull())
            tried = tried & ~F.coalesce(condition, F.lit(False))
        return self._divided("branch", rows, part, failed, len(given), path, checkpoint)

    def split_through(self, condition: Column, requires: Iterable[str] = (), compute: dict[str, Column] | None = None,
                      path: str | None = None, checkpoint: str | None = None):
        """`split` in one pass: the records that match, those that do not; failed ones are in the quarantine only."""
        rows = self._computed(compute).withColumn(_MET, strict(condition, requires))
        part = F.when(F.col(_MET), 0).when(~F.col(_MET), 1).otherwise(_NONE)
        return self._divided("split", rows, part, F.col(_MET).isNull(), 2, path, checkpoint)

    def map_through(self, key: dict[str, Column] | None = None, value: dict[str, Column] | None = None, valid: Column | None = None,
                    compute: dict[str, Column] | None = None, path: str | None = None, checkpoint: str | None = None):
        """`map`, `map_keys` or `map_values` in one pass; records that are not `valid` are in the quarantine as they were.

        Without `valid`, a null new key counts as failed and everything else is kept.
        """
        if not key and not value:
            raise ValueError("nothing to map: give key or value")
        operator = "map" if key and value else "map_keys" if key else "map_values"
        if valid is None:
            valid = all_of(c.isNotNull() for c in key.values()) if key else F.lit(True)
        keys = tuple(key) if key else self.key
        values = tuple(v for v in (value or self.value) if v not in keys)
        new = {**{n: F.col(n) for n in (*keys, *values) if n in self.columns}, **(key or {}), **(value or {})}
        rows = self._computed(compute).withColumn(_MET, F.coalesce(valid, F.lit(False)))
        decided = rows.select(
            F.when(~F.col(_MET), F.struct(*self.columns)).alias("before"),
            F.when(F.col(_MET), F.struct(*[new[n].alias(n) for n in (*keys, *values)])).alias("after"),
            *self.order, F.when(F.col(_MET), 0).otherwise(_NONE).cast("int").alias(_PART), (~F.col(_MET)).alias(_FAILED))
        written = _Parts(decided, path, checkpoint)
        rejected = self.reject(operator, written.where(F.col(_FAILED)).select("before.*"), f"{operator} failed")
        df = written.where(F.col(_PART) == 0).select("after.*", *self.order)
        found = self.with_(df=df, key=keys, value=values, rejects=(*self.rejects, rejected))
        return (found, written.writing) if self.df.isStreaming else found
