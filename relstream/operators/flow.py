"""Branching, merging and side effects."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from relstream.functions.predicates import strict

_TAG = "__branch"


def run_action(rows: DataFrame, columns: tuple[str, ...], action: Callable[[dict], None]) -> DataFrame:
    """A lazy frame that calls `action` for each row and yields the failing rows with their error.

    Tasks may be retried, so the action runs at least once per row.
    """
    names = list(columns)
    error = "__error"

    def attempt(record: dict) -> str | None:
        try:
            action(record)
        except Exception as problem:
            return f"{type(problem).__name__}: {problem}"
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Arrow to Python: whole numbers stay whole, also beside a null.
        for batch in batches:
            errors = pa.array([attempt(dict(zip(names, row))) for row in zip(*[c.to_pylist() for c in batch.columns])], pa.string())
            yield batch.append_column(error, errors).filter(errors.is_valid())

    schema = rows.select(*names).schema.add(error, "string")
    return rows.select(*names).mapInArrow(run, schema)


class FlowOps:

    def branch(self, *conditions: Column | tuple[Column, tuple[str, ...]]) -> list:
        """One stream per condition; a record goes to the first that is true, or nowhere.

        A condition may come with its required columns, `(condition, requires)`; a failed one counts
        as false, the next is tried, and the record is in the quarantine of every branch.
        """
        given = [c if isinstance(c, tuple) else (c, ()) for c in conditions]
        met = [strict(condition, requires) for condition, requires in given]
        tag, failed, tried = F.lit(None).cast("int"), F.lit(False), F.lit(True)
        for number, condition in reversed(list(enumerate(met))):
            tag = F.when(condition, number).otherwise(tag)
        for condition in met:
            failed = failed | (tried & condition.isNull())
            tried = tried & ~F.coalesce(condition, F.lit(False))
        tagged = self.rows().withColumn(_TAG, tag)
        rejects = (*self.rejects, self.reject("branch", self.rows().where(failed), "branch failed"))
        return [
            self.with_(df=tagged.where(F.col(_TAG) == number).drop(_TAG), rejects=rejects)
            for number in range(len(conditions))
        ]

    def split(self, condition: Column, requires: tuple[str, ...] = ()) -> tuple:
        """The records that match and those that do not; a failed condition lands in neither."""
        return self.filter(condition, requires), self.filter_not(condition, requires)

    def merge(self, other):
        """All records of both streams, in no particular order."""
        if (self.key, self.value, self.order) != (other.key, other.value, other.order):
            raise ValueError("merged streams need the same key, value and order columns")
        return self.with_(df=self.rows().unionByName(other.rows()), rejects=self.all_rejects(other))

    def peek(self, observation: Observation | str, **metrics: Column):
        """Computes the aggregate `metrics` while records pass by unchanged, once per execution.

        Metrics that may fail should be `try_` expressions, which count as null.
        """
        observed = self.rows().observe(observation, *[m.alias(n) for n, m in metrics.items()])
        return self.with_(df=observed)

    def foreach(self, action: Callable[[dict], None], quarantine_path: str | None = None):
        """Calls `action` with each record, as a dict, on the executors.

        A failing call does not stop the flow: its record goes to `quarantine_path`, as rows of
        `quarantine()`, or is dropped when there is none. On a stream this returns the writer to start.
        """
        if self.df.isStreaming:
            def each(batch: DataFrame, epoch: int) -> None:
                path = quarantine_path and f"{quarantine_path.rstrip('/')}/epoch={epoch}"
                self.with_(df=batch)._run(action, path, "overwrite")

            return self.rows().writeStream.foreachBatch(each)
        return self._run(action, quarantine_path, "append")

    def _run(self, action: Callable[[dict], None], path: str | None, mode: str) -> None:
        failed = run_action(self.rows(), self.columns, action)
        rejected = self.reject("foreach", failed, F.col("__error"))
        if path:
            rejected.write.mode(mode).parquet(path)
        else:
            rejected.write.format("noop").mode("overwrite").save()
