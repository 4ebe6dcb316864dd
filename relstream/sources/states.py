"""The state of a running table in files: a base of live rows and the changes since, and what its query itself holds.

    <location>/epoch=<n>             last versions of the keys that micro-batch n changed
    <location>/_base/<n>-<id>        the live rows after micro-batch n
    <location>/_manifest/<n>         names that base; appears by one rename, so it is there as a whole or not at all

A reader takes the newest manifest, its base and the changes after it. What the manifest before it names stays until the next
compaction, for readers that have begun with it; everything older goes, leftovers of interrupted compactions too.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relstream.sources.topics import TopicSpec

EPOCH = "epoch"


class TableFiles:
    """The files of one running table with `schema` (key columns among them), written by one query at a time."""

    def __init__(self, spark: SparkSession, topic: TopicSpec, schema: T.StructType, key: tuple[str, ...]):
        self.spark, self.topic, self.schema, self.key = spark, topic, T.StructType([*schema.fields, T.StructField(EPOCH, T.LongType())]), list(key)
        self.root = topic.location.rstrip("/")

    # -- the folder ------------------------------------------------------------------------------

    def _path(self, name: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _system(self):
        return self._path("").getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        files, path = self._system(), self._path(folder)
        return sorted(s.getPath().getName() for s in files.listStatus(path)) if files.exists(path) else []

    def _manifests(self) -> list[tuple[int, str]]:
        """(epoch, base) of every compaction, in order; a base's name begins with its epoch."""
        return [(int(name.split("-")[0]), name) for name in self._names("_manifest") if not name.startswith((".", "_"))]

    # -- reading ---------------------------------------------------------------------------------

    def _load(self, path: str) -> DataFrame:
        return self.spark.read.format(self.topic.format).options(**self.topic.options).schema(self.schema).load(path)

    def versions(self) -> DataFrame:
        """The last version of every key that lives or was deleted since the base, with its epoch."""
        manifests = self._manifests()
        if not manifests:
            rows = self._load(self.root)
        else:
            epoch, base = manifests[-1]
            rows = self._load(f"{self.root}/_base/{base}").unionByName(self._load(self.root).where(F.col(EPOCH) > epoch))
        rest = [f.name for f in self.schema if f.name not in (*self.key, EPOCH)]
        last = rows.groupBy(*self.key).agg(F.max_by(F.struct(*rest, EPOCH), EPOCH).alias("__last"))
        return last.select(*self.key, "__last.*")

    # -- writing ---------------------------------------------------------------------------------

    def _write(self, rows: DataFrame, path: str) -> None:
        rows.write.format(self.topic.format).options(**self.topic.options).mode("overwrite").save(path)

    def add(self, changed: DataFrame, epoch: int) -> None:
        """Keeps what a micro-batch changed; a repeated one replaces itself."""
        self._write(changed, f"{self.root}/{EPOCH}={epoch}")

    def compact(self, epoch: int, live) -> None:
        """Makes a new base out of everything up to `epoch`, less the rows that are not `live`, and lets go of what is older."""
        before = self._manifests()
        if before and before[-1][0] >= epoch:
            return  # a repeated micro-batch
        base = f"{epoch:012d}-{uuid.uuid4().hex}"
        self._write(self.versions().where(live), f"{self.root}/_base/{base}")
        self._announce(base)
        self._clear(before[-1:], base)

    def _announce(self, base: str) -> None:
        files, draft, final = self._system(), self._path(f"_manifest/_{base}"), self._path(f"_manifest/{base}")
        files.create(draft, True).close()
        if not files.rename(draft, final):
            raise OSError(f"cannot announce {final}")

    def _clear(self, before: list[tuple[int, str]], base: str) -> None:
        kept = {base, *(name for _, name in before)}
        old = [f"_manifest/{n}" for n in self._names("_manifest") if n not in kept]
        old += [f"_base/{n}" for n in self._names("_base") if n not in kept]
        if before:
            old += [n for n in self._names("") if n.startswith(f"{EPOCH}=") and int(n.split("=")[1]) <= before[0][0]]
        files = self._system()
        for name in old:
            files.delete(self._path(name), True)


def held(spark: SparkSession, checkpoint: str, columns: list[str], key: tuple[str, ...], batch_id: int | None = None, operator: int = 0) -> DataFrame:
    """The last version of every key as the query of `latest_versions` with this checkpoint holds it, after a micro-batch.

    Reads the state store, no sink. Spark keeps the state of as many micro-batches as `spark.sql.streaming.minBatchesToRetain`.
    """
    reader = spark.read.format("statestore").option("operatorId", operator)
    rows = (reader if batch_id is None else reader.option("batchId", batch_id)).load(checkpoint)
    # One aggregate, whose buffer begins with the struct of values and order.
    buffer = F.col("value")[rows.schema["value"].dataType.names[0]]
    return rows.select(*[(F.col("key")[c] if c in key else buffer[c]).alias(c) for c in columns])
