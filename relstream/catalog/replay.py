"""Running the catalog's flows as streams: replaying a table in time order, and keeping what a stream emits."""

from __future__ import annotations

import math
from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relstream.functions.times import micros
from relstream.plans.scratch import scratch_path
from relstream.plans.skew import estimated_bytes

_FILE_BYTES = 128 << 20
# What a micro-batch may hold: operators with state take a key's rows of one micro-batch at a time.
_BATCH_BYTES = 256 << 20
_CENTURY_MICROS = 100 * 365 * 24 * 3600 * 1_000_000


def stream_session(spark: SparkSession) -> SparkSession:
    """A session for streams: UTC, as many state partitions as cores, state in RocksDB."""
    session = spark.newSession()
    wanted = min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    session.conf.set("spark.sql.session.timeZone", "UTC")
    session.conf.set("spark.sql.shuffle.partitions", str(wanted))
    session.conf.set("spark.sql.streaming.stateStore.providerClass",
                     "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    session.conf.set("spark.sql.streaming.join.stateFormatVersion", "3")
    return session


def replay(stream, slices: int = 3, late: DataFrame | None = None, flush: bool = True,
           session: SparkSession | None = None):
    """A batch record stream as a real stream: `slices` micro-batches, or more for large ones, in time order.

    The rows are written to the shared scratch folder, slice after slice, since a file source takes
    files by age; each slice has as many files as its size asks for and becomes one micro-batch.
    `late` rows follow as one more slice. With `flush` a record without key and value ends the
    stream: it lies a century ahead, so that the watermark passes all others, and no operator
    returns it. Streams that are joined have to share one `session`.
    """
    spark = stream.spark
    session = session or stream_session(spark)
    path = scratch_path(spark, "replay")
    rows = stream.rows()
    at = micros(rows, stream.ts)
    size = estimated_bytes(rows)
    if size is None:
        raise ValueError("the size of the rows is not known, so micro-batches cannot be bounded: write them out first")
    slices = max(slices, math.ceil(size / _BATCH_BYTES))
    edges = rows.agg(
        F.percentile_approx(at, [i / slices for i in range(1, slices)], 1000).alias("cuts"), F.max(at).alias("last")
    ).first()
    # Literals of the column's own type, so that each slice reads its part of the files only.
    kind = rows.schema[stream.ts].dataType
    epoch = F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'" if isinstance(kind, T.TimestampNTZType) else "timestamp_micros(0)")
    cuts = [epoch + F.lit(timedelta(microseconds=c)) for c in sorted(set(edges["cuts"] or []))]
    bounds = [None, *cuts, None]
    files = max(1, math.ceil(size / slices / _FILE_BYTES))
    as_instant = F.col(stream.ts).cast("timestamp")
    with_instant = [as_instant.alias(c) if c == stream.ts else F.col(c) for c in stream.columns]

    def write(part: DataFrame) -> None:
        part.select(*with_instant).repartition(files).write.mode("append").parquet(path)

    for low, high in zip(bounds, bounds[1:]):
        condition = F.lit(True)
        if low is not None:
            condition = condition & (F.col(stream.ts) >= low)
        if high is not None:
            condition = condition & (F.col(stream.ts) < high)
        write(rows.where(condition))
    def write_silent(at_micros: int) -> None:
        silent = spark.range(files).select(*[
            F.timestamp_micros(F.lit(at_micros)).alias(c) if c == stream.ts
            else F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in stream.columns
        ])
        silent.repartition(files).write.mode("append").parquet(path)

    last = edges["last"] or 0
    if late is not None:
        # Lateness is judged by the watermark one micro-batch back.
        write_silent(last)
        write(late)
    if flush:
        write_silent(last + _CENTURY_MICROS)
    schema = rows.select(*with_instant).schema
    df = session.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)
    return stream.with_(df=df, rejects=())


def appended(df: DataFrame, spark: SparkSession) -> DataFrame:
    """Runs an append-mode stream over all available input; returns what it emitted."""
    out = scratch_path(spark, "out")
    (
        df.writeStream.format("parquet").outputMode("append").option("path", out)
        .option("checkpointLocation", scratch_path(spark, "checkpoint"))
        .trigger(availableNow=True).start().awaitTermination()
    )
    return spark.read.schema(df.schema).parquet(out)


def updated(df: DataFrame, keys: Sequence[str], spark: SparkSession) -> DataFrame:
    """Runs an update-mode stream over all available input; returns the last row of every key.

    Each epoch writes its own folder and overwrites it when repeated, so a retry changes nothing.
    """
    out = scratch_path(spark, "out")

    def keep(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

    (
        df.writeStream.foreachBatch(keep).outputMode("update")
        .option("checkpointLocation", scratch_path(spark, "checkpoint"))
        .trigger(availableNow=True).start().awaitTermination()
    )
    stored = T.StructType([*df.schema.fields, T.StructField("epoch", T.LongType())])
    rows = spark.read.schema(stored).parquet(out)
    rest = [c for c in df.columns if c not in keys]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "epoch").alias("__last"))
    return last.select(*keys, "__last.*")
