"""Helpers that the text operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relstream.plans.scratch import scratch_path

#: Words as the operators' contracts define them: runs without blanks and ASCII control white space.
WORD = "[^\x20\x09-\x0D]+"
_ROWS = 512


def stored(df: DataFrame, purpose: str, compression: str = "zstd") -> DataFrame:
    """`df` written to the shared scratch folder and read again.

    Cuts the lineage: whatever is lost later, nothing above has to be computed again, and a result that depends on
    task numbers stays as it was committed.
    """
    path = scratch_path(df.sparkSession, purpose)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_rows(df: DataFrame, each: Callable[[int], Callable[..., list]], schema: str, done: Callable[[], None] | None = None) -> DataFrame:
    """Applies a function to Arrow columns, a few hundred rows at a time.

    `each(partition)` is called once per task and returns the function from lists, one per column of `df`, to lists, one
    per column of `schema`. `done` is called when the task ends: workers live on, and what they remember would add up.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = each(TaskContext.get().partitionId())
        try:
            for batch in batches:
                for begin in range(0, batch.num_rows, _ROWS):
                    part = batch.slice(begin, _ROWS)
                    columns = apply(*[column.to_pylist() for column in part.columns])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(values, field.type) for values, field in zip(columns, target)], schema=target)
        finally:
            if done:
                done()

    return df.mapInArrow(run, schema)


def grouped_rows(df: DataFrame, keys: list[str], apply: Callable, schema: str) -> DataFrame:
    """Applies a function to each group, a pandas frame in, one out. Groups are small and many: a task sorts its rows and
    goes through them, so that a group costs no call of its own and only one is held, beside one Arrow batch.
    """
    import pandas as pd

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for frame in frames:
            changed = (frame[keys] != frame[keys].shift()).any(axis=1).to_numpy()
            changed[0] = bool(held) and (held[-1][keys].iloc[-1] != frame[keys].iloc[0]).any()
            cuts = [*changed.nonzero()[0].tolist(), len(frame)]
            held.append(frame.iloc[:cuts[0]])
            for begin, end in zip(cuts, cuts[1:]):
                if sum(map(len, held)):
                    yield apply(pd.concat(held) if len(held) > 1 else held[0])
                held = [frame.iloc[begin:end]]
        if sum(map(len, held)):
            yield apply(pd.concat(held) if len(held) > 1 else held[0])

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(run, schema)


def numbered(df: DataFrame, part: str, local: str, weight: str, name: str) -> DataFrame:
    """Adds `name`: the running total of `weight` before each row, over all partitions.

    Rows carry the number of the partition that wrote them and the total before them there. What is broadcast is one
    row per written partition: its total, turned into an offset by a prefix sum.
    """
    totals = df.groupBy(part).agg(F.max(F.col(local) + F.col(weight)).alias("__total"))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col(part).alias("__part"), F.coalesce(F.sum("__total").over(before), F.lit(0)).alias("__base"))
    joined = df.join(F.broadcast(offsets), F.col(part) == F.col("__part"))
    return joined.withColumn(name, F.col("__base") + F.col(local)).drop("__part", "__base")


def bitmap_of(keys: DataFrame, key: str, bits: int = 1 << 24) -> DataFrame:
    """The values of `key` as a bitmap of `bits` hash positions; its size is at most bits / 8 bytes, whatever comes in."""
    slots = keys.select(F.pmod(F.xxhash64(key), F.lit(bits)).alias("__slot"))
    return slots.groupBy(F.bitmap_bucket_number("__slot").alias("__bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("__slot")).alias("__map"))


def maybe_in(df: DataFrame, key: Column, bitmap: DataFrame, bits: int = 1 << 24) -> DataFrame:
    """Adds `__maybe`: false only for rows whose key is surely not in the bitmap. Keeps rows from needless shuffles."""
    slot = F.pmod(F.xxhash64(key), F.lit(bits))
    at = F.bitmap_bit_position(F.col("__slot"))
    byte = F.conv(F.hex(F.expr("substring(__map, cast(__at div 8 as int) + 1, 1)")), 16, 10).cast("int")
    return (
        df.withColumn("__slot", slot).withColumn("__bucket", F.bitmap_bucket_number("__slot")).withColumn("__at", at)
        .join(F.broadcast(bitmap), "__bucket", "left")
        .withColumn("__maybe", F.coalesce(byte.bitwiseAND(F.expr("shiftleft(1, cast(__at % 8 as int))")) != 0, F.lit(False)))
        .drop("__slot", "__bucket", "__at", "__map")
    )
