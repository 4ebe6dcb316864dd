"""Hot keys: finding them, cutting their rows into ordered chunks, salting joins on them.

Everything here only decides *where* rows are processed. Estimates come from a sketch and a sample,
are taken once, and are embedded in the plan as a small local table, so a recomputed task sees the
same boundaries; results never depend on them.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relstream.functions.predicates import all_present
from relstream.functions.search import leading

CHUNK = "__chunk"
_HASH = "__key_hash"
_CUTS = "__cuts"

# The sketch keeps this many candidates; its counts are off by less than 1 / _SURE of the rows, so no key above that is missed.
_SKETCH_ITEMS = 16_384
_SURE = 10_000
_MERGE_GROUPS = 256
# All cut points together travel as one small table; pieces grow beyond this many of them.
_MAX_PIECES = 100_000
# Plan nodes whose output is no larger than what Spark estimates from the files below them.
_PLAIN = {"Project", "Filter", "Relation", "LogicalRelation", "RelationV2", "LocalRelation", "Aggregate", "Deduplicate", "Distinct",
          "SubqueryAlias", "GlobalLimit", "LocalLimit", "Range", "Sample", "Sort", "Repartition", "RepartitionByExpression", "OneRowRelation"}
# Files are compressed: a row in memory takes this many times its bytes.
_EXPANSION = 4

# Spark counts an input of unknown size as the largest long; more than an exabyte is no estimate.
_UNKNOWN_BYTES = 1 << 60


@dataclass(frozen=True)
class SplitPolicy:
    """When and how finely to split hot keys; settable per session as `relstream.split.<name>`.

    A key is hot when it has more rows than one task should take, `min_rows`, whatever the number of partitions; its
    pieces are of that size.
    """

    min_bytes: int = 1 << 30
    min_rows: int = 1_000_000
    sample_per_split: int = 32
    broadcast_bytes: int = 32 << 20

    @staticmethod
    def of(spark: SparkSession) -> SplitPolicy:
        default = SplitPolicy()
        return SplitPolicy(**{
            name: int(spark.conf.get(f"relstream.split.{name}", str(getattr(default, name))))
            for name in SplitPolicy.__dataclass_fields__
        })


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate for the plan's output; None where it has none to go by."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < _UNKNOWN_BYTES else None


def _is_plain(df: DataFrame) -> bool:
    """Whether nothing in the plan can make more, or larger, rows than its files hold."""
    nodes = re.findall(r"^[\s:+|-]*([A-Za-z0-9]+)", df._jdf.queryExecution().optimizedPlan().toString(), re.M)
    return all(node in _PLAIN for node in nodes)


def fits_broadcast(df: DataFrame, policy: SplitPolicy) -> bool:
    """Whether a broadcast is safe to ask for. Where the size is a guess, as above a generator or a join, it is left to
    adaptive execution, which broadcasts by measured sizes."""
    if df.isStreaming or policy.broadcast_bytes < 0 or not _is_plain(df):
        return False
    size = estimated_bytes(df)
    return size is not None and size * _EXPANSION <= policy.broadcast_bytes


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


@dataclass(frozen=True)
class HotKey:
    rows: int
    pieces: int


def hot_keys(df: DataFrame, keys: Sequence[str], policy: SplitPolicy) -> dict[int, HotKey]:
    """Estimated rows and number of pieces, by key hash, for keys that would overload one task; empty for small inputs.

    One pass over the key columns. Each task keeps a fixed-size frequent-items sketch, the sketches
    are merged in two steps, and at most `_SURE` entries reach the driver.
    """
    if df.isStreaming:
        return {}
    size = estimated_bytes(df)
    if size is not None and size < policy.min_bytes:
        return {}
    sketches = (
        df.where(all_present(keys))
        .select((F.spark_partition_id() % _MERGE_GROUPS).alias("g"), key_hash(keys).alias("h"))
        .groupBy("g")
        .agg(F.expr(f"approx_top_k_accumulate(h, {_SKETCH_ITEMS})").alias("s"), F.count("h").alias("n"))
    )
    found = sketches.agg(
        F.expr(f"approx_top_k_estimate(approx_top_k_combine(s), {_SURE})").alias("top"),
        F.sum("n").alias("total"),
    ).first()
    if not found.total:
        return {}
    limit = max(policy.min_rows, found.total / _SURE)
    piece = max(policy.min_rows, found.total / _MAX_PIECES)
    return {
        entry["item"]: HotKey(entry["count"], math.ceil(entry["count"] / piece) + 1)
        for entry in found.top
        if entry["count"] > limit
    }


@dataclass(frozen=True)
class Chunks:
    """Cut points of hot keys: a local table `(key hash, sorted array of order structs)`."""

    table: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]

    def assign(self, df: DataFrame) -> DataFrame:
        """Adds the chunk number: how many cut points of its key the row has passed (0 if none).

        Chunk numbers never decrease along the key's order, and the binary search costs a hot row
        log2(cuts) comparisons. The cut table has at most `_MAX_PIECES` cut points, so it is broadcast.
        """
        number = F.when(F.col(_CUTS).isNull(), F.lit(0)).otherwise(self._passed())
        return self._with_cuts(df, "left").withColumn(CHUNK, number).drop(_HASH, _CUTS)

    def assign_hot(self, df: DataFrame, last: str) -> DataFrame:
        """The rows that may be in a chunk other than 0, with it and their key's `last` chunk."""
        cut = self._with_cuts(df, "inner")
        return cut.withColumns({CHUNK: self._passed(), last: F.size(_CUTS)}).drop(_HASH, _CUTS)

    def _with_cuts(self, df: DataFrame, how: str) -> DataFrame:
        return df.withColumn(_HASH, key_hash(self.keys)).join(F.broadcast(self.table), _HASH, how)

    def _passed(self) -> Column:
        probe = F.struct(*[F.col(c) for c in self.order])
        return leading(F.col(_CUTS), lambda cut: cut <= probe)


def find_chunks(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                policy: SplitPolicy | None = None) -> Chunks | None:
    """Cut points for the hot keys of `df`, or None when no key needs splitting.

    The sample for the cut points is sized by the number of pieces, not by the data.
    """
    spark = df.sparkSession
    policy = policy or SplitPolicy.of(spark)
    hot = hot_keys(df, keys, policy)
    if not hot:
        return None
    rates = spark.createDataFrame(
        [(h, min(1.0, policy.sample_per_split * k.pieces / k.rows)) for h, k in hot.items()],
        f"{_HASH} long, rate double",
    )
    sample = (
        df.select(key_hash(keys).alias(_HASH), *order)
        .join(F.broadcast(rates), _HASH)
        .where(F.rand(17) < F.col("rate"))
        .groupBy(_HASH)
        .agg(F.array_sort(F.collect_list(F.struct(*order))).alias("sorted"))
    )
    cuts = defaultdict(list)
    for row in sample.collect():
        points, wanted = row["sorted"], hot[row[_HASH]].pieces
        for i in range(1, wanted):
            point = points[i * len(points) // wanted]
            if not cuts[row[_HASH]] or cuts[row[_HASH]][-1] != point:
                cuts[row[_HASH]].append(point)
    point_type = T.StructType([df.schema[c] for c in order])
    schema = T.StructType([T.StructField(_HASH, T.LongType()), T.StructField(_CUTS, T.ArrayType(point_type))])
    return Chunks(spark.createDataFrame(list(cuts.items()), schema), tuple(keys), tuple(order))


def _one_type(left: DataFrame, right: DataFrame, left_on: Sequence[str], right_on: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides with their join columns in a common type, so that equal keys are equal values and have equal hashes."""
    for a, b in zip(left_on, right_on):
        kinds = [left.schema[a].dataType, right.schema[b].dataType]
        if kinds[0] != kinds[1]:
            nulls = [F.lit(None).cast(kind) for kind in kinds]
            common = left.sparkSession.range(0).select(F.coalesce(*nulls).alias("c")).schema["c"].dataType
            left, right = left.withColumn(a, F.col(a).try_cast(common)), right.withColumn(b, F.col(b).try_cast(common))
    return left, right


def lookup_join(left: DataFrame, right: DataFrame, left_on: Sequence[str], right_on: Sequence[str],
                how: str, spread_by: Sequence[str], policy: SplitPolicy | None = None) -> DataFrame:
    """Equi-join of `left` to a `right` that has one row per key; `how` is inner or left.

    Join columns of different types are compared in their common type. A right side whose estimated size is within the bound is broadcast. Beyond it the join shuffles,
    and a hot left key is spread over several tasks by the hash of its `spread_by` columns while its
    single right row is repeated for each of them.
    """
    spark = left.sparkSession
    policy = policy or SplitPolicy.of(spark)
    left, right = _one_type(left, right, left_on, right_on)
    matches = [F.col(a) == F.col(b) for a, b in zip(left_on, right_on)]
    if fits_broadcast(right, policy):
        return left.join(F.broadcast(right), matches, how)
    hot = hot_keys(left, left_on, policy)
    if not hot:
        return left.join(right, matches, how)
    table = F.broadcast(spark.createDataFrame(
        [(h, k.pieces) for h, k in hot.items()], f"{_HASH} long, __pieces int"
    ))
    salt = F.when(F.col("__pieces").isNull(), F.lit(0)).otherwise(
        F.pmod(F.xxhash64(*[F.col(c) for c in spread_by]), F.col("__pieces")).cast("int")
    )
    salted = (
        left.withColumn(_HASH, key_hash(left_on)).join(table, _HASH, "left")
        .withColumn("__left_salt", salt).drop(_HASH, "__pieces")
    )
    copies = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("__pieces"), F.lit(1)) - 1))
    repeated = (
        right.withColumn(_HASH, key_hash(right_on)).join(table, _HASH, "left")
        .withColumn("__right_salt", copies).drop(_HASH, "__pieces")
    )
    matches.append(F.col("__left_salt") == F.col("__right_salt"))
    return salted.join(repeated, matches, how).drop("__left_salt", "__right_salt")
