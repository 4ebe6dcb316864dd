"""Sharding along a Hilbert curve: rows that are alike in several dimensions lie together, in shards of equal size."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from relstream.llm.common import map_rows, numbered, stored

#: Bits per dimension. Dimensions times bits must stay below 63.
BITS = 6


def curve_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Positions on the Hilbert curve of grid cells, one row each, by Skilling's transform on whole columns."""
    axes = [column.astype(np.int64) for column in cells.T]
    for level in range(bits - 1, 0, -1):  # undo the turns of each level, from the coarsest
        bit, below = 1 << level, (1 << level) - 1
        for k, axis in enumerate(axes):
            turned = (axis & bit) != 0
            swap = np.where(turned, 0, (axes[0] ^ axis) & below)
            axes[0] = np.where(turned, axes[0] ^ below, axes[0] ^ swap)
            if k:
                axes[k] = axis ^ swap
    for k in range(1, len(axes)):  # Gray code across the axes
        axes[k] = axes[k] ^ axes[k - 1]
    flips = np.zeros_like(axes[0])
    for level in range(bits - 1, 0, -1):
        flips = np.where((axes[-1] >> level) & 1, flips ^ ((1 << level) - 1), flips)
    index = np.zeros_like(axes[0])
    for level in range(bits - 1, -1, -1):
        for axis in axes:
            index = (index << 1) | (((axis ^ flips) >> level) & 1)
    return index


def ordinal(df: DataFrame, column: str) -> Column:
    """A number that keeps a column's order: numbers as they are, other values by the first six bytes of their text."""
    if isinstance(df.schema[column].dataType, NumericType):
        return F.col(f"`{column}`").cast("double")
    head = F.substring(F.encode(F.col(f"`{column}`").cast("string"), "utf-8"), 1, 6)
    return F.conv(F.rpad(F.hex(head), 12, "0"), 16, 10).cast("double")


def _cell(value: Column, edges: list[float]) -> Column:
    """How many of the sorted edges lie below the value, by binary search; 0 for null."""
    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value <= F.lit(edges[middle]), search(low, middle)).otherwise(search(middle + 1, high))
    return F.when(value.isNull(), F.lit(0)).otherwise(search(0, len(edges)))


def hilbert_ordered(df: DataFrame, dimensions: list[str], ties: list[str], bits: int = BITS) -> DataFrame:
    """`df` sorted by curve index and then by `ties`, with `curve`, `part` and `row_in_part`.

    Each dimension is cut into at most 2^bits cells at its approximate quantiles; a value that fills several quantiles is
    one cell. The edges are the only thing that the driver sees: 2^bits numbers per dimension. The sort splits rows of
    one curve position by `ties`, so a hot position is spread over tasks. Written to the scratch folder, which settles
    the order. Nulls come first.
    """
    cells = 1 << bits
    shares = [k / cells for k in range(1, cells)]
    values = df.select(*(ordinal(df, d).alias(f"d{k}") for k, d in enumerate(dimensions)))
    edges = values.agg(*(F.percentile_approx(f"d{k}", shares, 10_000).alias(f"d{k}") for k in range(len(dimensions)))).first()
    grid = [_cell(ordinal(df, d), sorted(set(edges[k] or []))) for k, d in enumerate(dimensions)]

    @F.pandas_udf("bigint")
    def position(cell: pd.DataFrame) -> pd.Series:
        return pd.Series(curve_index(cell.to_numpy(dtype=np.int64), bits))

    placed = df.withColumn("curve", position(F.struct(*(g.alias(f"c{k}") for k, g in enumerate(grid)))))
    sorted_rows = placed.repartitionByRange("curve", *ties).sortWithinPartitions("curve", *ties)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in placed.schema), "part int, row_in_part bigint"])

    def each(partition):
        done = 0

        def apply(*columns):
            nonlocal done
            n = len(columns[0])
            begin, done = done, done + n
            return *columns, [partition] * n, list(range(begin, begin + n))
        return apply

    return stored(map_rows(sorted_rows, each, schema), "hilbert")


def cut_runs(ordered: DataFrame, shards: int) -> DataFrame:
    """Adds `shard` and `slot`: equal runs of the order of `hilbert_ordered`, whose counts differ by one at most."""
    total = ordered.count()
    ranked = numbered(ordered.withColumn("__one", F.lit(1)), "part", "row_in_part", "__one", "rank")
    shard = F.expr(f"(rank * {shards} + {shards - 1}) div {max(total, 1)}")
    return (
        ranked.withColumn("shard", shard.cast("int"))
        .withColumn("slot", F.expr(f"rank - (cast(shard as bigint) * {total}) div {shards}"))
        .drop("__one", "part", "row_in_part", "rank")
    )


def shard_by_curve(df: DataFrame, dimensions: list[str], ties: list[str], shards: int = 16, bits: int = BITS) -> DataFrame:
    """All rows of `df` with `curve`, `shard` (0 to shards - 1) and `slot` (from 0, without gaps, in curve order).

    Law `rows`: shards differ by one row at most. Equal rows are rows of their own. Nulls are the first cell of their
    dimension. An empty table gives an empty one. Columns named curve, part, row_in_part, rank, shard or slot are replaced.
    """
    names = {"curve", "part", "row_in_part", "rank", "shard", "slot"}
    clean = df.drop(*(c for c in df.columns if c.lower() in names))
    return cut_runs(hilbert_ordered(clean, dimensions, ties, bits), shards)


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, rows in slot order; a file's minima and maxima then cover a small box of every dimension."""
    sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
