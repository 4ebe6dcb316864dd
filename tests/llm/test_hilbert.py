"""Hilbert sharding: a curve without jumps, equal shards, narrow ranges."""

import itertools
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from relstream.llm.hilbert import curve_index, shard_by_curve, write_shards


@pytest.mark.parametrize("dimensions,bits", [(1, 4), (2, 1), (2, 4), (3, 3), (4, 2)])
def test_neighbours_on_the_curve_are_neighbours_in_the_grid(dimensions, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dimensions)))
    index = curve_index(cells, bits)
    assert sorted(index.tolist()) == list(range(len(cells)))
    path = cells[np.argsort(index)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def sharded(df, n=16):
    return shard_by_curve(df, ["lang", "source", "n_chars"], ["doc_id", "text"], n)


@pytest.mark.parametrize("rows", [0, 1, 5, 16, 333])
def test_shards_are_equal_and_slots_gapless(documents, rows):
    df = documents([(i % 50 if i % 9 else None, None if i % 7 == 0 else "x" * (i % 20)) for i in range(rows)], 4, extra=("shard", "rank"))
    found = sharded(df).collect()
    assert len(found) == rows
    counts = Counter(r["shard"] for r in found)
    assert set(counts) <= set(range(16)) and (rows < 16 or max(counts.values()) - min(counts.values()) <= 1)
    for shard in counts:
        assert sorted(r["slot"] for r in found if r["shard"] == shard) == list(range(counts[shard]))


def test_one_hot_position_is_cut_like_any_other(documents):
    found = sharded(documents([(i, "same") for i in range(200)]).withColumn("source", F.lit("hot")), 16)
    assert sorted(r["count"] for r in found.groupBy("shard").count().collect()) == [12] * 8 + [13] * 8


def test_shards_cover_small_boxes(spark, sf):
    """Against a sort by one dimension alone, files can be skipped by the others."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    spread = lambda df: df.groupBy("shard").agg(F.countDistinct("source").alias("s"), F.countDistinct("lang").alias("l")) \
        .agg(F.avg("s") * F.avg("l")).first()[0]
    mixed = docs.withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(16)))
    assert spread(sharded(docs)) < 0.7 * spread(mixed)


def test_written_shards_read_back(documents, tmp_path, spark):
    df = sharded(documents({i: "t" * i for i in range(40)}), 4)
    write_shards(df, str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == 40 and back.where("shard = 2").count() == 10
