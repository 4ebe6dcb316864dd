"""Connected components by joins and aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relstream.llm.common import stored


def _toward_minimum(edges: DataFrame, larger_only: bool) -> DataFrame:
    """Links each neighbour v of u (v > u, or v < u and u itself) to the smallest node among u and its neighbours."""
    if larger_only:
        both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        moved = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        moved = edges.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                                                F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
    return moved.where(F.col("u") > F.col("v")).distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(id, component): the smallest node that each node of an edge can reach. Nodes without edges are not in it.

    Large-star and small-star steps in turn (Kiveris and others, 2014) until every node hangs on its smallest; some
    logarithm of the longest path. The minimum of a node's neighbours is aggregated before it is joined, so a node with
    many neighbours is no single group. Every round is written to the scratch folder.
    """
    known = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a) != F.col(b)).distinct()
    known = stored(known, "edges")
    signature = None
    while True:
        known = stored(_toward_minimum(_toward_minimum(known, True), False), "edges")
        now = known.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == signature:
            break
        signature = now
    roots = known.select(F.col("v").alias("id")).distinct()
    return known.select(F.col("u").alias("id"), F.col("v").alias("component")).unionAll(
        roots.select("id", F.col("id").alias("component")))
