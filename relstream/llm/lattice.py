"""Near duplicates of embeddings: lattice hashing with E8, neighbouring cells probed, cosines verified.

1. A table projects unit vectors on 16 random directions, scales them by `WIDTH` and decodes each half to the nearest point
   of the E8 lattice. The two points are the vector's home cell in that table. A vector also visits the cells beyond every
   facet that is less than `MARGIN` away from it. There are `TABLES` tables with their own directions.
2. Equal vectors are one class with one representative; only representatives are posted, as (cell, class).
   Cells with one post or without a home are dropped before any vector moves.
3. In a cell all cosines of homes with homes and of visitors with homes are taken as a matrix product, in blocks of `BLOCK`
   posts and pairs of blocks. Rows come out per vector, never per pair: how many it is linked with and a smaller member that
   links reach. A pair that meets several times counts in the first table only, and there in one cell.
4. Components of these links.

A pair at the threshold (distance 0.2) meets in a table with probability 0.58 or so, and in none of eight with 0.001; at 0.99
with less than 0.00002. A pair at right angles meets by chance in one of millions of cells.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relstream.llm.common import bitmap_of, grouped_rows, maybe_in, stored
from relstream.llm.graph import components

COSINE = 0.98
TABLES, WIDTH, MARGIN = 8, 1.6, 0.06
#: Posts of a cell that are compared at once.
BLOCK = 512
_HALVES, _DIMS, _BITS = 2, 8, 1 << 26
_MIX = np.uint64(0xBF58476D1CE4E5B9)


@lru_cache(maxsize=1)
def roots() -> np.ndarray:
    """The 240 shortest vectors of E8: (+-1, +-1, 0, ...) in all places, and halves with an even number of minus signs."""
    whole = []
    for i, j in itertools.combinations(range(_DIMS), 2):
        for a, b in itertools.product((1, -1), repeat=2):
            row = [0.0] * _DIMS
            row[i], row[j] = a, b
            whole.append(row)
    halves = [signs for signs in itertools.product((0.5, -0.5), repeat=_DIMS) if sum(s < 0 for s in signs) % 2 == 0]
    return np.array(whole + halves)


def _even(x: np.ndarray) -> np.ndarray:
    """The nearest points with whole coordinates and an even sum: rounded, the worst rounded the other way if need be."""
    rounded = np.rint(x)
    left = x - rounded
    odd = np.flatnonzero(rounded.sum(axis=1) % 2 != 0)
    worst = np.abs(left[odd]).argmax(axis=1)
    rounded[odd, worst] += np.where(left[odd, worst] >= 0, 1, -1)
    return rounded


def decode(x: np.ndarray) -> np.ndarray:
    """The nearest lattice point of each row: E8 is the even whole points and the same moved by one half everywhere."""
    one, two = _even(x), _even(x - 0.5) + 0.5
    closer = ((x - one) ** 2).sum(axis=1) <= ((x - two) ** 2).sum(axis=1)
    return np.where(closer[:, None], one, two)


@lru_cache(maxsize=8)
def _table(dims: int, table: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.RandomState(20250701 + table)
    directions = rng.normal(size=(dims, _HALVES * _DIMS)) / WIDTH
    return directions, rng.uniform(0, 2, _HALVES * _DIMS)


@lru_cache(maxsize=1)
def _multipliers() -> np.ndarray:
    rng = np.random.RandomState(20250702)
    high, low = (rng.randint(0, 1 << 32, _HALVES * _DIMS, dtype=np.uint64) for _ in range(2))
    return (high << np.uint64(32) | low | np.uint64(1)).reshape(_HALVES, _DIMS)


def _number(points: np.ndarray, half: int) -> np.ndarray:
    """A 64-bit number of lattice points, linear in them."""
    return (np.rint(2 * points).astype(np.int64).astype(np.uint64) * _multipliers()[half]).sum(axis=1, dtype=np.uint64)


def _mixed(numbers: np.ndarray, salt: np.ndarray) -> np.ndarray:
    x = (numbers ^ salt) * _MIX
    x ^= x >> np.uint64(29)
    x *= _MIX
    return (x ^ x >> np.uint64(32)).view(np.int64)


def cells(unit: np.ndarray, table: int, salt: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each row's home cell; the rows and cells of all visits."""
    directions, shift = _table(unit.shape[1], table)
    placed = unit @ directions + shift
    homes, rest = [], []
    for half in range(_HALVES):
        x = placed[:, half * _DIMS:(half + 1) * _DIMS]
        point = decode(x)
        homes.append(_number(point, half))
        rest.append(x - point)
    steps = [_number(roots(), half) for half in range(_HALVES)]
    total = homes[0] + homes[1]
    rows, visits = [], []
    for half in range(_HALVES):
        row, step = np.nonzero(rest[half] @ roots().T > 1 - MARGIN * np.sqrt(2))
        rows.append(row)
        visits.append(_mixed(total[row] + steps[half][step], salt[row]))
    return _mixed(total, salt), np.concatenate(rows), np.concatenate(visits)


def usable_rows(column: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of each length with their vectors; without null, empty and zero ones and those with null or non-finite numbers."""
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)
    lengths = np.where(column.is_valid().to_numpy(zero_copy_only=False), np.diff(offsets), 0)
    for length in np.unique(lengths[lengths > 0]).tolist():
        rows = np.flatnonzero(lengths == length)
        vectors = values[offsets[rows][:, None] + np.arange(length)]
        good = np.isfinite(vectors).all(axis=1) & (vectors != 0).any(axis=1)
        yield rows[good], vectors[good]


def units(vectors: np.ndarray) -> np.ndarray:
    wide = vectors.astype(np.float64)
    wide /= np.abs(wide).max(axis=1)[:, None]
    return wide / np.sqrt((wide * wide).sum(axis=1))[:, None]


def hashed(df: DataFrame, id: str, vector: str, label: str) -> DataFrame:
    """All rows: id, digest of label and vector (null: links with nothing), the vector's bytes, its home cells and visits."""
    schema = pa.schema([("id", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("vector", pa.binary()),
                        ("homes", pa.list_(pa.int64())), ("visits", pa.list_(pa.int64())), ("tables", pa.list_(pa.int32()))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = batch.column(1).to_pylist()
            out = {name: [None] * batch.num_rows for name in schema.names[1:]}
            for rows, vectors in usable_rows(batch.column(2)):
                chosen = np.array([labels[row] is not None for row in rows], dtype=bool)
                rows, vectors = rows[chosen], vectors[chosen]
                if not len(rows):
                    continue
                unit = units(vectors)
                salts = np.array([xxhash.xxh3_64_intdigest(f"{unit.shape[1]} {labels[row]}") for row in rows], dtype=np.uint64)
                found = [cells(unit, t, salts * np.uint64(2 * t + 1)) for t in range(TABLES)]
                homes = np.stack([home for home, _, _ in found], axis=1)
                owner = np.concatenate([row for _, row, _ in found])
                order = np.argsort(owner, kind="stable")
                visits = np.concatenate([visit for _, _, visit in found])[order]
                tables = np.repeat(np.arange(TABLES, dtype=np.int32), [len(row) for _, row, _ in found])[order]
                bounds = np.searchsorted(owner[order], np.arange(len(rows) + 1))
                for k, row in enumerate(rows.tolist()):
                    data = vectors[k].tobytes()
                    digest = xxhash.xxh3_128_digest(f"{labels[row]}:".encode() + data)
                    out["d1"][row], out["d2"][row] = np.frombuffer(digest, dtype="<i8").tolist()
                    out["vector"][row], out["homes"][row] = data, homes[k]
                    out["visits"][row], out["tables"][row] = visits[bounds[k]:bounds[k + 1]], tables[bounds[k]:bounds[k + 1]]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()),
                                              *(pa.array(out[f.name], f.type) for f in list(schema)[1:])], schema=schema)

    return df.select(id, label, vector).mapInArrow(
        run, "id bigint, d1 bigint, d2 bigint, vector binary, homes array<bigint>, visits array<bigint>, tables array<int>")


def _lists(column: pd.Series) -> list[np.ndarray]:
    return [np.asarray(value) for value in column]


def _met_before(homes: np.ndarray, visits: list[np.ndarray], tables: list[np.ndarray], table: int,
                a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the members a[k] and b[k] meet in an earlier table."""
    before = (homes[a, :table] == homes[b, :table]).any(axis=1)
    open_ = np.flatnonzero(~before)
    most = max((len(v) for v in visits), default=0)
    if not len(open_) or not most or not table:
        return before
    padded = np.full((len(visits), most), -1, dtype=np.int64)
    early = np.zeros((len(visits), most), dtype=bool)
    for k, (visit, of) in enumerate(zip(visits, tables)):
        padded[k, :len(visit)], early[k, :len(visit)] = visit, of < table
    for begin in range(0, len(open_), 20_000):
        part = open_[begin:begin + 20_000]
        for x, y in ((a[part], b[part]), (b[part], a[part])):
            for t in range(table):
                before[part] |= ((padded[x] == homes[y, t][:, None]) & early[x]).any(axis=1)
    return before


def _join_sets(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Puts a[k] and b[k] into one set; `parent` gives every member the smallest of its set."""
    while True:
        one, two = parent[a], parent[b]
        apart = one != two
        if not apart.any():
            return
        np.minimum.at(parent, np.maximum(one, two)[apart], np.minimum(one, two)[apart])
        while (parent[parent] != parent).any():
            parent[:] = parent[parent]


def _compared(float_type: str):
    def compare(group: pd.DataFrame) -> pd.DataFrame:
        """For one cell and pair of blocks: (d1, d2, rep, root, n) for members that are linked there."""
        group = group.sort_values(["d1", "d2"], kind="stable").reset_index(drop=True)
        table, low, high = int(group["table"].iloc[0]), group["low"].iloc[0], group["high"].iloc[0]
        key, home, block = int(group["key"].iloc[0]), group["home"].to_numpy(), group["block"].to_numpy()
        weight, reps = group["weight"].to_numpy(), group["rep"].to_numpy()
        lengths = group["vector"].map(len).to_numpy()
        homes, visits, tables = np.stack(_lists(group["homes"])), _lists(group["visits"]), _lists(group["tables"])
        count, parent = np.zeros(len(group), dtype=np.int64), np.arange(len(group))
        for length in np.unique(lengths).tolist():  # one, unless numbers of cells collide
            here = np.flatnonzero(lengths == length)
            unit = units(np.frombuffer(b"".join(group["vector"].iloc[here]), dtype=float_type).reshape(len(here), -1))
            rights = here if low == high else here[block[here] == high]
            right = unit if low == high else unit[block[here] == high]
            lefts = np.arange(len(here)) if low == high else np.flatnonzero(block[here] == low)
            for begin in range(0, len(lefts), BLOCK):
                part = lefts[begin:begin + BLOCK]
                x, y = np.nonzero(unit[part] @ right.T >= COSINE)
                a, b = here[part][x], rights[y]
                fit = (home[a] | home[b]) & ((a < b) if low == high else True)
                # The one with the smaller digest first, as everywhere.
                a, b = np.minimum(a[fit], b[fit]), np.maximum(a[fit], b[fit])
                a, b = (pairs[~_met_before(homes, visits, tables, table, a, b)] for pairs in (a, b))
                # If each visits the other's cell, they count where the second is at home.
                twice = np.array([home[i] and not home[j] and homes[j, table] in visits[i]
                                  for i, j in zip(a.tolist(), b.tolist())], dtype=bool) if not home.all() else np.zeros(len(a), dtype=bool)
                a, b = a[~twice], b[~twice]
                count += np.bincount(a, weights=weight[b], minlength=len(count)).astype(np.int64)
                count += np.bincount(b, weights=weight[a], minlength=len(count)).astype(np.int64)
                _join_sets(parent, a, b)
        linked = np.flatnonzero(count)
        return pd.DataFrame({"d1": group["d1"].to_numpy()[linked], "d2": group["d2"].to_numpy()[linked], "rep": reps[linked],
                             "root": reps[parent[linked]], "n": count[linked]})
    return compare


def links(reps: DataFrame, float_type: str) -> DataFrame:
    """(d1, d2, rep, root, n): for each class and cell in which it has links, their number and a member that they reach."""
    home = reps.select("d1", "d2", F.posexplode("homes").alias("table", "key"), F.lit(True).alias("home"))
    visit = reps.select("d1", "d2", F.inline(F.arrays_zip(F.col("tables").alias("table"), F.col("visits").alias("key"))), F.lit(False).alias("home"))
    posts = stored(home.unionByName(visit), "posts")
    alive = stored(posts.groupBy("key").agg(F.count("*").alias("n"), F.max("home").alias("home")).where("home AND n > 1").select("key", "n"), "cells")
    likely = maybe_in(posts, F.col("key"), bitmap_of(alive, "key", _BITS), _BITS).where("__maybe").drop("__maybe").join(alive, "key")
    blocked = likely.withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int")).drop("n") \
        .withColumn("block", F.pmod(F.xxhash64("d1", "d2"), F.col("blocks")).cast("int"))
    payload = reps.select("d1", "d2", "rep", "weight", "vector", "homes", "visits", "tables")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    rows = blocked.join(payload, ["d1", "d2"]).select("*", other).drop("blocks") \
        .withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other")).drop("other")
    return grouped_rows(rows, ["key", "low", "high"], _compared(float_type), "d1 bigint, d2 bigint, rep bigint, root bigint, n bigint")


def near_duplicates(df: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """id, n_links (other vectors linked directly), component_id (the smallest id that links reach) and kept, one row per row.

    Vectors link within a label if their cosine in double precision is at least `COSINE`. Rows whose label or vector is null,
    whose vector is empty, zero or of another length, or holds null or non-finite numbers link with nothing; neither do rows
    without an id, which are kept. Rows that repeat id, label and vector are one vector, each returned; an id with several
    vectors or labels is one point of the components, and counts its links for each. Ties do not arise; an empty table gives
    an empty one. Ids are whole numbers; other columns are left out.
    """
    float_type = "<f8" if df.schema[vector].dataType.elementType.simpleString() == "double" else "<f4"
    rows = stored(hashed(df, id, vector, label).withColumn("row", F.monotonically_increasing_id()), "vectors")
    usable = rows.where(F.col("id").isNotNull() & F.col("d1").isNotNull())
    members = usable.select("d1", "d2", "id", "row").groupBy("d1", "d2", "id").agg(F.min("row").alias("row"))
    classes = stored(members.groupBy("d1", "d2").agg(F.min_by("row", "id").alias("row"), F.min("id").alias("rep"),
                                                     F.count("*").alias("weight")), "classes")
    reps = stored(usable.drop("d1", "d2", "id").join(classes, "row"), "reps")
    found = stored(links(reps, float_type), "links")
    counts = found.groupBy("d1", "d2").agg(F.sum("n").alias("n"))
    owners = classes.join(counts, ["d1", "d2"], "left").select("d1", "d2", "rep", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    # An id with several vectors ties their classes together.
    tied = members.groupBy("id").agg(F.count("*").alias("n")).where(F.col("n") > 1).select("id") \
        .join(members, "id").join(classes.drop("row"), ["d1", "d2"]).select("id", "rep")
    edges = found.select("rep", "root").where(F.col("rep") != F.col("root")).distinct().unionAll(tied.where(F.col("rep") != F.col("id")))
    reached = components(edges, "rep", "root").withColumnRenamed("id", "rep")
    placed = stored(owners.join(reached, "rep", "left").select("d1", "d2", "n_links", F.coalesce("component", "rep").alias("component_id")), "placed")
    linked = usable.select("id", "d1", "d2").join(placed, ["d1", "d2"]).drop("d1", "d2")
    rest = rows.where(F.col("id").isNull() | F.col("d1").isNull()).select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(rest).select(F.col("id").alias(id), "n_links", "component_id",
                                           F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))
