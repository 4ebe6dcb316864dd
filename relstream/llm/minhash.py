"""Near duplicates by MinHash: an inverted join of signature coordinates, and a count on full shingle sets.

1. A document's set is its distinct five-word shingles, its signature 64 minima under different hashes. Documents with equal
   sets become one class with one representative.
2. Representatives are posted under each (coordinate, value). A pair is a candidate if at least `MATCHES` of its 64
   coordinates agree, so postings that occur once are dropped, and so are representatives with fewer postings left.
3. Prefix: of a representative's p postings, any `MATCHES` agreeing ones include one of its p - MATCHES + 1 rarest. Only those
   are joined; the commoner ones, long lists of widespread passages, are skipped and merely counted in step 5.
4. Postings in one list are chained to its smallest member; the components of these chains hold every candidate pair.
   Components are cut into blocks of bounded size and pairs of blocks.
5. In a pair of blocks agreeing coordinates are counted for all its pairs at once; pairs that reach `MATCHES` are compared on
   their full sets, and links that connect something new are kept. No list of pairs is ever made.
6. Components of the links, joined to the classes.

Two sets with similarity s agree in a coordinate with probability s, so a link is lost with the probability that a binomial
variable of 64 trials stays under `MATCHES`: below 1e-8 at s = 0.75.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from relstream.llm.common import WORD, bitmap_of, map_rows, maybe_in, stored
from relstream.llm.graph import components

#: On UTF-8 bytes: what parts words is ASCII.
_WORD = re.compile(WORD.encode())
#: A-Z only, as the contract says; other letters keep their case.
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
SHINGLE, COORDINATES, MATCHES = 5, 64, 28
#: Least similarity of a link, in percent.
SIMILAR = 75
#: Representatives in a block.
BLOCK = 192
_BITS = 1 << 26
_REMEMBERED = 150_000
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_STEP = np.uint64(0x9E3779B97F4A7C15)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _REMEMBERED:
            self.clear()
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 60:
            self[word] = value
        return value


@lru_cache(maxsize=1)
def _word_hashes() -> _WordHashes:
    return _WordHashes()


def _forget() -> None:
    _word_hashes.cache_clear()


@lru_cache(maxsize=1)
def _hashes() -> tuple[np.ndarray, np.ndarray]:
    """An odd multiplier and an addend per coordinate."""
    state = np.random.RandomState(20250607)
    draw = lambda: state.randint(0, 1 << 32, COORDINATES, dtype=np.uint64) << np.uint64(32) | state.randint(0, 1 << 32, COORDINATES, dtype=np.uint64)
    return draw() | np.uint64(1), draw()


def shingles(text: str | None) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; with fewer words than a shingle has, of the whole sequence."""
    words = _WORD.findall(text.encode("utf-8", "surrogatepass").translate(_LOWER)) if text else []
    if not words:
        return np.zeros(0, dtype=np.uint64)
    hashes = np.fromiter(map(_word_hashes().__getitem__, words), dtype=np.uint64, count=len(words))
    width = min(SHINGLE, len(words))
    size = len(words) - width + 1
    rolled = np.full(size, width, dtype=np.uint64)
    for k in range(width):
        rolled *= _STEP
        rolled += hashes[k: size + k]
    rolled ^= rolled >> np.uint64(30)
    rolled *= _MIX
    rolled ^= rolled >> np.uint64(27)
    return np.unique(rolled)


def digest(found: np.ndarray) -> tuple[int, int]:
    first, second = np.frombuffer(xxhash.xxh3_128_digest(found.tobytes()), dtype="<i8").tolist()
    return first, second


def signature(found: np.ndarray) -> np.ndarray:
    multipliers, addends = _hashes()
    return np.array([(found * a + b).min() for a, b in zip(multipliers, addends)], dtype=np.uint64)


def signed(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, n_shingles, the digest of the set (two numbers, null for an empty one) and the signature."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def each(_):
        def apply(doc_ids, texts):
            counts, d1, d2, signatures = [], [], [], []
            for value in texts:
                found = shingles(value)
                counts.append(len(found))
                if len(found):
                    first, second = digest(found)
                    d1.append(first)
                    d2.append(second)
                    signatures.append(signature(found).astype("<u8").tobytes())
                else:
                    d1.append(None)
                    d2.append(None)
                    signatures.append(None)
            return doc_ids, counts, d1, d2, signatures
        return apply

    return map_rows(docs.select("doc_id", text), each,
                    f"doc_id {kind}, n_shingles bigint, d1 bigint, d2 bigint, signature binary", _forget)


def postings(classes: DataFrame) -> DataFrame:
    """(rep, key): a representative under each of its coordinate values; the key is a 64-bit hash of both."""
    def each(_):
        salts = np.arange(1, COORDINATES + 1, dtype=np.uint64) * _STEP

        def apply(reps, signatures):
            values = np.frombuffer(b"".join(signatures), dtype="<u8").reshape(-1, COORDINATES)
            keys = (values ^ (values >> np.uint64(29))) * _MIX + salts
            return np.repeat(np.array(reps), COORDINATES).tolist(), keys.view(np.int64).ravel().tolist()
        return apply

    return map_rows(classes.select("rep", "signature"), each, "rep bigint, key bigint")


def prefixes(posts: DataFrame) -> DataFrame:
    """(rep, key): the rarest postings of each representative that can have a candidate at all."""
    lists = stored(posts.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > 1), "lists")
    likely = maybe_in(posts, F.col("key"), bitmap_of(lists, "key", _BITS), _BITS).where("__maybe").drop("__maybe")
    shared = likely.join(lists, "key")
    own = Window.partitionBy("rep")  # at most COORDINATES rows
    ranked = shared.withColumn("p", F.count("*").over(own)).withColumn("rank", F.row_number().over(own.orderBy("n", "key")))
    return ranked.where(F.col("rank") <= F.col("p") - MATCHES + 1).select("rep", "key")


def grouped(prefix: DataFrame) -> DataFrame:
    """(rep, cluster): components of the lists' chains. No candidate pair lies across two of them."""
    heads = prefix.groupBy("key").agg(F.min("rep").alias("head"), F.count("*").alias("n")).where(F.col("n") > 1).select("key", "head")
    return components(prefix.join(heads, "key").where(F.col("rep") != F.col("head")).select("rep", "head").distinct(), "rep", "head") \
        .select(F.col("id").alias("rep"), F.col("component").alias("cluster"))


def block_links(sets: list[np.ndarray], signatures: np.ndarray, side: np.ndarray) -> Iterator[tuple[int, int]]:
    """Links between the members of a pair of blocks: enough to connect whatever its links connect.

    `side` is 0 for both blocks' own pairs being compared, 1 and 2 where only pairs across are.
    """
    parent = list(range(len(sets)))

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    for a in range(len(sets)):
        agreeing = (signatures[a + 1:] == signatures[a]).sum(axis=1)
        for b in (np.flatnonzero(agreeing >= MATCHES) + a + 1).tolist():
            if side[a] and side[a] == side[b]:
                continue
            x, y = sets[a], sets[b]
            low, high = sorted((len(x), len(y)))
            if 100 * low < SIMILAR * high:
                continue
            one, two = root(a), root(b)
            if one == two:
                continue
            common = len(np.intersect1d(x, y, assume_unique=True))
            if 100 * common >= SIMILAR * (len(x) + len(y) - common):
                parent[two] = one
                yield a, b


def links(members: DataFrame) -> DataFrame:
    """(a, b): confirmed links among members (rep, cluster, signature, text), by pairs of blocks within a cluster."""
    sizes = members.groupBy("cluster").agg(F.count("*").alias("n"))
    blocked = (
        members.join(sizes, "cluster").where(F.col("n") > 1)
        .withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
        .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("rep", "cluster", "signature", "hashes", "block",
                F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    )

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("rep")
        reps = group["rep"].tolist()
        sets = [np.frombuffer(h, dtype="<u8") for h in group["hashes"]]
        signatures = np.frombuffer(b"".join(group["signature"]), dtype="<u8").reshape(-1, COORDINATES)
        low, high = int(group["low"].iloc[0]), int(group["high"].iloc[0])
        side = np.zeros(len(reps), dtype=int) if low == high else np.where(group["block"].to_numpy() == low, 1, 2)
        found = list(block_links(sets, signatures, side))
        return pd.DataFrame({"a": [reps[x] for x, _ in found], "b": [reps[y] for _, y in found]}, dtype="int64")

    return blocked.groupBy("cluster", "low", "high").applyInPandas(compare, "a bigint, b bigint")


def shingle_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """`wanted` (rep, d1, d2, ...) with `hashes`, the full set. Only texts of these documents are read again and shuffled."""
    likely = maybe_in(docs.select(F.col("doc_id").cast("bigint").alias("rep"), "text"), F.col("rep"),
                      bitmap_of(wanted, "rep", _BITS), _BITS)

    def each(_):
        def apply(ids, texts):
            sets = [shingles(value) for value in texts]
            digests = [digest(found) for found in sets]
            return ids, [d[0] for d in digests], [d[1] for d in digests], [found.astype("<u8").tobytes() for found in sets]
        return apply

    found = map_rows(likely.where("__maybe").select("rep", "text"), each, "rep bigint, d1 bigint, d2 bigint, hashes binary", _forget)
    return wanted.join(found, ["rep", "d1", "d2"]).dropDuplicates(["rep", "d1", "d2"])


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id that links reach), kept (whether it is that one itself).

    Null and empty texts have empty sets and no links. Short texts are one shingle and link with equal ones only. Documents
    with equal sets link; rows that repeat one doc_id count as one document if their texts are equal (each such row is
    returned); a doc_id with different texts links them. Rows without doc_id are returned as they are, unlinked and kept. An
    empty table gives an empty one. doc_id is a whole number.
    """
    rows = stored(signed(docs), "signatures")
    usable = rows.where(F.col("doc_id").isNotNull() & F.col("d1").isNotNull())
    classes = stored(usable.groupBy("d1", "d2").agg(F.min("doc_id").cast("bigint").alias("rep"), F.first("signature").alias("signature")), "classes")
    clusters = stored(grouped(stored(prefixes(postings(classes)), "prefixes")), "clusters")
    found = components(links(shingle_sets(docs, classes.join(clusters, "rep"))), "a", "b")
    # A class hangs on its representative; linked representatives on the smallest of theirs.
    owners = classes.select("d1", "d2", "rep").join(found.withColumnRenamed("id", "rep"), "rep", "left") \
        .select("d1", "d2", F.coalesce("component", "rep").alias("component_id"))
    merged = usable.select("doc_id", "d1", "d2", "n_shingles").join(owners, ["d1", "d2"]).drop("d1", "d2")
    rest = rows.where(F.col("doc_id").isNull() | F.col("d1").isNull()).select("doc_id", "n_shingles", F.col("doc_id").cast("bigint").alias("component_id"))
    return merged.unionByName(rest).select("doc_id", "n_shingles", "component_id",
                                           F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents that `near_duplicates` keeps, with the columns they came with.

    What goes is looked up in a bitmap of fixed size first, so that only documents that may go are shuffled.
    """
    gone = stored(near_duplicates(docs).where(~F.col("kept")).select(F.col("doc_id").alias("__gone")).distinct(), "gone")
    rows = maybe_in(docs, F.col("doc_id"), bitmap_of(gone, "__gone", _BITS), _BITS)
    stay = rows.where(~F.col("__maybe"))
    checked = rows.where("__maybe").join(gone, F.col("doc_id") == F.col("__gone"), "left_anti")
    return stay.unionByName(checked).select(docs.columns)
