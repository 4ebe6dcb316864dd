"""Substring dedup by content-defined chunks: a gear hash rolls over the bytes and cuts where it is small."""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from relstream.llm.common import bitmap_of, map_rows, maybe_in, stored

#: Bytes: the mean distance of cuts, the least and the greatest size of a chunk.
MEAN, LEAST, MOST = 16, 8, 512
#: Consecutive chunks whose bytes are compared as one: a common phrase of a chunk's length is no repeat by itself.
WINDOW = 3
#: Bytes of overlapping repeated windows that make a repeated passage.
PASSAGE = 64
_BITS = 1 << 26
#: A digest is hot if it has more than one in so many of all repeated windows; there are fewer hot ones than this. Their
#: rows are dealt to so many tasks.
_HOT, _PIECES = 1024, 32


def _gear() -> np.ndarray:
    """One 32-bit number per byte value, from a hash of the value."""
    return np.array([int.from_bytes(blake2b(bytes([b]), digest_size=4).digest(), "little") for b in range(256)], dtype=np.uint32)


GEAR = _gear()


def cuts(data: bytes, mean: int = MEAN, least: int = LEAST, most: int = MOST) -> list[int]:
    """Ends of the chunks. A cut depends on the 32 bytes before it, so insertions move few cuts.

    The rolling hash h = 2h + gear[byte] modulo 2^32 is computed for all positions at once: five doublings, each of which
    joins the sums of two neighbouring windows.
    """
    rolled = GEAR[np.frombuffer(data, dtype=np.uint8)]
    for k in range(5):
        width = 1 << k
        joined = rolled.copy()
        joined[width:] += rolled[:-width] << np.uint32(width)
        rolled = joined
    ends, last = [], 0
    for end in (np.flatnonzero(rolled < np.uint32((1 << 32) // mean)) + 1).tolist():
        while end - last > most:
            last += most
            ends.append(last)
        if end - last >= least:
            ends.append(end)
            last = end
    while len(data) - last > most:
        last += most
        ends.append(last)
    if last < len(data):
        ends.append(len(data))
    return ends


def windows(docs: DataFrame, text: str = "text", width: int = WINDOW) -> DataFrame:
    """One row per window of `width` consecutive chunks of every text (of all chunks of a shorter one): doc_id, text_hash, begin and
    size in UTF-8 bytes, and the 128-bit digest of its bytes as two numbers."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def each(_):
        def apply(doc_ids, hashes, texts):
            rows, digests = [], []
            for doc_id, text_hash, value in zip(doc_ids, hashes, texts):
                data = value.encode("utf-8", "surrogatepass") if value else b""
                if not data:
                    continue
                ends = cuts(data)
                for begin, end in zip([0, *ends], ends[width - 1:] or ends[-1:]):
                    rows.append((doc_id, text_hash, begin, end - begin))
                    digests.append(blake2b(data[begin:end], digest_size=16).digest())
            pairs = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
            return *(zip(*rows) if rows else [()] * 4), pairs[:, 0].tolist(), pairs[:, 1].tolist()
        return apply

    return map_rows(docs.select("doc_id", F.xxhash64(text), text), each,
                    f"doc_id {kind}, text_hash bigint, begin int, size int, d1 bigint, d2 bigint")


def repeated_passages(docs: DataFrame, passage: int = PASSAGE) -> DataFrame:
    """Stretches of a text that occur before, byte for byte: in a document with a smaller id, or earlier in the same one.

    Rows: doc_id, text_hash (xxhash64 of the text), begin and size in UTF-8 bytes, first_doc_id and first_begin: where the same
    bytes stand. A stretch is made of windows of chunks that overlap or touch and whose first occurrences lie in one
    document at one distance; it reaches `passage` bytes. Stretches of one text that go back to different documents may
    overlap. Every byte of a stretch stands at an earlier place (by doc_id, then position), so of what is cut away one copy
    always stays.

    Null and empty texts have no chunks; rows without an id are left out. Equal rows have the same windows at the same place,
    of which none is earlier: they keep them. Rows that share an id and differ in text are read each by itself, and of what
    they have at the same position neither is earlier. An empty table gives an empty one. Windows are counted before they are
    joined, and the rows of those that are very frequent are dealt out over salted copies of their one first
    occurrence; unique ones mostly stop at a bitmap of 8 MB and are not shuffled twice. A window's group and a document's
    repeated windows are never collected, but summed and sorted.
    """
    cut = windows(docs.where(F.col("doc_id").isNotNull()))
    first = cut.groupBy("d1", "d2").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "begin")).alias("first"))
    twice = stored(first.where(F.col("n") > 1), "windows")
    total = twice.agg(F.sum("n")).first()[0] or 0
    is_hot = F.col("n") * _HOT > total
    hot = F.broadcast(twice.where(is_hot).select("d1", "d2", F.lit(_PIECES).alias("pieces")))
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(_PIECES - 1))).otherwise(F.array(F.lit(0)))
    salted = twice.select("d1", "d2", "first", F.explode(copies).alias("salt"))
    likely = maybe_in(cut, F.col("d1"), bitmap_of(twice, "d1", _BITS), _BITS).where("__maybe").drop("__maybe")
    dealt = likely.join(hot, ["d1", "d2"], "left") \
        .withColumn("salt", F.coalesce(F.pmod(F.xxhash64("doc_id", "begin"), "pieces"), F.lit(0)).cast("int")).drop("pieces")
    later = dealt.join(salted, ["d1", "d2", "salt"]).where(F.struct("doc_id", "begin") != F.col("first")) \
        .select("doc_id", "text_hash", "begin", F.col("begin").cast("bigint").alias("from"), (F.col("begin").cast("bigint") + F.col("size")).alias("to"),
                F.col("first.doc_id").alias("first_doc_id"), (F.col("begin") - F.col("first.begin")).alias("apart"))
    stretch = ["doc_id", "text_hash", "first_doc_id", "apart"]
    order = Window.partitionBy(stretch).orderBy("begin")
    runs = later.withColumn("__new", F.coalesce((F.lag("to").over(order) < F.col("from")).cast("int"), F.lit(1))) \
        .withColumn("run", F.sum("__new").over(order))
    return (
        runs.groupBy(*stretch, "run").agg(F.min("from").alias("begin"), (F.max("to") - F.min("from")).alias("size"))
        .where(F.col("size") >= passage)
        .select("doc_id", "text_hash", "begin", "size", "first_doc_id", (F.col("begin") - F.col("apart")).alias("first_begin"))
    )


def without_passages(docs: DataFrame, passages: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with the passages cut out of their texts; characters that a passage cuts in two are kept whole.

    A document's passages, a row each, are gathered per document and text.
    """
    gathered = passages.groupBy(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).agg(F.sort_array(F.collect_list(F.struct("begin", "size"))).alias("__cut"))

    def one(value, parts):
        if value is None or not parts:
            return value
        data, kept, at = value.encode("utf-8", "surrogatepass"), [], 0
        for part in parts:
            begin, end = part["begin"], part["begin"] + part["size"]
            while begin < len(data) and data[begin] & 0xC0 == 0x80:
                begin += 1
            while end < len(data) and data[end] & 0xC0 == 0x80:
                end -= 1
            kept.append(data[at:begin])
            at = max(at, end)
        return b"".join([*kept, data[at:]]).decode("utf-8", "surrogatepass")

    def each(_):
        def apply(*columns):
            return *columns[:-2], [one(value, parts) for value, parts in zip(columns[-2], columns[-1])]
        return apply

    carried = [f for f in docs.schema if f.name != text]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in carried), f"`{text}` string"])
    same = (F.col("doc_id") == F.col("__id")) & (F.xxhash64(text) == F.col("__hash"))
    joined = docs.join(gathered, same, "left").select(*(F.col(f"`{f.name}`") for f in carried), F.col(text), F.col("__cut"))
    return map_rows(joined, each, schema).select(*docs.columns)
