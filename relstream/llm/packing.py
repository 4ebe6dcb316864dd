"""Packing: documents as one stream of token ids, cut at fixed places."""

from __future__ import annotations

import json
import re
import zlib
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relstream.llm.common import map_rows, numbered, stored

# How the byte-level vocabulary splits text before merging (fixed value; belongs to the vocabulary).
_PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: A blank before white space or the end belongs to a run of white space, and is no place to split a text.
_RUN = re.compile(r" (?=\s|$)")
#: Words whose ids a task remembers, about 40 MB.
_REMEMBERED = 150_000


def _byte_of_character() -> dict[str, int]:
    """Byte-level vocabularies write printable Latin-1 bytes as themselves and the others, in order, from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(others)}


@lru_cache(maxsize=2)
def _encoding(path: str):
    """A byte-level BPE file as a tiktoken encoding: same ids, several times the speed; and the added tokens with their ids.

    In these files ids rise in merge order, so an id is a rank. Added tokens are no merges: they are cut out of a text first.
    """
    import tiktoken
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    special = {token["content"]: token["id"] for token in content["added_tokens"]}
    of = _byte_of_character()
    ranks = {bytes(of[c] for c in token): rank for token, rank in content["model"]["vocab"].items() if token not in special}
    return tiktoken.Encoding("byte-level", pat_str=_PIECES, mergeable_ranks=ranks, special_tokens={}), special


class Words(dict):
    """Token ids of words with the blank before them, two little-endian bytes each; bounded."""

    def __init__(self, path: str):
        self.encoding, added = _encoding(path)
        self.added = {token: np.array([number], dtype="<u2").tobytes() for token, number in added.items()}
        longest_first = sorted(added, key=len, reverse=True)
        self.cuts = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if added else None

    def encode(self, text: str) -> bytes:
        return np.array(self.encoding.encode_ordinary(text), dtype="<u2").tobytes()

    def __missing__(self, word: str) -> bytes:
        if len(self) >= _REMEMBERED:
            self.clear()
        ids = self.encode(word)
        if len(word) <= 40:
            self[word] = ids
        return ids


@lru_cache(maxsize=2)
def _words(path: str) -> Words:
    return Words(path)


def _forget() -> None:
    _words.cache_clear()


def encode(text: str | None, words: Words) -> bytes:
    """The text's ids, two bytes each. A string of an added token is that token's id, and what lies around it is text of its own."""
    if not text:
        return b""
    if words.cuts is not None and words.cuts.search(text):
        return b"".join(words.added[part] if part in words.added else _ordinary(part, words) for part in words.cuts.split(text))
    return _ordinary(text, words)


def _ordinary(text: str, words: Words) -> bytes:
    """Tokens never reach over a single blank before a word, so a text can be split there and repeated words looked up."""
    if "\0" in text or _RUN.search(text):
        return words.encode(text)
    return b"".join(map(words.__getitem__, text.replace(" ", "\0 ").split("\0")))


def tokenized(docs: DataFrame, tokenizer: str, end: int = 0) -> DataFrame:
    """First pass: each document's ids with `end` after them, its row's partition and the tokens before it there.

    Written to the scratch folder, so that texts are tokenized once and the numbers of partitions are settled.
    """
    tail = np.array([end], dtype="<u2").tobytes()

    def each(partition):
        words, before = _words(tokenizer), 0

        def apply(doc_ids, texts):
            nonlocal before
            ids = [encode(text, words) + tail for text in texts]
            starts = []
            for row in ids:
                starts.append(before)
                before += len(row) // 2
            return doc_ids, [partition] * len(ids), starts, [len(row) // 2 for row in ids], ids
        return apply

    kind = docs.schema["doc_id"].dataType.simpleString()
    return stored(map_rows(docs.select("doc_id", "text"), each,
                           f"doc_id {kind}, part int, before bigint, n_tokens bigint, ids binary", _forget), "tokens")


def pack(docs: DataFrame, tokenizer: str, length: int = 1024, end: int = 0) -> DataFrame:
    """Second pass: cuts the stream of all documents' ids every `length` tokens; one row per piece of a document.

    Rows: doc_id, start (ids of the document before the piece), length, ids (binary, two little-endian bytes each),
    ids_crc32 (of the ids as 32-bit little-endian numbers), doc_tokens (with the end id), sequence_id, offset (in the
    sequence). These are the boundary records: a sequence is its pieces by offset. Only the last sequence is short.

    Null and empty texts are the end id alone. Documents follow the order in which the table is read; equal rows are
    packed once each. Nothing is shuffled but one total per partition; a document of any length is cut where it lies.
    An empty table gives no pieces. `tokenizer` is the path of a byte-level BPE file with fewer than 65,536 ids that
    every executor can read.
    """
    placed = numbered(tokenized(docs, tokenizer, end), "part", "before", "n_tokens", "at")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def each(_):
        def apply(doc_ids, places, rows):
            out: tuple[list, ...] = ([], [], [], [], [], [], [], [])
            for doc_id, at, row in zip(doc_ids, places, rows):
                ids = np.frombuffer(row, dtype="<u2")
                wide = memoryview(ids.astype("<u4").tobytes())
                begin = 0
                while begin < len(ids):
                    sequence, offset = divmod(at + begin, length)
                    take = min(length - offset, len(ids) - begin)
                    piece = (doc_id, begin, take, row[2 * begin: 2 * (begin + take)],
                             zlib.crc32(wide[4 * begin: 4 * (begin + take)]), len(ids), sequence, offset)
                    for column, value in zip(out, piece):
                        column.append(value)
                    begin += take
            return out
        return apply

    return map_rows(placed.select("doc_id", "at", "ids"), each,
                    f"doc_id {kind}, start bigint, length bigint, ids binary, ids_crc32 bigint, doc_tokens bigint, "
                    "sequence_id bigint, offset bigint")


def sequences(pieces: DataFrame) -> DataFrame:
    """One row per sequence: its ids and the records (offset, length, doc_id, start) of the pieces in it.

    A group is one sequence, at most as many pieces as it has tokens.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "length", "doc_id", "start", "ids")))
    return pieces.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id",
        F.expr("aggregate(parts, cast('' as binary), (a, p) -> concat(a, p.ids))").alias("ids"),
        F.expr("transform(parts, p -> named_struct('offset', p.offset, 'length', p.length, 'doc_id', p.doc_id, "
               "'start', p.start))").alias("boundaries"))
