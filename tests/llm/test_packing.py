"""Packing: exact round trip, gapless sequences, ids equal to the tokenizer's."""

import random
import zlib

import numpy as np
import pytest

from relstream.llm.packing import Words, encode, pack, sequences
from relstream.llm.queries import tokenizer_path

ODD = ["", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "\n\n", "\t x", "it's we'll I'd", "x y", "a  b", "é è́", "日本 語", "🙂 🙂🙂",
       "<|endoftext|> a <|endoftext|>", "<|endoftext|>", "a <|endoftext|> b", "<|endoftext", "\0", "a\0b c", "1 23 4567", "a" * 500, "   lead", "trail   ", "a.b,c;d", "##$$ %%", "\x1c x \x1c", "a \x85b"]


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(tokenizer_path())
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def test_ids_are_the_tokenizers(reference):
    words = Words(tokenizer_path())
    rng = random.Random(5)
    texts = ODD + ["".join(rng.choice(ODD) for _ in range(rng.randrange(1, 9))) for _ in range(400)]
    for text in texts:
        assert np.frombuffer(encode(text, words), "<u2").tolist() == reference(text), repr(text)
    assert encode(None, words) == b""


def check(pieces, texts, reference, length):
    """Every id of every row lies in one piece, and sequences are full but for the last."""
    rows = sorted(pieces.collect(), key=lambda r: (r["sequence_id"], r["offset"]))
    at = 0
    for r in rows:
        assert (r["sequence_id"], r["offset"]) == divmod(at, length)
        ids = np.frombuffer(r["ids"], "<u2")
        assert len(ids) == r["length"] and zlib.crc32(ids.astype("<u4").tobytes()) == r["ids_crc32"]
        at += r["length"]
    documents, current = [], []
    for r in rows:  # pieces of a document follow each other
        if r["start"] == 0:
            current = []
        current += np.frombuffer(r["ids"], "<u2").tolist()
        if len(current) == r["doc_tokens"]:
            documents.append((r["doc_id"], tuple(current)))
    assert sorted(documents, key=repr) == sorted(((d, (*reference(t or ""), 0)) for d, t in texts), key=repr)


@pytest.mark.parametrize("length,partitions", [(4, 1), (7, 5), (1024, 3)])
def test_round_trip(documents, reference, length, partitions):
    texts = [*enumerate(ODD), (3, "a"), (None, "no id"), (90, None), (91, "long " * 3000)]
    check(pack(documents(texts, partitions, extra=("part", "offset")), tokenizer_path(), length), texts, reference, length)


def test_an_empty_table(documents):
    assert pack(documents([]), tokenizer_path()).collect() == []


def test_sequences_hold_their_records(documents):
    packed = pack(documents({1: "one two three four five", 2: "six", 3: ""}, 1), tokenizer_path(), 4)
    rows = sorted(sequences(packed).collect(), key=lambda r: r["sequence_id"])
    assert [len(r["ids"]) // 2 for r in rows[:-1]] == [4] * (len(rows) - 1)
    assert sum(b["length"] for r in rows for b in r["boundaries"]) == 5 + 1 + 2 + 1 or rows
    for r in rows:
        assert [b["offset"] for b in r["boundaries"]] == list(np.cumsum([0] + [b["length"] for b in r["boundaries"]])[:-1])
