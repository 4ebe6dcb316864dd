"""Content-defined chunks: cuts that resist shifts, repeated passages, nothing lost."""

import random

import numpy as np
import pytest

from relstream.llm import chunks as C
from relstream.llm.chunks import cuts, repeated_passages, without_passages


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9))) for _ in range(n))


def plain_cuts(data):
    """One byte after the other."""
    ends, last, h = [], 0, 0
    for k, byte in enumerate(data, 1):
        h = (2 * h + int(C.GEAR[byte])) % 2**32
        if k - last > C.MOST:
            last += C.MOST
            ends.append(last)
        if h < 2**32 // C.MEAN and k - last >= C.LEAST:
            ends.append(k)
            last = k
    while len(data) - last > C.MOST:
        last += C.MOST
        ends.append(last)
    return ends + [len(data)] * (last < len(data))


@pytest.mark.parametrize("seed", range(25))
def test_doublings_equal_the_rolling_hash(seed):
    rng = random.Random(seed)
    data = bytes(rng.choice([rng.randrange(256), 97]) for _ in range(rng.randrange(0, 4000)))
    ends = cuts(data) if data else []
    assert ends == plain_cuts(data)
    assert all(C.LEAST <= n <= C.MOST for n in np.diff([0, *ends])[:-1])


def test_an_insertion_moves_few_cuts():
    rng = random.Random(1)
    data = words(rng, 3000).encode()
    moved = data[:5000] + b"inserted" + data[5000:]
    before, after = set(cuts(data)), {e - 8 if e > 5008 else e for e in cuts(moved)}
    assert len(before - after) <= 6


def test_passages_are_found_wherever_they_stand(documents):
    rng = random.Random(2)
    passages = [words(rng, 60) for _ in range(30)]
    texts = {i: words(rng, rng.randrange(0, 90)) + " " + passages[i % 30] + " " + words(rng, rng.randrange(0, 90)) for i in range(60)}
    texts |= {100 + i: words(rng, 150) for i in range(40)}
    found = repeated_passages(documents(texts)).collect()
    assert {r["doc_id"] for r in found} == set(range(30, 60))
    for r in found:
        data = texts[r["doc_id"]].encode()[r["begin"]: r["begin"] + r["size"]]
        assert r["first_doc_id"] == r["doc_id"] - 30 and data in texts[r["doc_id"] - 30].encode()


def plain_passages(texts):
    """(doc_id, begin, end) of every window that occurs at an earlier place, window by window."""
    first, later = {}, set()
    for doc_id in sorted(texts):
        data = texts[doc_id].encode()
        ends = cuts(data) if data else []
        for begin, end in zip([0, *ends], ends[C.WINDOW - 1:] or ends[-1:]):
            if first.setdefault(data[begin:end], (doc_id, begin)) != (doc_id, begin):
                later.add((doc_id, begin, end))
    return later


def test_each_passage_stands_at_its_source_and_all_windows_are_in_one(documents):
    rng = random.Random(7)
    pool = [words(rng, n) for n in (8, 15, 30, 60, 120)]
    texts = {i: " ".join(rng.choice([words(rng, 12), rng.choice(pool)]) for _ in range(rng.randrange(0, 9))) for i in range(120)}
    found = repeated_passages(documents(texts), passage=1).collect()
    for r in found:
        data = texts[r["doc_id"]].encode()[r["begin"]: r["begin"] + r["size"]]
        source = texts[r["first_doc_id"]].encode()[r["first_begin"]: r["first_begin"] + r["size"]]
        assert data == source and (r["first_doc_id"], r["first_begin"]) < (r["doc_id"], r["begin"])
    expected = plain_passages(texts)
    covered = {w for w in expected for r in found if r["doc_id"] == w[0] and r["begin"] <= w[1] and w[2] <= r["begin"] + r["size"]}
    assert covered == expected and expected
    marked = {(w[0], k) for w in expected for k in range(w[1], w[2])}
    assert {(r["doc_id"], k) for r in found for k in range(r["begin"], r["begin"] + r["size"])} == marked


def test_cutting_keeps_one_copy_of_everything(documents):
    rng = random.Random(3)
    shared = words(rng, 200)
    texts = {1: shared, 2: "é" + shared + " tail", 3: shared, 4: words(rng, 50)}
    docs = documents(texts, extra=("begin",))
    lean = {r["doc_id"]: r["text"] for r in without_passages(docs, repeated_passages(docs)).collect()}
    assert lean[1] == shared and lean[4] == texts[4] and lean[3] == "" and lean[2].startswith("é") and len(lean[2]) < 150


def test_odd_rows(documents):
    rng = random.Random(4)
    text = words(rng, 100)
    docs = documents([(1, text), (1, text), (2, None), (3, ""), (None, text), (4, "short"), (5, "a" * 3000)])
    found = repeated_passages(docs).collect()
    assert {r["doc_id"] for r in found} == {5}  # repeated within itself
    assert repeated_passages(documents([])).collect() == []


def test_rows_that_share_an_id_are_read_and_cut_each_by_itself(documents):
    rng = random.Random(8)
    shared, other = words(rng, 120), words(rng, 120)
    docs = documents([(1, shared), (2, "head " + shared), (2, other), (2, None)])
    found = repeated_passages(docs)
    assert {r["begin"] + r["size"] for r in found.collect()} == {len("head " + shared)}
    lean = [r["text"] for r in without_passages(docs, found).collect()]
    assert other in lean and shared in lean and None in lean and len(lean) == 4
    assert sum(len(text or "") for text in lean) < len(shared) + len(other) + 60
