"""Near duplicates against all pairs."""

import random

import numpy as np
import pytest

from relstream.llm import minhash
from relstream.llm.graph import components
from relstream.llm.minhash import near_duplicates, one_of_each, shingles


def all_pairs(texts):
    """Smallest id by exact links; texts: [(id, text)]."""
    sets = [(d, set(shingles(t).tolist())) for d, t in texts if d is not None]
    parent = {d: d for d, _ in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for i, (a, x) in enumerate(sets):
        for b, y in sets[i + 1:]:
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {d: root(d) for d in parent}


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return " ".join(words)


def check(df, texts):
    rows = near_duplicates(df).collect()
    assert len(rows) == len(texts)
    expected = all_pairs(texts)
    for r in rows:
        if r["doc_id"] is not None:
            assert r["component_id"] == expected[r["doc_id"]], r
            assert r["kept"] == (r["doc_id"] == r["component_id"])
    sizes = {d: len(shingles(t)) for d, t in texts}
    assert all(r["n_shingles"] == sizes[r["doc_id"]] or len({t for d, t in texts if d == r["doc_id"]}) > 1 for r in rows)
    return expected


def test_groups_against_all_pairs(documents):
    rng = random.Random(3)
    texts, ids = [], iter(rng.sample(range(1000), 400))
    for _ in range(12):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(6, 220))]
        texts += [(next(ids), edited(rng, base, rng.randrange(0, 1 + len(base) // 25))) for _ in range(rng.randrange(1, 9))]
        texts += [(next(ids), " ".join(base))] * rng.randrange(0, 3)  # rows that repeat
    boiler = [f"b{k}" for k in range(30)]
    texts += [(next(ids), " ".join(boiler + [f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(1, 60))])) for _ in range(60)]
    texts += [(next(ids), None), (next(ids), ""), (next(ids), " \n "), (next(ids), "a b"), (next(ids), "A B"), (next(ids), "b a"), (None, "x y z")]
    expected = check(documents(texts, extra=("component_id", "rep")), texts)
    assert len(set(expected.values())) < len(expected)


def test_a_group_that_needs_several_blocks(documents, monkeypatch):
    """Copies of one base whose links are not all there: near the threshold, through others only."""
    monkeypatch.setattr(minhash, "BLOCK", 16)
    rng = random.Random(4)
    base = [f"w{k}" for k in range(150)]
    texts = [(i, edited(rng, base, 3 + i % 3)) for i in range(120)]
    check(documents(texts), texts)


def test_short_texts_link_with_equal_ones_only(documents):
    texts = [(1, "one two"), (2, "ONE  two"), (3, "one two three"), (4, "ÀB"), (5, "àB")]
    assert check(documents(texts), texts) == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5}


def test_one_id_with_two_texts_links_them(documents):
    a, b = (" ".join(f"{c}{k}" for k in range(40)) for c in "ab")
    rows = near_duplicates(documents([(5, a), (5, b), (7, a), (9, b), (8, a)])).collect()
    assert {(r["doc_id"], r["component_id"]) for r in rows} == {(5, 5), (7, 5), (9, 5), (8, 5)}


def test_one_document_of_each_group_stays(documents):
    text = " ".join(f"w{k}" for k in range(50))
    docs = documents([(3, text), (1, text + " more"), (2, "other"), (9, None), (None, text)], extra=("kept",))
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "2", "9", "None"]


def test_empty_table(documents):
    assert near_duplicates(documents([])).collect() == []


def test_links_at_the_threshold_are_exact():
    whole = np.arange(100, dtype=np.uint64)
    for cut in (75, 74):
        part = whole[:cut]
        found = list(minhash.block_links([whole, part], np.zeros((2, 64), dtype=np.uint64), np.zeros(2, dtype=int)))
        assert bool(found) == (cut == 75)


@pytest.mark.parametrize("shape", ["path", "star", "random", "none"])
def test_components(spark, shape):
    rng = random.Random(7)
    edges = {"path": [(i, i + 1) for i in range(60)], "star": [(0, i) for i in range(1, 80)], "none": [],
             "random": [(rng.randrange(90), rng.randrange(90)) for _ in range(70)]}[shape]
    rng.shuffle(edges)
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint"), "a", "b").collect()}
    parent = {n: n for e in edges for n in e if e[0] != e[1]}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        if a != b:
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    assert got == {n: root(n) for n in parent}
