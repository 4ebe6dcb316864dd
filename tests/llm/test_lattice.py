"""Lattice hashing: the decoder, recall against all pairs, split cells, odd rows."""

import itertools
import math

import numpy as np
import pytest

from relstream.llm import lattice
from relstream.llm.lattice import COSINE, decode, near_duplicates, roots

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def test_roots_and_decoder():
    found = roots()
    assert len({tuple(r) for r in found}) == 240 and np.allclose((found ** 2).sum(axis=1), 2)
    x = np.random.RandomState(3).normal(size=(300, 8)) * 2
    point = decode(x)
    assert np.all((2 * point) % 2 == (2 * point[:, :1]) % 2) and np.all(point.sum(axis=1) % 2 == 0)
    # No neighbour is nearer.
    nearest = ((x - point) ** 2).sum(axis=1)
    assert np.all(((x[:, None, :] - point[:, None, :] - found[None]) ** 2).sum(axis=2) >= nearest[:, None] - 1e-9)
    assert nearest.max() <= 1 + 1e-9  # the covering radius


def all_pairs(rows):
    """{id: (links, component)} for rows with different ids."""
    unit, links = {}, {i: set() for i, _, _ in rows}
    for i, vector, label in rows:
        if vector and label is not None and all(v is not None and math.isfinite(v) for v in vector) and any(vector):
            a = np.array(vector, dtype=np.float32).astype(np.float64)
            unit[i] = (label, a / np.sqrt(a @ a))
    for (i, (la, a)), (j, (lb, b)) in itertools.combinations(unit.items(), 2):
        if la == lb and len(a) == len(b) and a @ b >= COSINE:
            links[i].add(j)
            links[j].add(i)
    out = {}
    for i in links:
        reach, todo = {i}, [i]
        while todo:
            for other in links[todo.pop()] - reach:
                reach.add(other)
                todo.append(other)
        out[i] = (len(links[i]), min(reach))
    return out


def planted(seed, spread, copies=40, dims=64):
    rng, rows = np.random.RandomState(seed), []
    for base in range(30):
        centre = rng.normal(size=dims)
        centre /= np.sqrt(centre @ centre)
        for _ in range(copies if base == 0 else 4):
            noise = rng.normal(size=dims)
            rows.append((len(rows) * 7 % 1009, (centre + spread * noise / np.sqrt(noise @ noise)).tolist(), int(base % 3)))
    return rows


@pytest.mark.parametrize("spread", [0.05, 0.12, 0.14])
def test_recall_against_all_pairs(spark, spread):
    """At 0.14 half of the planted pairs lie a little above the threshold, half below."""
    rows = planted(int(spread * 100), spread)
    want = all_pairs(rows)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()}
    links = sum(n for n, _ in want.values())
    assert links > 400 and all(got[i][0] <= n for i, (n, _) in want.items())
    assert sum(n for n, _, _ in got.values()) >= 0.99 * links
    assert sum(got[i][1] != c for i, (_, c) in want.items()) <= 0.01 * len(want)
    assert all(kept == (i == component) for i, (_, component, kept) in got.items())


def test_cells_in_several_blocks_count_the_same(spark, monkeypatch):
    df = spark.createDataFrame(planted(9, 0.08, copies=90), SCHEMA).repartition(3)
    whole = sorted(near_duplicates(df).collect())
    monkeypatch.setattr(lattice, "BLOCK", 16)
    assert sorted(near_duplicates(df).collect()) == whole and max(r["n_links"] for r in whole) >= 80


def test_odd_rows(spark):
    a, b = [1.0, 0.0, 0.0, 1.0], [2.0, 0.001, 0.0, 2.0]
    rows = [(1, a, 1), (2, a, 1), (3, b, 1), (4, a, 2), (5, a, None), (6, None, 1), (7, [], 1), (8, [0.0] * 4, 1), (9, [float("nan"), 1.0, 1.0, 1.0], 1),
            (10, [None, 1.0, 1.0, 1.0], 1), (11, a + [0.0], 1), (3, b, 1), (None, a, 1), (12, [float("inf")] + a[1:], 1), (13, [-x for x in a], 1)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "vec_id AS id", "1 AS n", "'x' AS row", "2 AS rep", "3 AS component_id")
    got = sorted((r["vec_id"] or 0, r["n_links"], r["component_id"], r["kept"]) for r in near_duplicates(df).collect())
    assert got == [(0, 0, None, True), (1, 2, 1, True), (2, 2, 1, False), (3, 2, 1, False), (3, 2, 1, False),
                   *((i, 0, i, True) for i in range(4, 14))]
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_an_id_with_several_vectors_ties_them(spark):
    a, b = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    rows = [(1, a, 1), (5, a, 1), (5, b, 1), (7, b, 1), (5, b, 2), (9, b, 2)]
    got = {(r["vec_id"], r["n_links"], r["component_id"]) for r in near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {(1, 1, 1), (5, 1, 1), (7, 1, 1), (9, 1, 1)}


def test_doubles_are_compared_as_doubles(spark):
    rows = [(1, [1.0, 0.0], 1), (2, [0.98, math.sqrt(1 - 0.98 ** 2) - 1e-9], 1), (3, [-0.5, 0.8], 1)]
    got = {r["vec_id"]: r["n_links"] for r in near_duplicates(spark.createDataFrame(rows, SCHEMA.replace("float", "double"))).collect()}
    assert got == {1: 1, 2: 1, 3: 0}
