"""Periodic runs against a search of all lags, and odd texts."""

import random

import pytest

from relstream.llm.periodicity import LEAST, TIMES, find_runs, kept_words, periodic_runs


def all_lags(words):
    found, n = [], len(words)
    for lag in range(1, n // TIMES + 1):
        i = lag
        while i < n:
            j = i
            while j < n and words[j] == words[j - lag]:
                j += 1
            start, length = i - lag, j - i + lag
            if j > i and length >= max(LEAST, TIMES * lag):
                part = words[start:j]
                if next(p for p in range(1, lag + 1) if all(part[k] == part[k - p] for k in range(p, length))) == lag:
                    found.append((start, length, lag))
            i = max(j, i + 1)
    return sorted(found, key=lambda run: (run[0], run[2]))


@pytest.mark.parametrize("seed", range(8))
def test_against_all_lags(seed):
    rng, seen = random.Random(seed), 0
    for _ in range(200):
        words = []
        while len(words) < rng.randrange(1, 120):
            base = [rng.choice("abcd") for _ in range(rng.randrange(1, 10))]
            words += (base * rng.randrange(1, 9))[:rng.randrange(1, 60)]
        found = find_runs(words)
        assert found == all_lags(words)
        inside = {i for start, length, period in found for i in range(start + period, start + length)}
        assert kept_words(words, found) == [w for i, w in enumerate(words) if i not in inside]
        seen += len(found)
    assert seen > 100


@pytest.mark.parametrize("words, runs", [
    ([], []), (["a"] * 5, []), (["a"] * 6, [(0, 6, 1)]), (list("abababa"), []), (list("xabababab"), [(1, 8, 2)]),
    (list("aaaaaabbbbbb"), [(0, 6, 1), (6, 6, 1)]),
])
def test_small_runs(words, runs):
    assert find_runs(words) == runs


def test_a_million_equal_words_and_a_long_period():
    assert find_runs(["a"] * 1_000_000) == [(0, 1_000_000, 1)]
    period = [str(k) for k in range(70_000)]
    assert find_runs(["start"] + period * 5 + ["end"]) == [(1, 350_000, 70_000)]


def test_odd_rows(documents, spark):
    docs = documents([(1, "a b " * 6 + "end"), (1, "a b " * 6 + "end"), (2, None), (3, ""), (4, " \n\t"), (None, "x " * 9)], extra=("runs", "collapsed", "n_words"))
    got = sorted(((r["doc_id"] or 0, r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in periodic_runs(docs).collect()))
    assert got == [(0, 9, [(0, 9, 1)], "x"), (1, 13, [(0, 12, 2)], "a b end"), (1, 13, [(0, 12, 2)], "a b end"),
                   (2, 0, [], ""), (3, 0, [], ""), (4, 0, [], "")]
    assert periodic_runs(documents([])).collect() == []
    assert [r["collapsed"] for r in periodic_runs(documents({1: "é\xa0é " * 7})).collect()] == ["é\xa0é"]
