"""Counts of repeated n-grams and lines against plain counting."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from relstream.llm.repetition import RepetitionRules, measure, repeated, repetition_rules


def brute(words, n):
    windows = [tuple(words[i: i + n]) for i in range(len(words) - n + 1)]
    counts = Counter(windows)
    inside = set()
    for i, window in enumerate(windows):
        if counts[window] > 1:
            inside.update(range(i, i + n))
    return inside


@pytest.mark.parametrize("seed", range(30))
def test_counts_against_brute_force(seed):
    rng = random.Random(seed)
    vocabulary = ["a", "bé", "c#", "d|d", "𝄞"][: rng.randrange(1, 6)]
    text = "".join(rng.choice(vocabulary) + rng.choice([" ", " ", "\n", "\t ", " "]) for _ in range(rng.randrange(0, 160)))
    words = re.findall("[^\x20\x09-\x0d]+", text)
    seen, lines = set(), 0
    for line in text.split("\n"):
        lines += line in seen and bool(re.search("[^\x20\x09-\x0d]", line))
        seen.add(line)
    got = measure(text, (2, 5))
    assert got[:5] == [len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), lines, len(brute(words, 8))]
    assert got[6:] == [sum(len(words[i]) for i in brute(words, n)) for n in (2, 5)]


def test_windows_shorter_than_the_text_only():
    assert not repeated(np.arange(5, dtype=np.uint64), 8).any()


def test_verdicts_and_odd_rows(spark, documents):
    clean = " ".join(f"w{i}" for i in range(60))
    texts = [(1, clean), (2, "a b c"), (3, "same words here " * 20), (4, None), (5, ""), (1, clean), (None, clean),
             (6, "\n".join(["one whole line that is there twice"] * 2 + [clean]))]
    rows = repetition_rules(documents(texts, extra=("kept", "n_words"))).collect()
    verdicts = sorted((r["doc_id"] or 0, r["base_failed"], r["kept"], r["n_words"]) for r in rows)
    assert verdicts == [(0, False, True, 60), (1, False, True, 60), (1, False, True, 60), (2, True, False, 3), (3, True, False, 60),
                        (4, True, False, 0), (5, True, False, 0), (6, False, True, 74)]
    assert rows[0]["lang"] == "en"
    assert repetition_rules(documents([])).collect() == []


def test_stricter_rules_keep_less(documents):
    half = " ".join(f"w{i}" for i in range(40)) + " five words that come twice five words that come twice"
    kept = lambda limit: repetition_rules(documents({1: half}), RepetitionRules({5: limit}, 100)).first()["kept"]
    assert kept(40) and not kept(5)


def test_a_very_long_text():
    words = [f"w{i}" for i in range(300_000)]
    assert measure(" ".join(words), (5,))[4] == 0
    assert measure(" ".join(words + words), (5,))[4] == 600_000
