"""Periodic runs of words: a sparse dynamic program over diagonals, by levels of lag.

On the diagonal of lag d lie the pairs (i - d, i) of equal words; a stretch of m neighbouring pairs on it is a run of
m + d words with period d. For each word its earlier occurrences say which diagonals grow there. Of a word that occurs a
thousand times most diagonals die at once, so occurrences are told apart by what comes before them: level k, for lags
in (2^(k-1), 2^k], compares the last 2^k words instead of one. A run of period d has at least 4 d words, more than 2^k + d,
so it shows on its level; and within it the *latest* earlier occurrence of those 2^k >= d words lies exactly d back: one
nearer by would, with d, give the run a smaller period. So every level has one active diagonal for a word, the sum of all
work is n log n whatever repeats, and a diagonal that ends gives its run at once, with its smallest period.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relstream.llm.common import WORD, map_rows

_WORD = re.compile(WORD.encode())
#: A run has at least this many words, and at least this many times its period.
LEAST, TIMES = 6, 4


def _symbols(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, bool]:
    """Equal keys get equal small numbers; the place of each key's latest earlier occurrence, or -1; whether any repeats."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    before = np.full(len(keys), -1, dtype=np.int64)
    before[order[1:][same]] = order[:-1][same]
    numbers = np.empty(len(keys), dtype=np.int64)
    numbers[order] = np.concatenate([[0], np.cumsum(~same)])
    return numbers, before, bool(same.any())


def find_runs(words: list) -> list[tuple[int, int, int]]:
    """(start, length, period) of every maximal run, by start, then period.

    Periods are the smallest ones; a run has at least `LEAST` words and `TIMES` periods.
    """
    n, found = len(words), []
    if n < LEAST:
        return found
    codes: dict = {}
    keys = np.fromiter((codes.setdefault(word, len(codes)) for word in words), dtype=np.int64, count=n)
    if len(codes) == n:
        return found
    width = 1  # words compared on this level; keys[i] stands for the words i to i + width - 1
    while width // 2 < n // TIMES:
        keys, before, repeats = _symbols(keys)
        if not repeats:
            break
        lags = np.arange(len(keys)) - before
        lags[(before < 0) | (lags > width) | (2 * lags <= width)] = 0
        # Diagonals: stretches of equal lags.
        ends = np.flatnonzero(np.concatenate([lags[1:] != lags[:-1], [True]]))
        begins = np.concatenate([[0], ends[:-1] + 1])
        period = lags[begins]
        length = period + ends - begins + width
        enough = (period > 0) & (length >= np.maximum(LEAST, TIMES * period))
        found += zip((begins - period)[enough].tolist(), length[enough].tolist(), period[enough].tolist())
        if len(keys) <= width:
            break
        keys = keys[:-width] * len(keys) + keys[width:]
        width *= 2
    return sorted(found, key=lambda run: (run[0], run[2]))


def kept_words(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words that no run contains after its first period."""
    if not runs:
        return words
    depth = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()]


def _each(_):
    def apply(doc_ids, texts):
        counts, runs, lean = [], [], []
        for text in texts:
            words = _WORD.findall(text) if text else []
            found = find_runs(words)
            counts.append(len(words))
            runs.append([{"start": s, "length": n, "period": p} for s, n, p in found])
            lean.append(b" ".join(kept_words(words, found)).decode("utf-8", "replace"))
        return doc_ids, counts, runs, lean
    return apply


def periodic_runs(docs: DataFrame, text: str | Column = "text") -> DataFrame:
    """doc_id, n_words, runs (start, length, period; words are numbered from 0) and `collapsed`, one row per row of `docs`.

    `collapsed` is the text with every run cut down to its first period, its words parted by one blank. A null or blank text
    has no words, no runs and an empty `collapsed`. Runs may overlap; each is given. Repeated rows and rows without a doc_id
    are treated one by one; an empty table gives an empty one; other columns of `docs`, whatever their names, are left out. A text is held
    by one task, with some 100 bytes a word.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", (F.col(text) if isinstance(text, str) else text).cast("binary").alias("text"))
    return map_rows(rows, _each, f"doc_id {kind}, n_words bigint, "
                                 "runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string")
