"""Quality rules by repetition: how much of a text lies inside n-grams and lines that it repeats."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relstream.llm.common import WORD, map_rows

_WORD = re.compile(WORD)
_SYMBOLS = "#*$%&|<>"
#: Window of the base rule, in words.
_BASE_WINDOW = 8
#: Fixed multiplier of the rolling hash: odd, with mixed bits.
_STEP = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class RepetitionRules:
    """Greatest shares, in percent, of a text's word characters that may lie inside repeated n-grams and lines.

    The limits are whole percents, so that they can be compared without rounding.
    """

    ngrams: dict[int, int] = field(default_factory=lambda: {5: 40, 8: 32, 10: 30})
    line_chars: int = 40

    @property
    def columns(self) -> list[str]:
        return [f"dup{n}_chars" for n in self.ngrams]


def repeated(hashes: np.ndarray, n: int) -> np.ndarray:
    """Which words lie inside an n-word window that occurs at least twice."""
    size = len(hashes)
    inside = np.zeros(size, dtype=bool)
    if size <= n:
        return inside
    rolled = hashes[: size - n + 1].copy()
    for k in range(1, n):
        rolled *= _STEP
        rolled += hashes[k: size - n + 1 + k]
    order = np.argsort(rolled, kind="stable")
    ranked = rolled[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return inside
    twice = np.zeros(len(rolled), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edges = np.zeros(size + 1, dtype=np.int64)
    starts = np.flatnonzero(twice)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + n, -1)
    return np.cumsum(edges[:-1]) > 0


def measure(text: str | None, ngrams: tuple[int, ...]) -> list[int]:
    """Words, word characters, symbols, repeated lines, words in repeated 8-word windows, characters in repeated lines,
    then for each n-gram length the characters of words in repeated n-grams."""
    if not text:
        return [0] * (6 + len(ngrams))
    words = _WORD.findall(text)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    hashes = np.fromiter(map(hash, words), dtype=np.int64, count=len(words)).view(np.uint64)
    # Two windows of n words can be equal only if some word occurs twice.
    varied = len(set(words)) == len(words)
    seen: set[str] = set()
    lines = line_chars = 0
    for line in text.split("\n"):
        if line in seen:
            chars = sum(map(len, _WORD.findall(line)))
            lines += chars > 0
            line_chars += chars
        seen.add(line)
    inside = {n: np.zeros(len(words), dtype=bool) if varied else repeated(hashes, n) for n in {_BASE_WINDOW, *ngrams}}
    return [len(words), int(lengths.sum()), sum(map(text.count, _SYMBOLS)), lines, int(inside[_BASE_WINDOW].sum()), line_chars,
            *(int(lengths[inside[n]].sum()) for n in ngrams)]


def repetition_rules(docs: DataFrame, rules: RepetitionRules = RepetitionRules(), text: str = "text") -> DataFrame:
    """Adds the counts of `measure`, `base_failed` and `kept` to each row; columns of these names are replaced.

    A row fails the base rule with fewer than 20 words, or with more than 30 % of its words in 8-word windows that occur
    twice. It is kept if it passes that and stays within `rules`. Null and empty texts have no words and fail. Rows are
    judged one by one, so equal rows get equal verdicts; the order of rows does not matter. An empty table gives an
    empty one. Windows are compared by 64-bit rolling hashes of their words.
    """
    ngrams = tuple(rules.ngrams)
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars", *rules.columns]
    added = {*counts, "base_failed", "kept"}
    carried = [c for c in docs.columns if c.lower() not in added and c != text]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in carried),
                        f"`{text}` string", *(f"{c} bigint" for c in counts)])

    def each(_):
        def apply(*columns):
            found = [measure(value, ngrams) for value in columns[-1]]
            return [*columns, *([row[k] for row in found] for k in range(len(counts)))]
        return apply

    measured = map_rows(docs.select(*(F.col(f"`{c}`") for c in carried), F.col(f"`{text}`")), each, schema)
    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    within = 100 * F.col("dup_line_chars") <= rules.line_chars * F.col("word_chars")
    for n, limit in rules.ngrams.items():
        within &= 100 * F.col(f"dup{n}_chars") <= limit * F.col("word_chars")
    return measured.withColumn("base_failed", base).withColumn("kept", ~base & within)
