"""Benchmark decontamination: test items found in documents, with a few edits, by exact pieces and Myers' bit vectors."""

from __future__ import annotations

import math
import re
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relstream.llm.common import map_rows

_WORD = re.compile(r"\w+")
#: Edits allowed per character of an item: one in twenty, so that pieces keep some 19 characters.
ERROR_RATE = 0.05
#: Items of one pass, in characters of normalised text; bounds the broadcast and the pieces' automaton (about 100 MB).
BLOCK_CHARS = 1_000_000


def normal(text: str | None) -> str:
    """Words in lower case, one blank between them: case, punctuation and line breaks do not matter."""
    return " ".join(_WORD.findall(text)).lower() if text else ""


def budget(item: str, rate: float = ERROR_RATE) -> int:
    return int(len(item) * rate)


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """The item in errors + 1 parts of nearly equal length, with their offsets: with so many edits one part is intact."""
    parts = errors + 1
    cuts = [len(item) * k // parts for k in range(parts + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:]) if b > a]


def best_match(pattern: str, text: str) -> tuple[int, int]:
    """The fewest edits that turn `pattern` into some substring of `text`, and where the first such substring ends.

    Myers' algorithm: a column of the distance matrix is two bit vectors of its vertical differences, held here as whole
    numbers of any length.
    """
    size = len(pattern)
    ones, top = (1 << size) - 1, 1 << (size - 1)
    at: dict[str, int] = {}
    for k, character in enumerate(pattern):
        at[character] = at.get(character, 0) | 1 << k
    up, down, distance = ones, 0, size
    best, end = size, 0
    for position, character in enumerate(text, 1):
        equal = at.get(character, 0)
        diagonal = (((equal & up) + up) ^ up) | equal | down
        rises = down | (ones & ~(diagonal | up))
        falls = up & diagonal
        if rises & top:
            distance += 1
        elif falls & top:
            distance -= 1
        if distance < best:
            best, end = distance, position
        rises = (rises << 1) & ones
        falls = (falls << 1) & ones
        up = falls | (ones & ~((equal | down) | rises))
        down = rises & (equal | down)
    return best, end


class Matcher:
    """Finds items in normalised texts."""

    def __init__(self, items: tuple[tuple[int, str], ...], rate: float = ERROR_RATE):
        import ahocorasick
        self.items = {k: (item_id, text, budget(text, rate)) for k, (item_id, text) in enumerate(items) if text}
        places: dict[str, list[tuple[int, int]]] = {}
        for k, (_, text, errors) in self.items.items():
            for offset, piece in pieces(text, errors):
                places.setdefault(piece, []).append((k, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        if places:
            self.automaton.make_automaton()

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """item_id, begin, end and edits of all matches in a normalised text; those of one item do not overlap.

        An item too short for an edit is found as whole words only.
        """
        starts: dict[int, set[int]] = {}
        if self.items and text:
            for end, (length, where) in self.automaton.iter(text):
                for k, offset in where:
                    starts.setdefault(k, set()).add(end + 1 - length - offset)
        found = []
        for k, guesses in starts.items():
            item_id, item, errors = self.items[k]
            if not errors:
                free = 0
                for guess in sorted(guesses):
                    end = guess + len(item)
                    if guess >= free and text[guess - 1:guess] in ("", " ") and text[end:end + 1] in ("", " "):
                        found.append((item_id, guess, end, 0))
                        free = end
                continue
            stretch: list[int] = []
            for guess in [*sorted(guesses), math.inf]:
                if stretch and guess - stretch[-1] > len(item):
                    low = max(stretch[0] - errors, 0)
                    found += self._within(text, low, stretch[-1] + len(item) + errors, stretch, *self.items[k])
                    stretch = []
                stretch.append(guess)
        return sorted(found, key=lambda m: (m[1], m[2], m[0]))

    @staticmethod
    def _within(text: str, low: int, high: int, guesses: list[int], item_id: int, item: str, errors: int) -> list[tuple[int, int, int, int]]:
        """The best match between two places, and those before and after it where pieces were hit too."""
        found, todo = [], [(low, min(high, len(text)), guesses)]
        while todo:
            low, high, guesses = todo.pop()
            if not guesses or high - low < len(item) - errors:
                continue
            edits, end = best_match(item, text[low:high])
            if edits > errors:
                continue
            # The same search backwards from the end gives the beginning.
            _, back = best_match(item[::-1], text[low:low + end][::-1])
            begin, end = low + end - back, low + end
            found.append((item_id, begin, end, edits))
            todo.append((low, begin, [g for g in guesses if g + len(item) <= begin + errors]))
            todo.append((end, high, [g for g in guesses if g >= end - errors]))
        return found


@lru_cache(maxsize=1)
def _matcher(items: tuple[tuple[int, str], ...], rate: float) -> Matcher:
    return Matcher(items, rate)


def spans(text: str | None, matcher: Matcher) -> list[dict]:
    """Matches with begin and end in code points of the text as it is, at word borders."""
    found = matcher.find(normal(text))
    if not found:
        return []
    borders, at = [], 0
    for word in _WORD.finditer(text):
        borders.append((at, word.start(), word.end()))
        at += len(word.group().lower()) + 1
    starts = [b[0] for b in borders]
    from bisect import bisect_right
    return [{"item_id": item_id, "begin": borders[bisect_right(starts, a) - 1][1], "end": borders[max(bisect_right(starts, b - 1) - 1, 0)][2],
             "edits": edits} for item_id, a, b, edits in found]


_MATCH = "struct<item_id:bigint,begin:bigint,end:bigint,edits:int>"


def item_blocks(benchmark: DataFrame, limit: int = BLOCK_CHARS) -> int:
    """How many passes the items need; one, unless they have more than `limit` characters."""
    total = benchmark.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    return max(1, math.ceil(total / limit))


def with_matches(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE, limit: int = BLOCK_CHARS,
                 text: str = "text") -> DataFrame:
    """`docs` with `matches`: an array of item_id, begin, end, edits. A column of that name is replaced.

    An item is found where some stretch of the document is at most one edit per twenty characters away from it, both
    normalised; all such stretches that do not overlap count, of items below 20 characters whole words only. Items are dealt out by a hash to as many blocks as their size asks
    for; each block is broadcast and meets every document, whole and in place: nothing is shuffled. Null and empty texts
    have no matches, null and empty items (or such without a word) match nothing, equal items are found each. An empty
    table on either side is no error.
    """
    items = benchmark.select("item_id", "text").where(F.col("text").isNotNull())
    blocks = item_blocks(items, limit)
    context = docs.sparkSession.sparkContext
    carried = [f for f in docs.schema if f.name.lower() != "matches" and f.name != text]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in carried), f"`{text}` string, matches array<{_MATCH}>"])
    out = docs.select(*(F.col(f"`{f.name}`") for f in carried), F.col(f"`{text}`"), F.expr(f"cast(array() as array<{_MATCH}>)").alias("matches"))
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        shared = context.broadcast(tuple(sorted({(r.item_id, normal(r.text)) for r in rows if r.item_id is not None})))

        def each(_, shared=shared):
            matcher = _matcher(shared.value, rate)

            def apply(*columns):
                return *columns[:-1], [[*before, *spans(value, matcher)] for value, before in zip(columns[-2], columns[-1])]
            return apply

        out = map_rows(out, each, schema, _matcher.cache_clear)
    return out


def decontaminated(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE) -> DataFrame:
    """The documents without a match, with the columns they came with."""
    return with_matches(docs, benchmark, rate).where(F.size("matches") == 0).select(*(c for c in docs.columns))
