"""Spelling variants of a corpus' words: a trie over letter-group counts, searched with one surplus and one deficit.

A word's frequency vector counts its letters in eight groups. An inserted letter adds one to one count, a deleted letter takes
one away, a replaced one may do both: words that differ by one edit lie within a surplus of one and a deficit of one.

1. Words are counted over all documents, in each task first.
2. The trie's levels are the counts, one group after the other. Its upper levels are cut across the cluster: all words whose
   first `CUT` counts agree are one subtree, and a word is sent, as a question, to each subtree that exists within its
   budget. A subtree with more than `PART` words is searched in parts.
3. A task builds one subtree's trie at a time and searches it depth first for every question. At a leaf all words have the
   same vector and so the same length; of two words that are one edit apart either the first half or the last half is the
   same, which leads to the few that are compared.
4. A question's answers (how many are near, and which of them is commonest) are summed over its subtrees.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relstream.llm.common import grouped_rows, map_rows, stored

#: Letters that a word is made of; runs below the least length cannot become words.
_LETTERS = "A-Za-zÀ-ÿ"
#: Letters of about equal share in European text; the last group is all others.
GROUPS = ("e", "ai", "no", "rt", "sl", "cdu", "bfghmp")
LEVELS = len(GROUPS) + 1
#: Least length of a word, least occurrences, and how many times as common a word's form is.
LENGTH, OCCURRENCES, TIMES = 6, 5, 5
#: Counts that name a subtree, and words of a subtree that one task holds.
CUT, PART = 3, 20_000
#: Different words that a task counts before it passes them on.
_COUNTED = 200_000
_GROUP = {letter: k for k, group in enumerate(GROUPS) for letter in group}


def vector(word: str) -> tuple[int, ...]:
    counts = [0] * LEVELS
    for letter in word:
        counts[_GROUP.get(letter, LEVELS - 1)] += 1
    return tuple(counts)


def near(a: str, b: str) -> bool:
    """Whether the words differ by exactly one inserted, deleted or replaced letter."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + (len(a) == len(b)):] == b[k + 1:]


class Leaf:
    """Words of one vector, found by their first or last letters."""

    def __init__(self):
        self.words: list[tuple[str, int]] = []
        self._halves: dict[int, dict] = {}

    def like(self, word: str) -> Iterable[tuple[str, int]]:
        if len(self.words) < 8:
            return self.words
        half = min(len(word), len(self.words[0][0])) // 2
        if half not in self._halves:
            index = self._halves[half] = {}
            for entry in self.words:
                index.setdefault((0, entry[0][:half]), []).append(entry)
                index.setdefault((1, entry[0][-half:]), []).append(entry)
        index = self._halves[half]
        return dict(index.get((0, word[:half]), []) + index.get((1, word[-half:]), [])).items()


class Trie:
    """Words under their successive counts from level `first` on."""

    def __init__(self, first: int):
        self.first, self.root = first, {}

    def add(self, word: str, n: int) -> None:
        node, counts = self.root, vector(word)
        for count in counts[self.first:-1]:
            node = node.setdefault(count, {})
        node.setdefault(counts[-1], Leaf()).words.append((word, n))

    def search(self, word: str, surplus: int, deficit: int) -> Iterator[tuple[str, int]]:
        """Words within one edit whose counts exceed the word's by `surplus` at most and fall short by `deficit`, in all."""
        counts = vector(word)
        stack = [(self.root, self.first, surplus, deficit)]
        while stack:
            node, level, more, less = stack.pop()
            if level == LEVELS:
                yield from (entry for entry in node.like(word) if near(word, entry[0]))
                continue
            count = counts[level]
            if (child := node.get(count)) is not None:
                stack.append((child, level + 1, more, less))
            if more and (child := node.get(count + 1)) is not None:
                stack.append((child, level + 1, 0, less))
            if less and (child := node.get(count - 1)) is not None:
                stack.append((child, level + 1, more, 0))


def altered(word: str, key: str) -> str:
    """A planted misspelling: of one word in 199, by the hash of `key`, one letter is left out."""
    h = zlib.crc32(key.encode("utf-8", "surrogatepass"))
    if h % 199:
        return word
    k = h % len(word)
    return word[:k] + word[k + 1:]


def word_counts(docs: DataFrame, text: str = "text", misspell: bool = False) -> DataFrame:
    """(word, n) of all words; `misspell` leaves letters out as `altered` says, keyed by document and word."""
    runs = re.compile(f"[{_LETTERS}]{{{LENGTH},}}")

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()

        def given() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_pydict({"word": pa.array(list(found), pa.string()),
                                                "n": pa.array(list(found.values()), pa.int64())})
            found.clear()
            return batch

        for batch in batches:
            for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not value:
                    continue
                # Bytes know A-Z alone as letters.
                words = Counter(runs.findall(value.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")))
                if misspell and doc_id is not None:
                    prefix = zlib.crc32(f"{doc_id}:".encode())
                    for word in [word for word in words if zlib.crc32(word.encode(), prefix) % 199 == 0]:
                        found[altered(word, f"{doc_id}:{word}")] += words.pop(word)
                found.update(words)
                if len(found) >= _COUNTED:
                    yield given()
        yield given()

    counted = docs.select("doc_id", text).mapInArrow(count, "word string, n bigint")
    return counted.where(F.length("word") >= LENGTH).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= OCCURRENCES)


def neighbours(counts: tuple[int, ...]) -> list[tuple[tuple[int, ...], int, int]]:
    """Counts within one surplus and one deficit, with what is left of both budgets."""
    out = [((), 1, 1)]
    for count in counts:
        out = [(head + (count + step,), more - (step > 0), less - (step < 0)) for head, more, less in out
               for step in (0, 1, -1) if (step <= 0 or more) and (step >= 0 or less) and count + step >= 0]
    return out


def _subtrees(words: DataFrame) -> DataFrame:
    """Words with `node`, their first counts as a text."""
    def each(_):
        return lambda found, n: (found, n, [".".join(map(str, vector(word)[:CUT])) for word in found])
    return map_rows(words.select("word", "n"), each, "word string, n bigint, node string")


def _bridges(nodes: DataFrame) -> DataFrame:
    """(node, to, more, less): the subtrees to which a subtree's words may have to be sent as questions."""
    def each(_):
        def apply(found):
            rows = [(node, ".".join(map(str, head)), more, less) for node in found
                    for head, more, less in neighbours(tuple(map(int, node.split("."))))]
            return [list(column) for column in zip(*rows)] or [[], [], [], []]
        return apply
    return map_rows(nodes.select("node"), each, "node string, to string, more int, less int")


def _answers(group: pd.DataFrame) -> pd.DataFrame:
    """For one part of a subtree: its questions with the number of near words and the commonest."""
    trie = Trie(CUT)
    here = group["more"].isna()
    for word, n in zip(group["word"][here], group["n"][here]):
        trie.add(word, n)
    asked = group[~here]
    out = []
    for word, more, less in zip(asked["word"], asked["more"], asked["less"]):
        best, count = None, 0
        for other, n in trie.search(word, int(more), int(less)):
            count += 1
            if best is None or (-n, other) < best:
                best = (-n, other)
        if count:
            out.append((word, count, best[0], best[1]))
    return pd.DataFrame(out, columns=["word", "n_near", "rank", "other"]).astype({"n_near": "int64", "rank": "int64"})


def near_words(words: DataFrame, part: int = PART) -> DataFrame:
    """(word, n_near, other, other_n): how many words are near, and the commonest of them (ties: the smallest), where there are any."""
    placed = stored(_subtrees(words), "subtrees")
    nodes = stored(placed.groupBy("node").agg(F.ceil(F.count("*") / part).cast("int").alias("parts")), "nodes")
    own = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    none = F.lit(None).cast("int")
    indexed = placed.join(nodes, "node").select("node", own.alias("part"), "word", "n", none.alias("more"), none.alias("less"))
    bridges = _bridges(nodes).join(nodes.withColumnRenamed("node", "to"), "to")
    asked = placed.join(bridges, "node").select(F.col("to").alias("node"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
                                                "word", "n", "more", "less")
    rows = indexed.unionAll(asked)
    found = grouped_rows(rows, ["node", "part"], _answers, "word string, n_near bigint, rank bigint, other string")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct("rank", "other")).alias("best")) \
        .select("word", "n_near", F.col("best.other").alias("other"), (-F.col("best.rank")).alias("other_n"))


def spelling_groups(words: DataFrame, part: int = PART) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each row of `words` (word, n).

    The form is the commonest near word if it is `TIMES` times as common, the root is where following forms ends. A form is
    commoner than its word, so that the way to a root has some log(largest n) steps, and pointers are doubled: every round
    halves the way. Words without near words have null forms and are their own root. `words` has one row a word, of at least
    `LENGTH` letters; other columns are left out, an empty table gives an empty one.
    """
    known = stored(near_words(words, part), "near-words")
    formed = stored(
        words.select("word", "n").join(known, "word", "left")
        .withColumn("form", F.when(F.col("other_n") >= TIMES * F.col("n"), F.col("other")))
        .select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "form",
                F.when(F.col("form").isNotNull(), F.col("other_n")).alias("form_n")), "forms")
    hops = formed.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    while True:
        hops = stored(hops, "hops")
        step = hops.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = hops.join(step, "root")
        if further.isEmpty():
            break
        hops = hops.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    return formed.join(hops, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spellings(docs: DataFrame, text: str = "text", misspell: bool = False, part: int = PART) -> DataFrame:
    """The spelling groups of all words of `docs`. Null and empty texts have no words; repeated rows count again."""
    return spelling_groups(stored(word_counts(docs, text, misspell), "words"), part)
