"""Spelling groups against all pairs, and what is a word."""

import random

import pytest

from relstream.llm.spellings import Trie, near, spelling_groups, vector, word_counts

LETTERS = "abeénst"


def edited(word):
    cut = {word[:i] + word[i + 1:] for i in range(len(word))}
    put = {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in LETTERS}
    swapped = {word[:i] + c + word[i + 1:] for i in range(len(word)) for c in LETTERS}
    return (cut | put | swapped) - {word}


def made(seed, size):
    rng, words = random.Random(seed), {}
    while len(words) < size:
        word = "".join(rng.choice(LETTERS) for _ in range(rng.randrange(6, 10)))
        for other in [word, *rng.sample(sorted(edited(word)), 3)]:
            if len(other) >= 6:
                words.setdefault(other, rng.choice([5, 6, 9, 30, 200, 2_000, 50_000]))
    return words


def expected(words):
    out = {}
    for word, n in words.items():
        others = sorted((-words[o], o) for o in edited(word) if o in words)
        form = others[0][1] if others and -others[0][0] >= 5 * n else None
        out[word] = (form, n, len(others), words[form] if form else None)
    roots = {}
    for word in words:
        at = word
        while out[at][0]:
            at = out[at][0]
        roots[word] = at
    return {w: (f, roots[w], n, k, m) for w, (f, n, k, m) in out.items()}


@pytest.mark.parametrize("part", [20_000, 3])
def test_against_all_pairs(spark, part):
    """The small part size splits every subtree."""
    words = made(part, 500)
    want = expected(words)
    df = spark.createDataFrame(list(words.items()), "word string, n bigint").repartition(3)
    got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in spelling_groups(df, part).collect()}
    assert got == want
    assert sum(f is not None for f, *_ in want.values()) > 50 and any(root != form for form, root, *_ in want.values() if form)


def test_leaves_with_many_words_of_one_vector():
    rng = random.Random(5)
    words = {"".join(rng.sample("abeént", 6)) for _ in range(400)} | {"".join(rng.sample("abeénts", 7)) for _ in range(2_000)}
    trie = Trie(0)
    for word in words:
        trie.add(word, 1)
    for word in rng.sample(sorted(words), 100):
        found = [w for w, _ in trie.search(word, 1, 1)]
        assert sorted(found) == sorted(edited(word) & words)


def test_near_is_one_edit():
    rng = random.Random(6)
    for _ in range(2_000):
        a, b = ("".join(rng.choice("ab") for _ in range(rng.randrange(1, 6))) for _ in range(2))
        plain = {a[:i] + a[i + 1:] for i in range(len(a))} | {a[:i] + c + a[i + k:] for i in range(len(a) + 1) for c in "ab" for k in (0, 1)}
        assert near(a, b) == near(b, a) == (b in plain - {a})
    assert sum(vector("éléphants")) == 9


def test_what_is_counted(documents):
    texts = [(1, "Élan-vital abcDEF " * 3), (1, "abcdef Abcdef"), (2, None), (3, ""), (None, "ABCDEF"), (4, "short " * 9), (5, "Œabcdef×gh " * 5)]
    got = {r["word"]: r["n"] for r in word_counts(documents(texts, extra=("word", "n"))).collect()}
    assert got == {"abcdef": 6, "abcdef×gh": 5}
    empty = word_counts(documents([]))
    assert empty.collect() == [] and spelling_groups(empty).collect() == []


def test_long_texts_and_many_words_pass_the_counter(documents, monkeypatch):
    words = ["".join("abcdefghij"[int(c)] for c in f"{k:07d}") for k in range(3_000)]
    got = {r["word"]: r["n"] for r in word_counts(documents({k: " ".join(words) for k in range(5)})).collect()}
    assert got == dict.fromkeys(words, 5)


def test_planted_misspellings(documents):
    import zlib
    text = "alphabet mountain telescope wonderful"
    docs = {k: text for k in range(2_000)}
    want = {}
    for k in docs:
        for word in text.split():
            h = zlib.crc32(f"{k}:{word}".encode())
            at = h % len(word)
            w = word if h % 199 else word[:at] + word[at + 1:]
            want[w] = want.get(w, 0) + 1
    got = {r["word"]: r["n"] for r in word_counts(documents(docs), misspell=True).collect()}
    assert got == {w: n for w, n in want.items() if n >= 5} and set(got) >= set(text.split())
