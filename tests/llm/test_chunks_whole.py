"""Repeated passages: every planted one of some 50 words is found, and most of its bytes."""

import random

from relstream.llm.chunks import repeated_passages


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9))) for _ in range(n))


def test_all_planted_passages_are_found(documents):
    rng = random.Random(5)
    passages = [words(rng, 51) for _ in range(200)]
    texts = {i: words(rng, rng.randrange(1, 60)) + " " + passages[i % 200] + " " + words(rng, rng.randrange(1, 60)) for i in range(400)}
    found = repeated_passages(documents(texts)).collect()
    assert {r["doc_id"] for r in found} == set(range(200, 400))
    share = sum(r["size"] for r in found) / sum(map(len, passages))
    print("share", share)
    assert share > 0.75
