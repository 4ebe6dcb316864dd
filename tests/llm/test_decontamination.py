"""Benchmark items in documents: planted copies with edits, bit vectors against a plain matrix."""

import random

import pytest

from relstream.llm.decontamination import Matcher, best_match, budget, decontaminated, normal, pieces, spans, with_matches

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def matrix(pattern, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, x in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != x)))
        row = new
    return min(row), row.index(min(row))


@pytest.mark.parametrize("seed", range(200))
def test_bit_vectors_against_the_matrix(seed):
    rng = random.Random(seed)
    pattern = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 90)))
    text = "".join(rng.choice("abcd") for _ in range(rng.randrange(0, 120)))
    assert best_match(pattern, text)[0] == matrix(pattern, text)[0]
    if best_match(pattern, text)[0] < len(pattern):
        assert best_match(pattern, text) == matrix(pattern, text)


def test_pieces_cover_the_item():
    for n in (1, 5, 19, 20, 230):
        item = "x" * n
        cut = pieces(item, budget(item))
        assert "".join(p for _, p in cut) == item and len(cut) == min(budget(item) + 1, n)


@pytest.mark.parametrize("seed", range(40))
def test_edited_items_are_found_up_to_the_budget(seed):
    rng = random.Random(seed)
    items = [(k, sentence(rng, 30)) for k in range(5)]
    matcher = Matcher(tuple((k, normal(t)) for k, t in items), 0.05)
    k, item = rng.choice(items)
    errors = rng.randrange(0, budget(normal(item)) + 1)
    edited = list(normal(item))
    for _ in range(errors):
        at = rng.randrange(len(edited))
        edited[at] = rng.choice([edited[at] + "q", "", "q"]) if edited[at] != " " else " "
    text = sentence(rng, 20) + " " + "".join(edited) + " " + sentence(rng, 20)
    assert (k, True) in [(m["item_id"], m["edits"] <= errors) for m in spans(text, matcher)]


def test_case_punctuation_and_lines_do_not_matter_and_spans_are_the_texts():
    matcher = Matcher(((7, normal("Alpha beta, gamma delta epsilon zeta.")),), 0.05)
    text = "x y ALPHA\nbeta -- gamma (delta) epsilon\tZETA! z"
    (found,) = spans(text, matcher)
    assert text[found["begin"]: found["end"]] == "ALPHA\nbeta -- gamma (delta) epsilon\tZETA" and found["edits"] == 0


def test_tables_and_odd_rows(spark, documents):
    rng = random.Random(1)
    items = [sentence(rng, 25) for _ in range(4)]
    bench = spark.createDataFrame([(0, items[0]), (1, items[1]), (2, None), (3, ""), (4, "..."), (5, items[0]), (None, items[2])],
                                  "item_id bigint, text string")
    texts = [(1, f"{sentence(rng, 9)} {items[0]} {items[1]}"), (2, sentence(rng, 300)), (3, None), (4, ""), (None, items[1]),
             (1, f"{items[0]}"), (5, items[2]), (6, (items[1] + " ") * 40)]
    docs = documents(texts, extra=("matches", "item_id"))
    found = lambda limit: sorted((r["doc_id"] or 0, [m["item_id"] for m in r["matches"]]) for r in with_matches(docs, bench, limit=limit).collect())
    expected = [(0, [1]), (1, [0, 5]), (1, [0, 5, 1]), (2, []), (3, []), (4, []), (5, [])]
    plain = found(1_000_000)
    assert plain[:7] == expected and set(plain[7][1]) == {1} and len(plain[7][1]) == 40
    assert [(d, sorted(m)) for d, m in found(100)] == [(d, sorted(m)) for d, m in plain]  # several blocks
    assert sorted(r["doc_id"] for r in decontaminated(docs, bench).collect()) == [2, 3, 4, 5]
    assert decontaminated(docs, bench.where("false")).count() == len(texts)
    assert decontaminated(documents([]), bench).collect() == []


def test_all_planted_items_of_the_test_table(spark, sf):
    docs, bench = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    items = [(r["item_id"], normal(r["text"])) for r in bench.collect()]
    planted = {(d["doc_id"], i) for d in docs.collect() for i, t in items if t in normal(d["text"])}
    got = {(r["doc_id"], m["item_id"]) for r in with_matches(docs, bench).collect() for m in r["matches"]}
    assert planted and planted <= got


def test_short_items_are_whole_words_and_every_match_counts():
    matcher = Matcher(((1, "no"), (2, "a"), (3, "short item"), (4, "this item is long enough for one edit")))
    assert spans("I know nothing about a shortitem", matcher) == [{"item_id": 2, "begin": 21, "end": 22, "edits": 0}]
    assert [(m["item_id"], m["begin"]) for m in spans("No, no! Short item; short item", matcher)] == [(1, 0), (1, 4), (3, 8), (3, 20)]
    item = "this item is long enough for one edit"
    text = f"{item}, {item.replace('long', 'lng')}. {item} and {item}"
    found = spans(text, matcher)
    assert [(text[m["begin"]:m["end"]], m["edits"]) for m in found] == [(item, 0), (item.replace("long", "lng"), 1), (item, 0), (item, 0)]


@pytest.mark.parametrize("seed", range(20))
def test_all_matches_against_plain_search(seed):
    """Exact copies, close together and apart: each is found, and nothing that overlaps it."""
    rng = random.Random(seed)
    items = tuple((k, sentence(rng, rng.randrange(1, 9))) for k in range(6))
    text = " ".join(rng.choice([sentence(rng, rng.randrange(1, 4)), rng.choice(items)[1]]) for _ in range(40))
    found = Matcher(items).find(text)
    for k, item in items:
        spans_ = sorted((a, b) for i, a, b, _ in found if i == k)
        assert all(b <= c for (_, b), (c, _) in zip(spans_, spans_[1:]))
        at = f" {text} ".find(f" {item} ")
        while at >= 0:
            assert any(a < at + len(item) and b > at for a, b in spans_), (item, at)
            at = f" {text} ".find(f" {item} ", at + 1)
