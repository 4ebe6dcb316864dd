"""The two classifiers: held-out accuracy on the test tables, odd rows, the composed grammar."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from relstream.llm import compression, labelled, toxicity
from relstream.llm.transducers import Transducer, compose

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def confusion(rated, labels, column):
    rows = rated.join(labels, "doc_id").where("held_out").collect()
    return [sum(r["predicted"] == p and r[column] == y for r in rows) for p, y in ((1, 1), (1, 0), (0, 1), (0, 0))]


def test_quality_on_held_out_rows(tables):
    tp, fp, fn, tn = confusion(compression.rate(*tables), tables[1], "quality")
    assert tp / (tp + fn) > 0.95 and tn / (tn + fp) > 0.7


def test_toxicity_on_held_out_rows(tables):
    tp, fp, fn, tn = confusion(toxicity.rate(*tables), tables[1], "toxic")
    assert tp / (tp + fn) > 0.6 and fp <= 1


@pytest.mark.parametrize("rate", [compression.rate, toxicity.rate])
def test_every_row_is_scored(documents, spark, rate):
    texts = [(1, None), (2, ""), (3, "word " * 50_000), (4, "you are an idiot"), (4, "you are an idiot"), (None, "x")]
    texts += [(10 + i, f"some words {i}, and more of them, {i * 7}. " * 5) for i in range(30)]
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(40)] + [(3, None, None), (99, 1, 1), (4, 1, 0)],
                                   "doc_id bigint, quality int, toxic int")
    rows = rate(documents(texts, extra=("score", "predicted")), labels).collect()
    assert len(rows) == len(texts) and all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in rows)
    assert {r["doc_id"]: r["held_out"] for r in rows if r["doc_id"]} == {d: zlib.crc32(str(d).encode()) % 5 == 0 for d, _ in texts if d}
    assert len({r["score"] for r in rows if r["doc_id"] == 4}) == 1
    none = labels.where("false")
    assert len(rate(documents(texts), none).collect()) == len(texts)
    assert rate(documents([]), none).collect() == []


def test_held_out_labels_are_never_seen(documents, spark):
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0]
    docs = documents({i: f"text number {i}" for i in range(400)})
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id bigint, y int")
    seen = labelled.sample(docs, labels, "y", labelled.SampleBound())
    assert not {f"text number {i}" for i in held} & {t for rows in seen.values() for t in rows}
    assert sum(map(len, seen.values())) == 400 - len(held)


def test_the_sample_is_bounded_and_takes_whole_texts(documents, spark):
    docs = documents([(i, f"{i % 40} " + "x" * 100) for i in range(300)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id bigint, y int")
    seen = labelled.sample(docs, labels, "y", labelled.SampleBound(rows=50, text_bytes=1_000))
    for rows in seen.values():
        assert 0 < sum(len(t) for t in rows) <= 1_000 and all(t.endswith("x" * 100) for t in rows)


def test_calibration_orders_and_survives_one_class():
    x = np.array([[0.0], [1.0], [2.0], [3.0]])
    curve = labelled.calibrate(x, np.array([0.0, 0.0, 1.0, 1.0]))
    assert (np.diff(curve.score(x)) > 0).all()
    assert labelled.calibrate(x, np.ones(4)).score(x).min() > 0.9
    assert labelled.calibrate(np.zeros((0, 2)), np.zeros(0)).score(np.zeros((1, 2)))[0] == 0.5


def test_sizes_are_of_whole_texts():
    by = compression.Compressors(b"", b"")
    assert sum(map(len, compression.pieces("é" * 5_001))) == 10_002
    assert by.features("ab" * 9_000)[3] == pytest.approx(np.log1p(18_000))


# -- the grammar ----------------------------------------------------------------------------------

def test_composition_is_feeding_one_into_the_other():
    first = Transducer(2, {(0, "a"): (1, "b", 0.5), (1, "a"): (0, "c", 1.0)})
    second = Transducer(2, {(0, "b"): (1, "x", 2.0), (1, "c"): (0, "y", 3.0)})
    both = compose(first, second)
    state, out = 0, []
    for symbol in "aaza":
        state, symbol, weight = both.step(state, symbol)
        out.append((symbol, weight))
    assert out == [("x", 1.0), ("y", 3.0), ("z", 1.0), ("x", 1.0)]


LEXICON = toxicity.Lexicon(toxicity.general_words(), {"blarg": 1.0})
PLAIN, TARGETED, NEGATED, REPORTED, THREAT, ADDRESS = range(6)


@pytest.mark.parametrize("text,feature", [
    ("such an idiot came in", PLAIN), ("you are an idiot", TARGETED), ("he is not an idiot", NEGATED), ("she said that idiot came", REPORTED),
    ('they heard "idiot" there', REPORTED), ("you, i will kill", THREAT), ("idiot, all of you", ADDRESS), ("blargish people", PLAIN),
])
def test_clauses(text, feature):
    found = toxicity.features(text, LEXICON)
    assert found[feature] > 0
    assert feature == ADDRESS or not any(found[k] for k in range(6) if k not in (feature, ADDRESS))


@pytest.mark.parametrize("text", ["they kill time", "a knife can kill", "nothing to see", None, "", "...", "not you"])
def test_words_alone_do_not_match(text):
    assert not any(toxicity.features(text, LEXICON))


def test_clauses_are_apart():
    near, apart = toxicity.features("he is not an idiot", LEXICON), toxicity.features("he is not. an idiot", LEXICON)
    assert near[NEGATED] and not near[PLAIN] and apart[PLAIN] and not apart[NEGATED]


def test_repeats_of_one_text_teach_no_word():
    copies = [f"one rareword stood here {i}" for i in range(20)]
    words, stems = toxicity.learn_lexicon(copies + ["x idiot"], [f"clean text {i}" for i in range(200)])
    assert "rareword" not in words and not stems


def test_learned_words_and_families():
    rng = np.random.RandomState(0)
    fill = [f"w{k}" for k in range(50)]
    text = lambda word: " ".join([*rng.choice(fill, 9), word, *rng.choice(fill, 5)])
    toxic = [text(f"zork{rng.choice(['a', 'be', 'co', 'du'])}") for _ in range(60)]
    words, stems = toxicity.learn_lexicon(toxic, [text("fine") for _ in range(300)])
    assert {"zorka", "zorkbe"} <= set(words) and "zork" in stems and not any(w in words for w in fill)
