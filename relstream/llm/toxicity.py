"""Toxicity by a grammar of weighted transducers: clauses that insult or threaten, not words on their own.

A lexicon turns words into symbols: I insult, T threat, Y target, N negation, R report, q quotation mark, . end of a clause,
o any other word. Transducers rewrite the symbols of a clause: negation marks what a negation reaches, reported speech what
is quoted, the target transducer what is said to someone. Their composition is one machine that reads a clause once.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relstream.llm.common import map_rows
from relstream.llm.labelled import Calibration, SampleBound, calibrate, is_held_out, sample
from relstream.llm.transducers import Transducer, compose

# General words in four languages.
_INSULTS = """idiot idiots moron morons imbecile fool stupid dumb scum trash garbage vermin loser losers clown worthless pathetic
    disgusting filthy pig bastard bitch asshole coward liar idiotisch dumm dummkopf blödmann abschaum versager trottel arschloch
    widerlich wertlos imbécile crétin abruti débile salaud ordure minable dégoûtant idiota imbécil estúpido estúpida tonto basura
    escoria perdedor payaso asqueroso inútil patético""".split()
_THREATS = """kill hurt destroy murder beat strangle shoot stab hang burn töten umbringen verletzen erschießen tuer blesser frapper
    égorger matar herir golpear destruir""".split()
_TARGETS = """you your yours yourself u du dich dir euch ihr deine tu te toi vous votre tú ti usted ustedes vosotros""".split()
_NEGATIONS = """not no never nobody neither nor without isn aren wasn don doesn nicht kein keine keiner nie niemals pas jamais aucun
    aucune nunca jamás ningún ninguna""".split()
_REPORTS = """said says saying wrote writes called calls quoted reported reportedly allegedly claimed accused sagte schrieb nannte
    laut angeblich dit écrit appelé selon prétendu dijo escribió llamó según""".split()
_TOKEN = re.compile(r"""\w+|[.!?;:\n"“”„«»]""")
_QUOTES = set("\"“”„«»")
#: Clean texts show best which words are harmless, so the sample is larger than the default.
BOUND = SampleBound(rows=8_000, text_bytes=20_000_000)
#: Lengths of word beginnings that may stand for a family of inflected words.
_STEMS = (4, 5, 6)
_REMEMBERED = 300_000

Entry = tuple[str, float]

_HITS = ("I", "T")
#: How many words a negation reaches.
_REACH = 3


def negation() -> Transducer:
    """Insults and threats at most three words after a negation become their negated forms, I- and T-."""
    arcs = {}
    for left in range(_REACH + 1):
        arcs[left, "N"] = (_REACH, "o", 1.0)
        arcs[left, "."] = (0, ".", 1.0)
        for symbol in ("o", "Y", "R", "q"):
            arcs[left, symbol] = (max(left - 1, 0), symbol, 1.0)
        for hit in _HITS:
            arcs[left, hit] = (max(left - 1, 0), hit + "-" if left else hit, 0.3 if left else 1.0)
    return Transducer(_REACH + 1, arcs)


def reported_speech() -> Transducer:
    """What follows a reporting verb in its clause, or stands between quotation marks, is marked with ~."""
    arcs = {}
    for state, (reporting, quoting) in enumerate([(False, False), (True, False), (False, True), (True, True)]):
        index = lambda r, q: int(r) + 2 * int(q)
        arcs[state, "R"] = (index(True, quoting), "o", 1.0)
        arcs[state, "q"] = (index(reporting, not quoting), "o", 1.0)
        arcs[state, "."] = (0, ".", 1.0)
        for hit in ("I", "T", "I-", "T-"):
            arcs[state, hit] = (state, hit[0] + "~" if state else hit, 0.5 if state else 1.0)
    return Transducer(4, arcs)


def target() -> Transducer:
    """Insults in a clause after a target are said to it: IY. So are threats; those without a target do not count.

    A target after an insult turns into the symbol of an address, Y!, with a weight of its own.
    """
    arcs = {}
    for state in range(3):  # 0 nothing yet, 1 a target, 2 a hit without a target
        arcs[state, "."] = (0, ".", 1.0)
        arcs[state, "Y"] = (1, "Y!" if state == 2 else "o", 1.0)
        arcs[state, "I"] = (1, "IY", 1.5) if state == 1 else (2, "I", 1.0)
        arcs[state, "T"] = (1, "TY", 1.0) if state == 1 else (2, "o", 1.0)
        for marked in ("I-", "I~"):
            arcs[state, marked] = (state, marked, 1.0)
        for marked in ("T-", "T~"):
            arcs[state, marked] = (state, marked if state == 1 else "o", 1.0)
    return Transducer(3, arcs)


@lru_cache(maxsize=1)
def grammar() -> dict[tuple[int, str], tuple[int, str, float]]:
    return compose(compose(negation(), reported_speech()), target()).arcs


#: Features of a text: sums over its clauses by output symbol, then how its clauses are.
_OUTPUTS = {"I": 0, "IY": 1, "I-": 2, "T-": 2, "I~": 3, "T~": 3, "TY": 4, "Y!": 5}
_FEATURES = 8


class Lexicon(dict):
    """Words to (symbol, weight); None for other words. Families of words are found by their beginning."""

    def __init__(self, words: dict[str, Entry], stems: dict[str, float]):
        super().__init__(words)
        self.words, self.stems = words, stems

    def __missing__(self, word: str) -> Entry | None:
        if len(self) > len(self.words) + _REMEMBERED:
            self.clear()
            self.update(self.words)
            if word in self.words:
                return self.words[word]
        weight = max((self.stems[word[:n]] for n in _STEMS if len(word) > n and word[:n] in self.stems), default=0.0)
        if word in _QUOTES:
            found = ("q", 0.0)
        elif word in ".!?;:\n":
            found = (".", 0.0)
        else:
            found = ("I", weight) if weight else None
        if len(word) <= 40:
            self[word] = found
        return found


def general_words() -> dict[str, Entry]:
    classes = (("I", 1.0, _INSULTS), ("T", 1.0, _THREATS), ("Y", 0.5, _TARGETS), ("N", 0.0, _NEGATIONS), ("R", 0.0, _REPORTS))
    return {word: (symbol, weight) for symbol, weight, words in reversed(classes) for word in words}


def features(text: str | None, lexicon: Lexicon) -> list[float]:
    """Runs the grammar over each clause with an insult or a threat."""
    out = [0.0] * _FEATURES
    if not text:
        return out
    entries = list(map(lexicon.__getitem__, _TOKEN.findall(text.lower())))
    if not any(symbol in _HITS for symbol, _ in filter(None, entries)):
        return out
    arcs, clauses, matched, best = grammar(), 0, 0, 0.0
    clause: list[Entry | None] = []
    entries.append((".", 0.0))
    for entry in entries:
        clause.append(entry)
        if entry is None or entry[0] != ".":
            continue
        clauses += len(clause) > 1
        if any(e and e[0] in _HITS for e in clause):
            state, total = 0, 0.0
            for e in clause:
                symbol, weight = e or ("o", 0.0)
                state, symbol, factor = arcs.get((state, symbol), (state, symbol, 1.0))
                if symbol in _OUTPUTS:
                    out[_OUTPUTS[symbol]] += weight * factor
                    total += weight * factor
            matched += total > 0
            best = max(best, total)
        clause = []
    out = [math.log1p(value) for value in out[:6]]
    return [*out, math.log1p(best), math.sqrt(matched / max(clauses, 1))]


@dataclass(frozen=True)
class ToxicityModel:
    words: dict[str, Entry]
    stems: dict[str, float]
    calibration: Calibration


def learn_lexicon(toxic: list[str], clean: list[str], least: int = 3, most: int = 5_000) -> tuple[dict[str, Entry], dict[str, float]]:
    """Insults that the labels show: words, and beginnings shared by several such words, that toxic texts have far oftener.

    A word needs `least` toxic texts, `least` different words before it there (near copies of one text repeat a word in one
    place), and a smoothed odds ratio above 20; the `most` strongest are kept. A beginning needs three words with
    a ratio above 8 that are no general words, twice as many texts and a ratio above 12.
    """
    def texts_with(texts: list[str], only=None) -> Counter:
        counts: Counter = Counter()
        for text in texts:
            words = {w for w in _TOKEN.findall(text.lower()) if len(w) > 2}
            counts.update(words if only is None else words & only)
        return counts

    bad = {w: n for w, n in texts_with(toxic).items() if n >= least}
    good = texts_with(clean, bad.keys())
    places: dict[str, set[str]] = {w: set() for w in bad}
    for text in toxic:
        tokens = _TOKEN.findall(text.lower())
        for before, w in zip(tokens, tokens[1:]):
            if before != w and w in places and len(places[w]) < least:
                places[w].add(before)

    def odds(a: float, b: float) -> float:
        return math.log((a + 0.1) / (len(toxic) + 1)) - math.log((b + 0.1 + 0.2 * len(clean) / (len(toxic) + 1)) / (len(clean) + 1))

    weight = {w: odds(n, good[w]) for w, n in bad.items() if len(places[w]) >= least}
    words = {w: ("I", min(x / 3, 2.0)) for w, x in sorted(weight.items(), key=lambda kv: (-kv[1], kv[0]))[:most] if x > math.log(20)}
    known = general_words()
    family: dict[str, set[str]] = {}
    for w, x in weight.items():
        for n in _STEMS:
            if len(w) > n and x > math.log(8) and w not in known:
                family.setdefault(w[:n], set()).add(w)
    family = {stem: members for stem, members in family.items() if len(members) >= 3}
    inside, outside = (Counter(s for text in texts for s in {w[:n] for w in _TOKEN.findall(text.lower()) for n in _STEMS
                                                             if len(w) > n and w[:n] in family and w not in known}) for texts in (toxic, clean))
    stems = {s: min(odds(inside[s], outside[s]) / 3, 2.0) for s in family
             if inside[s] >= 2 * least and odds(inside[s], outside[s]) > math.log(12)}
    return known | {w: e for w, e in words.items() if w not in known}, stems


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", bound: SampleBound = BOUND) -> ToxicityModel:
    """Learns the lexicon and the curve from a bounded sample; the curve sees only texts that its lexicon was not learned from."""
    texts = sample(docs, labels, label, bound)
    folds = [{y: rows[k::2] for y, rows in texts.items()} for k in (0, 1)]
    x, classes = [], []
    for k in (0, 1):
        lexicon = Lexicon(*learn_lexicon(folds[k][1], folds[k][0]))
        for y, rows in folds[1 - k].items():
            x += [features(text, lexicon) for text in rows]
            classes += [y] * len(rows)
    curve = calibrate(np.array(x, dtype=float).reshape(-1, _FEATURES), np.array(classes, dtype=float))
    return ToxicityModel(*learn_lexicon(texts[1], texts[0]), curve)


def score(docs: DataFrame, model: ToxicityModel, text: str = "text", name: str = "score") -> DataFrame:
    """`docs` with a score between 0 and 1: how likely a text is toxic. A column of its name is replaced.

    Whole texts are read. Null and empty texts, and texts without a matched clause, get the curve's value for none. Equal
    texts get equal scores. An empty table gives an empty one. Broadcast is the model, some 6,000 words at most.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    carried = [f for f in docs.schema if f.name.lower() != name and f.name != text]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in carried), f"`{text}` string, {name} double"])

    def each(_):
        fitted = shared.value
        lexicon = Lexicon(fitted.words, fitted.stems)

        def apply(*columns):
            x = np.array([features(value, lexicon) for value in columns[-1]], dtype=float).reshape(-1, _FEATURES)
            return *columns, fitted.calibration.score(x).tolist()
        return apply

    return map_rows(docs.select(*(F.col(f"`{f.name}`") for f in carried), F.col(f"`{text}`")), each, schema)


def rate(docs: DataFrame, labels: DataFrame, label: str = "toxic", threshold: float = 0.5,
         bound: SampleBound = BOUND) -> DataFrame:
    """doc_id, held_out, score, predicted for every row, learned from rows that are not held out."""
    scored = score(docs.select("doc_id", "text"), fit(docs, labels, label, bound))
    return scored.select("doc_id", F.coalesce(is_held_out(), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
