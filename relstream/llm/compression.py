"""Quality by compression: a text that good text's dictionary shortens more than bad text's is likely good."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relstream.llm.common import map_rows
from relstream.llm.labelled import Calibration, SampleBound, calibrate, is_held_out, sample

#: Texts are compressed in pieces of this many characters: a dictionary matters for the beginning of what it is given to.
PIECE = 2_000
_LEVEL = 3
_DICTIONARY_BYTES = 96 * 1024


@dataclass(frozen=True)
class CompressionModel:
    """Two dictionaries and the curve over the features of `features`."""

    good: bytes
    bad: bytes
    calibration: Calibration


def pieces(text: str) -> list[bytes]:
    return [text[k: k + PIECE].encode("utf-8", "surrogatepass") for k in range(0, len(text), PIECE)]


def dictionary(texts: list[str]) -> bytes:
    """A trained dictionary; where there is too little text to train one, the end of the text itself."""
    samples = [p for text in texts for p in pieces(text)]
    try:
        return zstandard.train_dictionary(_DICTIONARY_BYTES, samples, k=200, d=8, steps=1).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-_DICTIONARY_BYTES:]


class Compressors:
    """Compressed sizes of whole texts under either dictionary and under none."""

    def __init__(self, good: bytes, bad: bytes):
        options = dict(level=_LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)
        self.each = [
            zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(d), **options) if d
            else zstandard.ZstdCompressor(**options) for d in (good, bad)]
        self.plain = zstandard.ZstdCompressor(**options)

    def features(self, text: str | None) -> list[float]:
        """The normalised difference of sizes, the better of both ratios, the ratio without dictionaries, log length."""
        cut = pieces(text or "")
        raw = sum(map(len, cut))
        if not raw:
            return [0.0, 0.0, 0.0, 0.0]
        good, bad = (sum(len(c.compress(p)) for p in cut) for c in self.each)
        plain = sum(len(self.plain.compress(p)) for p in cut)
        return [(bad - good) / (bad + good), np.log(min(good, bad) / raw), np.log(plain / raw), np.log1p(raw)]


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", bound: SampleBound = SampleBound()) -> CompressionModel:
    """Builds the dictionaries from one half of a bounded sample and calibrates on the other half."""
    texts = sample(docs, labels, label, bound)
    halves = [{y: rows[k::2] for y, rows in texts.items()} for k in (0, 1)]
    good, bad = dictionary(halves[0][1]), dictionary(halves[0][0])
    by = Compressors(good, bad)
    rows = [(by.features(text), y) for y, kind in halves[1].items() for text in kind]
    x = np.array([f for f, _ in rows], dtype=float).reshape(-1, 4)
    x = np.hstack([x, x[:, 1:3] ** 2])
    return CompressionModel(good, bad, calibrate(x, np.array([y for _, y in rows], dtype=float)))


def score(docs: DataFrame, model: CompressionModel, text: str = "text") -> DataFrame:
    """`docs` with `score` between 0 and 1: how likely a text is good. A column of that name is replaced.

    Whole texts are read, in pieces. Null and empty texts get the curve's value for a text without content. Equal texts get
    equal scores. An empty table gives an empty one. Broadcast is the model, 200 KB at most.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    carried = [f for f in docs.schema if f.name.lower() != "score" and f.name != text]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in carried), f"`{text}` string, score double"])

    def each(_):
        fitted = shared.value
        by = Compressors(fitted.good, fitted.bad)

        def apply(*columns):
            x = np.array([by.features(value) for value in columns[-1]], dtype=float).reshape(-1, 4)
            return *columns, fitted.calibration.score(np.hstack([x, x[:, 1:3] ** 2])).tolist()
        return apply

    return map_rows(docs.select(*(F.col(f"`{f.name}`") for f in carried), F.col(f"`{text}`")), each, schema)


def rate(docs: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = 0.3,
         bound: SampleBound = SampleBound()) -> DataFrame:
    """doc_id, held_out, score, predicted for every row, learned from rows that are not held out."""
    scored = score(docs.select("doc_id", "text"), fit(docs, labels, label, bound))
    return scored.select("doc_id", F.coalesce(is_held_out(), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
