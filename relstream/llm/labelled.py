"""Bounded samples of labelled texts, and the logistic calibration that turns features into scores."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class SampleBound:
    """How much labelled text the driver may learn from, per class: rows, and UTF-8 bytes of their texts."""

    rows: int = 4_000
    text_bytes: int = 12_000_000


def is_held_out(doc_id: str = "doc_id") -> Column:
    """Documents that no label is learned from: crc32 of the id as text, modulo 5, is 0."""
    return F.crc32(F.col(doc_id).cast("string")) % 5 == 0


def sample(docs: DataFrame, labels: DataFrame, label: str, bound: SampleBound) -> dict[int, list[str]]:
    """Whole texts by class, in an order that depends on ids only.

    The rows with the smallest hash of their id, until `bound` is reached; a text that would exceed the bytes is left
    out of the sample. Held-out rows, null labels, null ids and null texts are never in it. Several labels of one
    document count as their rounded mean. A text that occurs several times in a class is taken once.
    """
    order = F.xxhash64("doc_id")
    usable = labels.where(~is_held_out() & F.col(label).isNotNull()).groupBy("doc_id").agg(F.round(F.avg(label)).cast("int").alias("y"))
    chosen = None
    for y in (0, 1):
        rows = usable.where(F.col("y") == y).orderBy(order, "doc_id").limit(bound.rows)
        chosen = rows if chosen is None else chosen.unionAll(rows)
    # At most 2 * bound.rows ids.
    found = docs.where(F.col("text").isNotNull()).join(F.broadcast(chosen), "doc_id")
    sizes = found.select("doc_id", "y", F.octet_length("text").alias("bytes"), order.alias("place"), F.xxhash64("text").alias("h"))
    left, taken = {0: bound.text_bytes, 1: bound.text_bytes}, set()
    for row in sorted(sizes.distinct().collect(), key=lambda r: (r.place, r.doc_id, r.h)):
        if row.bytes <= left[row.y]:
            left[row.y] -= row.bytes
            taken.add((row.doc_id, row.h))
    if not taken:
        return {0: [], 1: []}
    kind = docs.schema["doc_id"].dataType.simpleString()
    ids = docs.sparkSession.createDataFrame(list(taken), f"doc_id {kind}, h bigint")
    texts = found.join(F.broadcast(ids), (found["doc_id"] == ids["doc_id"]) & (F.xxhash64(found["text"]) == ids["h"]))
    rows = sorted({(r.doc_id, r.text, r.y) for r in texts.select(found["doc_id"], "text", "y").collect()})
    # Copies would count one opinion several times.
    return {y: list(dict.fromkeys(text for _, text, kind in rows if kind == y)) for y in (0, 1)}


def standard(features: np.ndarray, weights: np.ndarray, centre: np.ndarray, spread: np.ndarray) -> np.ndarray:
    z = (features - centre) / spread @ weights[1:] + weights[0]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass(frozen=True)
class Calibration:
    """A logistic curve over standardised features."""

    weights: np.ndarray
    centre: np.ndarray
    spread: np.ndarray

    def score(self, features: np.ndarray) -> np.ndarray:
        return standard(features, self.weights, self.centre, self.spread)


def calibrate(features: np.ndarray, classes: np.ndarray, ridge: float = 1.0) -> Calibration:
    """Newton's method on the ridge-regularised logistic loss. Without both classes the score is the share of class 1."""
    centre = features.mean(axis=0) if len(features) else np.zeros(features.shape[1])
    spread = features.std(axis=0) if len(features) else np.ones(features.shape[1])
    spread = np.where(spread > 1e-12, spread, 1.0)
    x = np.hstack([np.ones((len(features), 1)), (features - centre) / spread])
    w = np.zeros(x.shape[1])
    if len(set(classes.tolist())) < 2:
        share = classes.mean() if len(classes) else 0.5
        w[0] = np.log(max(share, 1e-3) / max(1 - share, 1e-3))
        return Calibration(w, centre, spread)
    penalty = np.diag([0.0] + [ridge] * (x.shape[1] - 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T * (p * (1 - p) + 1e-9) @ x + penalty, x.T @ (p - classes) + penalty @ w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return Calibration(w, centre, spread)
