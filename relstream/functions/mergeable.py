"""Aggregates given as partial / merge / finish columns.

Spark's own aggregates split themselves around a shuffle. A session that is cut at a time boundary
(see `operators.sessions`) needs the same split spelled out, which is what a `Mergeable` does.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Mergeable:
    """`partial` aggregates rows, `merge` aggregates partial states, `finish` reads the result.

    States are addressed by name; `merge` and `finish` receive a lookup from state name to column.
    """

    partial: dict[str, Column]
    merge: Callable[[Callable[[str], Column]], dict[str, Column]]
    finish: Callable[[Callable[[str], Column]], Column]


def _single(agg: Callable[[Column], Column], again: Callable[[Column], Column], column: Column) -> Mergeable:
    return Mergeable({"v": agg(column)}, lambda s: {"v": again(s("v"))}, lambda s: s("v"))


def count() -> Mergeable:
    return _single(F.count, F.sum, F.lit(1))


def sum_(column: Column) -> Mergeable:
    return _single(F.sum, F.sum, column)


def min_(column: Column) -> Mergeable:
    return _single(F.min, F.min, column)


def max_(column: Column) -> Mergeable:
    return _single(F.max, F.max, column)


def avg(column: Column) -> Mergeable:
    return Mergeable(
        {"s": F.sum(column), "n": F.count(column)},
        lambda s: {"s": F.sum(s("s")), "n": F.sum(s("n"))},
        lambda s: F.try_divide(s("s"), s("n")),
    )


def first(column: Column, *order: str) -> Mergeable:
    """The value of the earliest row under `order`."""
    return Mergeable(
        {"v": F.min(F.struct(*order, column.alias("__v")))},
        lambda s: {"v": F.min(s("v"))},
        lambda s: s("v")["__v"],
    )


def last(column: Column, *order: str) -> Mergeable:
    """The value of the latest row under `order`."""
    return Mergeable(
        {"v": F.max(F.struct(*order, column.alias("__v")))},
        lambda s: {"v": F.max(s("v"))},
        lambda s: s("v")["__v"],
    )
