"""Boolean columns with the failure semantics of record predicates."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def all_present(names: Iterable[str]) -> Column:
    """True when none of the named columns is null."""
    return all_of(F.col(n).isNotNull() for n in names)


def all_null(names: Iterable[str]) -> Column:
    return all_of(F.col(n).isNull() for n in names)


def strict(condition: Column, requires: Iterable[str] = ()) -> Column:
    """`condition`, but NULL ("the predicate failed") when a required column is null.

    SQL gives `NULL AND FALSE = FALSE`, so a plain negation would keep a row whose predicate could
    not be evaluated. Naming the columns the predicate cannot do without keeps it three-valued.
    """
    requires = tuple(requires)
    return F.when(all_present(requires), condition) if requires else condition
