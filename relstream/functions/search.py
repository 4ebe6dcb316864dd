"""Binary search in sorted array columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def leading(array: Column, reached: Callable[[Column], Column]) -> Column:
    """How many leading elements of `array` satisfy `reached`, which no later one may then do again.

    Tries ever smaller steps, about log2(size) of them, and takes those that land on such an element.
    """
    largest = F.floor(F.log2(F.greatest(F.size(array), F.lit(1)))).cast("int")
    steps = F.transform(F.sequence(largest, F.lit(0), F.lit(-1)), lambda e: F.pow(F.lit(2), e).cast("int"))

    def advance(position: Column, step: Column) -> Column:
        element = F.get(array, position + step - 1)
        # Past the end there is no element, and a condition on its fields might still be true.
        return F.when(element.isNotNull() & reached(element), position + step).otherwise(position)

    return F.aggregate(steps, F.lit(0), advance)
