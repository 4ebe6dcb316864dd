"""How a join builds its result value."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEFT = "left__"
RIGHT = "right__"

Build = Callable[[Column, Column], dict[str, Column]]


@dataclass(frozen=True)
class Joiner:
    """`build(left, right)` names the result columns from the two value structs.

    A missing side is a NULL struct, whose fields read as NULL. Where `valid(left, right)` is given
    and not true, the join function counts as failed: the result value is null and the pair goes to
    `quarantine()`, unless `fallback` names the result columns to use instead.
    """

    build: Build
    valid: Callable[[Column, Column], Column] | None = None
    fallback: Build | None = None

    @staticmethod
    def of(given: Joiner | Build | None, left: tuple[str, ...], right: tuple[str, ...]) -> Joiner:
        if isinstance(given, Joiner):
            return given
        return Joiner(given or both_values(left, right))

    def columns(self, emit: Column | None = None) -> dict[str, Column]:
        """Result columns over the LEFT and RIGHT structs, null where `emit` or `valid` fails."""
        left, right = F.col(LEFT), F.col(RIGHT)
        built = self.build(left, right)
        if self.valid is not None:
            spare = self.fallback(left, right) if self.fallback else {}
            built = {n: F.when(self._valid(), c).otherwise(spare.get(n, F.lit(None))) for n, c in built.items()}
        return built if emit is None else {name: F.when(emit, column) for name, column in built.items()}

    def _valid(self) -> Column:
        return F.coalesce(self.valid(F.col(LEFT), F.col(RIGHT)), F.lit(False))

    def rejects(self, flow, operator: str, joined: DataFrame, emit: Column | None = None) -> tuple[DataFrame, ...]:
        """Quarantine rows for the pairs whose join function failed; `joined` has the flow's key and order columns."""
        if self.valid is None or self.fallback is not None:
            return ()
        failed = joined.where(~self._valid() if emit is None else emit & ~self._valid())
        pair = flow.with_(df=failed, value=(LEFT, RIGHT), rejects=())
        return (pair.reject(operator, failed, "join function failed"),)


def both_values(left: tuple[str, ...], right: tuple[str, ...]) -> Build:
    """All value columns of both sides; a right name that is taken gets the suffix `_right`."""
    names = {v: f"{v}_right" if v in left else v for v in right}
    return lambda l, r: {**{v: l[v] for v in left}, **{names[v]: r[v] for v in right}}
