"""Small deterministic transducers over symbols, and their composition."""

from __future__ import annotations

from dataclasses import dataclass

#: A symbol that a transducer does not name passes unchanged and leaves the state as it is.
Arc = tuple[int, str, float]


@dataclass(frozen=True)
class Transducer:
    """Arcs by (state, symbol): next state, output symbol and a weight that multiplies the symbol's. State 0 begins."""

    states: int
    arcs: dict[tuple[int, str], Arc]

    def step(self, state: int, symbol: str) -> Arc:
        return self.arcs.get((state, symbol), (state, symbol, 1.0))

    @property
    def symbols(self) -> set[str]:
        return {symbol for _, symbol in self.arcs} | {out for _, out, _ in self.arcs.values()}


def compose(first: Transducer, second: Transducer) -> Transducer:
    """The transducer that feeds the output of `first` to `second`: pairs of states, products of weights."""
    arcs = {}
    for symbol in first.symbols | second.symbols:
        for a in range(first.states):
            next_a, between, weight_a = first.step(a, symbol)
            for b in range(second.states):
                next_b, out, weight_b = second.step(b, between)
                arcs[a * second.states + b, symbol] = (next_a * second.states + next_b, out, weight_a * weight_b)
    return Transducer(first.states * second.states, arcs)
