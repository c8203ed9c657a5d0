"""Weighted finite-state transducers: arcs, composition, best accepting path.

An arc reads one symbol, writes one symbol (or nothing) and has a factor. ``compose`` feeds what the first
machine writes to the second one. Symbols carry weights from outside; a path scores the sum of weight times
factor of its arcs, and a string scores its best accepting path.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Transducer:
    """``arcs[state, symbol]`` lists (next state, written symbol or '', factor); a missing entry rejects."""

    start: object
    arcs: dict
    finals: frozenset

    def best(self, symbols) -> float | None:
        """The score of the best accepting path over (symbol, weight) pairs; None if no path accepts."""
        scores = {self.start: 0.0}
        for symbol, weight in symbols:
            after: dict = {}
            for state, score in scores.items():
                for target, _, factor in self.arcs.get((state, symbol), ()):
                    reached = score + weight * factor
                    if reached > after.get(target, -1.0):
                        after[target] = reached
            scores = after
        return max((s for state, s in scores.items() if state in self.finals), default=None)


def build(start, alphabet, step, final) -> Transducer:
    """The machine of the states reachable from ``start``: ``step(state, symbol)`` gives the arcs and ``final``
    tells accepting states. States become numbers, the start 0."""
    number, arcs, finals = {start: 0}, {}, set()
    todo = [start]
    while todo:
        state = todo.pop()
        if final(state):
            finals.add(number[state])
        for symbol in alphabet:
            out = []
            for target, written, factor in step(state, symbol):
                if target not in number:
                    number[target] = len(number)
                    todo.append(target)
                out.append((number[target], written, factor))
            if out:
                arcs[number[state], symbol] = tuple(out)
    return Transducer(0, arcs, frozenset(finals))


def compose(first: Transducer, second: Transducer, alphabet) -> Transducer:
    """The machine that reads what ``first`` reads and writes what ``second`` writes of it; factors multiply."""
    def step(state, symbol):
        a, b = state
        for a_next, middle, factor in first.arcs.get((a, symbol), ()):
            if not middle:
                yield (a_next, b), "", factor
                continue
            for b_next, written, other in second.arcs.get((b, middle), ()):
                yield (a_next, b_next), written, factor * other
    return build((first.start, second.start), alphabet, step,
                 lambda s: s[0] in first.finals and s[1] in second.finals)
