"""Probabilistic automata from example strings: compatible prefix-tree states are merged."""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass, field

SMOOTHING = 0.1


@dataclass
class _State:
    seen: int = 0
    ends: int = 0
    goes: dict[str, int] = field(default_factory=dict)
    taken: dict[str, int] = field(default_factory=lambda: defaultdict(int))


class Automaton:
    """Deterministic states with counts of symbols and ends; scores are log2 likelihoods.

    ``level`` and ``spread``: mean and deviation of an example's log likelihood a symbol.
    """

    def __init__(self, examples: dict[str, int], symbols: str, alpha: float = 0.05):
        self.symbols, self.alpha = symbols, alpha
        self.states = [_State()]
        for text, times in sorted(examples.items()):
            at = self.states[0]
            at.seen += times
            for c in text:
                if c not in at.goes:
                    at.goes[c] = len(self.states)
                    self.states.append(_State())
                at.taken[c] += times
                at = self.states[at.goes[c]]
                at.seen += times
            at.ends += times
        self._merge()
        self._freeze()
        rates = [(self.score(t) / max(1, len(t)), n, len(t)) for t, n in examples.items()]
        total = sum(n for _, n, _ in rates) or 1
        self.level = sum(r * n for r, n, _ in rates) / total
        self.spread = math.sqrt(sum((r - self.level) ** 2 * size * n for r, n, size in rates) / total)

    def _differ(self, k1: int, n1: int, k2: int, n2: int) -> bool:
        """Hoeffding's test: two observed rates are too far apart to be the same."""
        bound = math.sqrt(0.5 * math.log(2 / self.alpha)) * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))
        return abs(k1 / n1 - k2 / n2) > bound

    def _compatible(self, a: int, b: int) -> bool:
        pairs = [(a, b)]
        while pairs:
            p, q = (self.states[i] for i in pairs.pop())
            if not p.seen or not q.seen:
                continue
            if self._differ(p.ends, p.seen, q.ends, q.seen):
                return False
            for c in p.taken.keys() | q.taken.keys():
                if self._differ(p.taken.get(c, 0), p.seen, q.taken.get(c, 0), q.seen):
                    return False
                if c in p.goes and c in q.goes:
                    pairs.append((p.goes[c], q.goes[c]))
        return True

    def _fold(self, into: int, tree: int) -> None:
        pairs = [(into, tree)]
        while pairs:
            i, j = pairs.pop()
            p, q = self.states[i], self.states[j]
            p.seen += q.seen
            p.ends += q.ends
            for c, n in q.taken.items():
                p.taken[c] += n
                if c in p.goes:
                    pairs.append((p.goes[c], q.goes[c]))
                else:
                    p.goes[c] = q.goes[c]

    def _merge(self) -> None:
        red = [0]
        while True:
            blue = [
                (self.states[r].taken[c], r, c) for r in red for c, to in sorted(self.states[r].goes.items()) if to not in red
            ]
            if not blue:
                self.red = red
                return
            _, parent, c = max(blue, key=lambda x: (x[0], -x[1], x[2]))
            tree = self.states[parent].goes[c]
            for r in red:
                if self._compatible(r, tree):
                    self.states[parent].goes[c] = r
                    self._fold(r, tree)
                    break
            else:
                red.append(tree)

    def _freeze(self) -> None:
        place = {r: i for i, r in enumerate(self.red)}
        kinds = len(self.symbols) + 1
        self.table, self.stop, self.other = [], [], []
        for r in self.red:
            s = self.states[r]
            whole = s.seen + SMOOTHING * kinds
            self.table.append({
                c: (place[to], math.log2((s.taken[c] + SMOOTHING) / whole)) for c, to in s.goes.items()
            })
            self.stop.append(math.log2((s.ends + SMOOTHING) / whole))
            self.other.append(math.log2(SMOOTHING / whole))
        del self.states

    def score(self, text: str) -> float:
        """log2 of the string's probability; a symbol that a state has not seen keeps the state."""
        at, total = 0, 0.0
        for c in text:
            to = self.table[at].get(c)
            if to is None:
                total += self.other[at]
            else:
                total += to[1]
                at = to[0]
        return total + self.stop[at]

    def typical(self, text: str, deviations: float = 3.0) -> bool:
        """Whether the likelihood a symbol is what examples of this length have, neither lower nor higher."""
        n = max(1, len(text))
        return abs(self.score(text) / n - self.level) <= deviations * self.spread / math.sqrt(n) + 1e-9
