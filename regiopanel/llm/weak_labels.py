"""A label model: reliabilities of voters by expectation-maximisation over counts of vote patterns.

A vote is 1 (the class holds), -1 (it does not) or 0 (abstains).  Patterns are counted by Spark; what
reaches the driver is one row for each pattern that occurs, at most 3 to the number of voters.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

VOTES = (-1, 0, 1)
# Chances of the three votes before anything is seen: voters are right more often than not, and
# a vote for the class is rare outside it.
GUESS = {True: {-1: 0.15, 0: 0.45, 1: 0.40}, False: {-1: 0.50, 0: 0.49, 1: 0.01}}
PRIOR = 0.2
ROUNDS = 50


def _sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-max(-60.0, min(60.0, x))))


@dataclass(frozen=True)
class LabelModel:
    """Log odds of the class: ``bias`` plus a weight for each voter's vote."""

    bias: float
    weights: tuple[dict[int, float], ...]

    def odds(self, pattern: tuple[int, ...]) -> float:
        return self.bias + sum(w[v] for w, v in zip(self.weights, pattern, strict=True))

    def posterior(self, pattern: tuple[int, ...]) -> float:
        return _sigmoid(self.odds(pattern))


def _model(prior: float, chances: list[dict[bool, dict[int, float]]]) -> LabelModel:
    weights = tuple({v: math.log(c[True][v] / c[False][v]) for v in VOTES} for c in chances)
    return LabelModel(math.log(prior / (1 - prior)), weights)


def fit(
    counts: dict[tuple[int, ...], int], voters: int, strength: float = 20.0, prior: float = PRIOR, guess: dict = GUESS
) -> LabelModel:
    """``strength`` is the weight, in rows, of the first guess, so that a small input can't overturn it."""
    total, first = sum(counts.values()), prior
    model = _model(prior, [guess] * voters)
    for _ in range(ROUNDS):
        held = {p: n * model.posterior(p) for p, n in counts.items()}
        prior = (sum(held.values()) + strength * first) / (total + strength)
        chances = []
        for j in range(voters):
            sums = {c: {v: strength * guess[c][v] for v in VOTES} for c in (True, False)}
            for p, n in counts.items():
                sums[True][p[j]] += held[p]
                sums[False][p[j]] += n - held[p]
            whole = {c: sum(s.values()) for c, s in sums.items()}
            chances.append({c: {v: sums[c][v] / whole[c] for v in VOTES} for c in sums})
        model = _model(min(max(prior, 1e-6), 1 - 1e-6), chances)
    return model
