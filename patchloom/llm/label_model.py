"""A label model for rules that vote or abstain: accuracies by expectation-maximisation, without true labels.

Each rule votes 1 (good), 0 (bad) or abstains (null). Given the hidden truth the votes are taken as
independent; each rule has a chance of every vote under either truth, abstaining included. All that
the model needs are counts of vote patterns, which Spark adds up over all rows before anything
moves; there are at most 3 ** rules patterns, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: More rules than this would let the number of patterns grow past what a driver should read.
MOST_RULES = 12


@dataclass(frozen=True)
class LabelModel:
    """``prior``: the share of good rows; ``votes[truth][rule][vote]``: log chances, vote 0 bad, 1 good, 2 abstain."""

    rules: tuple[str, ...]
    prior: float
    votes: tuple

    def accuracy(self, rule: str) -> float:
        """The chance that a vote of the rule is right."""
        bad, good = (np.exp(np.array(self.votes[t][self.rules.index(rule)])) for t in (0, 1))
        right = self.prior * good[1] + (1 - self.prior) * bad[0]
        return float(right / max(right + self.prior * good[0] + (1 - self.prior) * bad[1], 1e-12))

    def posterior(self, votes: Sequence[Column]) -> Column:
        """The probability that a row is good."""
        start = float(np.log(self.prior) - np.log1p(-self.prior))
        total = F.lit(start)
        for i, vote in enumerate(votes):
            weight = [self.votes[1][i][v] - self.votes[0][i][v] for v in range(3)]
            total = total + F.when(vote == 1, float(weight[1])).when(vote == 0, float(weight[0])).otherwise(float(weight[2]))
        return 1 / (1 + F.exp(-total))


def pattern_counts(rows: DataFrame, rules: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Vote patterns (2 for abstain) and how many rows have each."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"at most {MOST_RULES} rules")
    found = rows.groupBy(*[F.coalesce(F.col(r).cast("int"), F.lit(2)).alias(r) for r in rules]).count().collect()
    found.sort()
    return (np.array([r[:-1] for r in found], dtype=np.int64).reshape(len(found), len(rules)),
            np.array([r[-1] for r in found], dtype=np.float64))


def fitted(patterns: np.ndarray, counts: np.ndarray, rules: Sequence[str], prior: float = 0.7, accuracy: float = 0.85,
           rounds: int = 200, smoothing: float = 1.0) -> LabelModel:
    """Expectation-maximisation from ``prior`` and an equal ``accuracy`` for every rule; the start says which side is good.

    Without rows the start is returned. Counts are smoothed, so that a rule that never votes decides nothing.
    """
    k = len(rules)
    seen = counts @ (patterns == 2) if len(counts) else np.zeros(k)
    silent = (seen + smoothing) / (counts.sum() + 2 * smoothing)
    chance = np.empty((2, k, 3))
    for truth in (0, 1):
        chance[truth, :, truth] = accuracy * (1 - silent)
        chance[truth, :, 1 - truth] = (1 - accuracy) * (1 - silent)
        chance[truth, :, 2] = silent
    start = smoothing * chance
    if len(counts):
        hot = np.stack([patterns == v for v in range(3)], axis=2).astype(float)  # pattern, rule, vote
        for _ in range(rounds):
            like = [np.log(p) + np.einsum("prv,rv->p", hot, np.log(chance[t])) for t, p in ((0, 1 - prior), (1, prior))]
            good = 1 / (1 + np.exp(np.clip(like[0] - like[1], -700, 700)))
            weight = np.stack([counts * (1 - good), counts * good])
            after = np.einsum("tp,prv->trv", weight, hot) + start
            after /= after.sum(axis=2, keepdims=True)
            share = (weight[1].sum() + smoothing) / (counts.sum() + 2 * smoothing)
            moved = max(np.abs(after - chance).max(), abs(share - prior))
            chance, prior = after, float(share)
            if moved < 1e-9:
                break
    return LabelModel(tuple(rules), float(prior), tuple(tuple(tuple(v) for v in t) for t in np.log(chance).tolist()))
