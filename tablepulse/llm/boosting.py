"""Gradient-boosted trees for a bounded table on one machine: logistic loss, binned features."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

DEPTH = 3


@dataclass(frozen=True)
class Trees:
    """Complete trees of fixed depth: a feature and a threshold a split, a value a leaf."""

    start: float
    features: np.ndarray
    thresholds: np.ndarray
    values: np.ndarray

    def log_odds(self, table: np.ndarray) -> np.ndarray:
        total = np.full(len(table), self.start)
        for features, thresholds, values in zip(
            self.features, self.thresholds, self.values, strict=True
        ):
            at = np.zeros(len(table), np.int64)
            for _ in range(DEPTH):
                right = table[np.arange(len(table)), features[at]] > thresholds[at]
                at = 2 * at + 1 + right
            total += values[at - (2**DEPTH - 1)]
        return total


def _best_split(binned, edges, slope, curve, penalty: float) -> tuple[float, int, float]:
    """Gain, feature and threshold of the best split of these rows."""
    best = (0.0, 0, np.inf)
    whole = slope.sum() ** 2 / (curve.sum() + penalty)
    for feature, cuts in enumerate(edges):
        if not len(cuts):
            continue
        size = len(cuts) + 1
        left_slope = np.bincount(binned[:, feature], slope, size)[:-1].cumsum()
        left_curve = np.bincount(binned[:, feature], curve, size)[:-1].cumsum()
        gain = (
            left_slope**2 / (left_curve + penalty)
            + (slope.sum() - left_slope) ** 2 / (curve.sum() - left_curve + penalty)
            - whole
        )
        at = int(gain.argmax())
        if gain[at] > best[0] + 1e-9:
            best = (float(gain[at]), feature, float(cuts[at]))
    return best


def fit_trees(
    table: np.ndarray, labels: np.ndarray, rounds: int = 60, rate: float = 0.2, bins: int = 32,
    penalty: float = 1.0,
) -> Trees:
    """Fit to labels 0 and 1. Deterministic: ties go to the first feature and threshold."""
    shares = np.linspace(0, 1, bins + 1)[1:-1]
    edges = []
    for column in table.T:
        cuts = np.unique(np.quantile(column, shares))
        middle = np.unique(np.append(cuts, (column.min() + column.max()) / 2))
        edges.append(middle[(middle >= column.min()) & (middle < column.max())])
    binned = np.column_stack([np.searchsorted(e, c) for e, c in zip(edges, table.T, strict=True)])
    share = min(max(labels.mean(), 1e-3), 1 - 1e-3)
    score = np.full(len(labels), np.log(share / (1 - share)))
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    features = np.zeros((rounds, inner), np.int64)
    thresholds = np.full((rounds, inner), np.inf)
    values = np.zeros((rounds, leaves))
    for turn in range(rounds):
        chance = 1 / (1 + np.exp(-score))
        slope, curve = labels - chance, chance * (1 - chance)
        at = np.zeros(len(labels), np.int64)
        for node in range(inner):
            here = at == node
            if here.any():
                _, feature, cut = _best_split(binned[here], edges, slope[here], curve[here], penalty)
                features[turn, node], thresholds[turn, node] = feature, cut
                at[here] = 2 * node + 1 + (table[here, feature] > cut)
        leaf = at - inner
        up = np.bincount(leaf, slope, leaves)
        down = np.bincount(leaf, curve, leaves)
        values[turn] = rate * up / (down + penalty)
        score += values[turn][leaf]
    return Trees(float(np.log(share / (1 - share))), features, thresholds, values)
