"""Gradient-boosted regression trees for two classes and isotonic calibration, on bounded samples."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

BINS = 32


@dataclass
class Trees:
    """Complete binary trees of equal depth, as arrays (tree, node); a leaf holds a step in log-odds."""

    start: float = 0.0
    depth: int = 3
    feature: list[np.ndarray] = field(default_factory=list)
    cut: list[np.ndarray] = field(default_factory=list)
    value: list[np.ndarray] = field(default_factory=list)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, cut, value in zip(self.feature, self.cut, self.value, strict=True):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            total += value[node - (2**self.depth - 1)]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.log_odds(x))) if len(x) else np.zeros(0)


def _cuts(x: np.ndarray) -> list[np.ndarray]:
    """Candidate thresholds of each feature: its distinct quantiles."""
    shares = np.linspace(0, 1, BINS + 1)[1:-1]
    return [np.unique(np.quantile(column, shares, method="lower")) for column in x.T]


def fit_trees(
    x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.2, ridge: float = 1.0, least: float = 2.0
) -> Trees:
    """Second-order boosting of the logistic loss over binned features.

    ``least`` is the smallest sum of second derivatives a leaf may have. Without both classes the trees
    are a constant.
    """
    share = (y.sum() + 0.5) / (len(y) + 1)
    model = Trees(start=float(np.log(share / (1 - share))), depth=depth)
    if not len(y) or y.min() == y.max():
        return model
    cuts = _cuts(x)
    binned = np.stack([np.searchsorted(c, column, side="left") for c, column in zip(cuts, x.T, strict=True)])
    odds = np.full(len(y), model.start)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-odds))
        slope, bend = y - p, np.maximum(p * (1 - p), 1e-9)
        node = np.zeros(len(y), dtype=np.int64)
        inner = 2**depth - 1
        feature, cut = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            at = node - first
            best = np.full(width, 1e-6)
            for f, column in enumerate(binned):
                key = at * BINS + column
                g = np.bincount(key, slope, width * BINS).reshape(width, BINS).cumsum(axis=1)
                h = np.bincount(key, bend, width * BINS).reshape(width, BINS).cumsum(axis=1)
                all_g, all_h = g[:, -1:], h[:, -1:]
                gain = g**2 / (h + ridge) + (all_g - g) ** 2 / (all_h - h + ridge) - all_g**2 / (all_h + ridge)
                gain[(h < least) | (all_h - h < least)] = 0
                gain = gain[:, : len(cuts[f])]
                if not gain.shape[1]:
                    continue
                where = gain.argmax(axis=1)
                top = gain[np.arange(width), where]
                better = np.flatnonzero(top > best)
                best[better] = top[better]
                feature[first + better] = f
                cut[first + better] = cuts[f][where[better]]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > cut[node])
        leaf = node - inner
        step = np.bincount(leaf, slope, 2**depth) / (np.bincount(leaf, bend, 2**depth) + ridge) * rate
        model.feature.append(feature)
        model.cut.append(cut)
        model.value.append(step)
        odds += step[leaf]
    return model


@dataclass
class Isotonic:
    """Monotone map from a score to a probability: straight lines between the pooled blocks."""

    x: np.ndarray
    y: np.ndarray

    def __call__(self, score: np.ndarray) -> np.ndarray:
        return np.interp(score, self.x, self.y) if len(self.x) else np.full(len(score), 0.5)


def fit_isotonic(score: np.ndarray, y: np.ndarray) -> Isotonic:
    """Pools neighbours that are out of order; equal scores are pooled first."""
    values, place = np.unique(score, return_inverse=True)
    blocks: list[list[float]] = []  # sum of y, rows, sum of score * rows
    n = np.bincount(place, minlength=len(values))
    s = np.bincount(place, y, minlength=len(values))
    for total, rows, at in zip(s, n, values, strict=True):
        blocks.append([total, rows, at * rows])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    return Isotonic(np.array([b[2] / b[1] for b in blocks]), np.array([b[0] / b[1] for b in blocks]))
