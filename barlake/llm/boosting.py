"""Gradient-boosted trees for the log loss, small and in numpy."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Boosted:
    """Trees as (feature, threshold, left, right, value) rows; feature -1: a leaf."""
    base: float
    trees: list[list[tuple[int, float, int, int, float]]] = field(default_factory=list)

    def margin(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.base)
        for tree in self.trees:
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(len(tree)):
                feature = np.array([tree[i][0] for i in range(len(tree))])[at]
                inner = feature >= 0
                if not inner.any():
                    break
                limit = np.array([t[1] for t in tree])[at]
                left, right = np.array([t[2] for t in tree])[at], np.array([t[3] for t in tree])[at]
                goes = x[np.arange(len(x)), np.maximum(feature, 0)] <= limit
                at = np.where(inner, np.where(goes, left, right), at)
            z += np.array([t[4] for t in tree])[at]
        return z

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30))) if len(x) else np.zeros(0)


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 40, depth: int = 4, rate: float = 0.3,
        ridge: float = 1.0, bins: int = 32) -> Boosted:
    """Second-order boosting; candidate thresholds are quantiles of each feature."""
    limits = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[:-1])) for f in range(x.shape[1])]
    mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model = Boosted(float(np.log(mean / (1 - mean))))
    z = np.full(len(y), model.base)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-z))
        grad, hess = p - y, np.maximum(p * (1 - p), 1e-6)
        tree: list[list] = []

        def grow(rows: np.ndarray, level: int) -> int:
            own = len(tree)
            g, h = grad[rows].sum(), hess[rows].sum()  # noqa: B023
            tree.append([-1, 0.0, 0, 0, float(-rate * g / (h + ridge))])  # noqa: B023
            if level == depth or len(rows) < 8:
                return own
            best = (1e-3, -1, 0.0)
            for f, cuts in enumerate(limits):
                goes = x[rows, f][:, None] <= cuts[None, :]
                gl, hl = grad[rows] @ goes, hess[rows] @ goes  # noqa: B023
                gain = gl ** 2 / (hl + ridge) + (g - gl) ** 2 / (h - hl + ridge) - g ** 2 / (h + ridge)
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (gain[k], f, float(cuts[k]))
            if best[1] >= 0:
                goes = x[rows, best[1]] <= best[2]
                if goes.any() and not goes.all():
                    left, right = grow(rows[goes], level + 1), grow(rows[~goes], level + 1)
                    tree[own][:4] = [best[1], best[2], left, right]  # noqa: B023
            return own

        grow(np.arange(len(y)), 0)
        model.trees.append([tuple(t) for t in tree])
        z = z + Boosted(0.0, [model.trees[-1]]).margin(x)
    return model
