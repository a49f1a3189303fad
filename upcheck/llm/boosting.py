"""Gradient-boosted trees for two classes over binned dense features, and isotonic calibration.

Models are fitted here on bounded tables, whose rows may have weights (``boosting_tasks`` takes any number of
rows), and are small: trees are complete, a few levels deep, and held in arrays, so tasks apply them to many rows
at a time.
"""

from __future__ import annotations

import numpy as np

BINS = 32


class Boosted:
    """Logistic boosting; ``margin`` is the log odds of class 1."""

    def __init__(self, trees: int = 60, depth: int = 3, rate: float = 0.2, ridge: float = 1.0):
        self.trees, self.depth, self.rate, self.ridge = trees, depth, rate, ridge

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> "Boosted":
        n, width = x.shape
        w = np.ones(n) if weight is None else weight
        right = (w * y).sum()
        self.prior = float(np.log((right + 1.0) / (w.sum() - right + 1.0)))
        edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) if n else np.zeros(0) for f in range(width)]
        binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1) if width else np.zeros((n, 0), int)
        inner = (1 << self.depth) - 1
        self.feature = np.zeros((self.trees, inner), np.int64)
        self.cut = np.full((self.trees, inner), np.inf)
        self.value = np.zeros((self.trees, inner + 1))
        margin = np.full(n, self.prior)
        for t in range(self.trees):
            p = 1 / (1 + np.exp(-margin))
            g, h = w * (p - y), w * p * (1 - p)
            node = np.zeros(n, np.int64)
            for level in range(self.depth):
                first, count = (1 << level) - 1, 1 << level
                best = np.full(count, 1e-9)
                chosen = np.full(count, -1)
                at = np.zeros(count, np.int64)
                for f in range(width):
                    slot = (node - first) * (BINS + 1) + binned[:, f]
                    gs = np.bincount(slot, g, count * (BINS + 1)).reshape(count, -1).cumsum(axis=1)
                    hs = np.bincount(slot, h, count * (BINS + 1)).reshape(count, -1).cumsum(axis=1)
                    gt, ht = gs[:, -1:], hs[:, -1:]
                    gain = gs ** 2 / (hs + self.ridge) + (gt - gs) ** 2 / (ht - hs + self.ridge) - gt ** 2 / (ht + self.ridge)
                    gain = gain[:, :len(edges[f])]
                    if gain.shape[1]:
                        k = gain.argmax(axis=1)
                        top = gain[np.arange(count), k]
                        better = top > best
                        best, chosen, at = np.where(better, top, best), np.where(better, f, chosen), np.where(better, k, at)
                for c in np.flatnonzero(chosen >= 0):
                    self.feature[t, first + c], self.cut[t, first + c] = chosen[c], edges[chosen[c]][at[c]]
                node = 2 * node + 1 + (x[np.arange(n), self.feature[t, node]] > self.cut[t, node])
            leaf = node - inner
            gs, hs = np.bincount(leaf, g, inner + 1), np.bincount(leaf, h, inner + 1)
            self.value[t] = -self.rate * gs / (hs + self.ridge)
            margin += self.value[t, leaf]
        return self

    def margin(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.prior), np.arange(len(x))
        for t in range(self.trees):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, self.feature[t, node]] > self.cut[t, node])
            out += self.value[t, node - self.feature.shape[1]]
        return out


def pool(blocks: list[list], total, weight, low, high) -> None:
    """Add a block (weighted sum, weight, least and greatest score) after those of lower scores, and join neighbours until means rise."""
    blocks.append([total, weight, low, high])
    while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
        last = blocks.pop()
        blocks[-1] = [blocks[-1][0] + last[0], blocks[-1][1] + last[1], blocks[-1][2], last[3]]


def isotonic(score: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Points of the rising function of ``score`` that fits ``y`` best (pool adjacent violators)."""
    order = np.argsort(score, kind="stable")
    weight = np.ones(len(y)) if weight is None else weight
    blocks: list[list[float]] = []
    for s, v, w in zip(score[order].tolist(), y[order].tolist(), weight[order].tolist()):
        pool(blocks, v * w, w, s, s)
    xs = [e for b in blocks for e in (b[2], b[3])]
    ys = [b[0] / b[1] for b in blocks for _ in (0, 1)]
    return np.array(xs), np.array(ys)


class Calibrated:
    """Boosted trees whose margins become rates by an isotonic fit on folds left out of training."""

    def __init__(self, folds: int = 4, **options):
        self.folds, self.options = folds, options

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> "Calibrated":
        w = np.ones(len(y)) if weight is None else weight
        fold = np.arange(len(y)) % self.folds
        held = np.zeros(len(y))
        for f in range(self.folds):
            if (fold == f).any():
                held[fold == f] = Boosted(**self.options).fit(x[fold != f], y[fold != f], w[fold != f]).margin(x[fold == f])
        self.held = held  # margins of the left-out folds
        self.points = isotonic(held, y.astype(float), w) if len(y) else (np.zeros(1), np.zeros(1))
        self.model = Boosted(**self.options).fit(x, y, w)
        return self

    def rate(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.model.margin(x), *self.points), 0.0, 1.0) if len(x) else np.zeros(0)
