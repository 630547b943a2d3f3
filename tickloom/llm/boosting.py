"""Gradient-boosted trees with monotone constraints, trained on a bounded sample in numpy and
flattened into node arrays for vectorised scoring."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class FlatTrees:
    """All trees as arrays [tree, node]; node 0 is the root, a leaf points at itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    base: float
    depth: int

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Raw scores (log odds) of the rows of ``x``."""
        rows = np.arange(len(x))
        total = np.full(len(x), self.base)
        for t in range(len(self.feature)):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                goes_left = x[rows, self.feature[t][node]] <= self.threshold[t][node]
                node = np.where(goes_left, self.left[t][node], self.right[t][node])
            total += self.value[t][node]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.margin(x), -40, 40)))


def fit(
    x: np.ndarray, y: np.ndarray, signs: np.ndarray, trees: int = 60, depth: int = 4,
    rate: float = 0.2, bins: int = 48, l2: float = 1.0, min_rows: int = 5,
) -> FlatTrees:
    """Newton boosting of the log loss over quantile bins.

    ``signs[f]`` is +1 / -1 if the score may only rise / fall with feature f, else 0: a split that
    breaks the order is refused, and the middle of its two values bounds the leaves below it.
    """
    n, width = x.shape
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    nodes = 2 ** (depth + 1) - 1
    shape = (trees, nodes)
    own = np.broadcast_to(np.arange(nodes), shape)
    flat = FlatTrees(np.zeros(shape, np.int64), np.full(shape, np.inf), own.copy(), own.copy(), np.zeros(shape), 0.0, depth)
    mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    flat.base = float(np.log(mean / (1 - mean)))
    score = np.full(n, flat.base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = p - y, np.maximum(p * (1 - p), 1e-9)
        limits = {0: (-np.inf, np.inf)}
        members = {0: np.arange(n)}
        for node in range(nodes):
            if node not in members:
                continue
            rows = members.pop(node)
            low, high = limits[node]
            gr, hr = g[rows], h[rows]
            total_g, total_h = gr.sum(), hr.sum()
            value = float(np.clip(-total_g / (total_h + l2), low, high))
            flat.value[t, node] = rate * value
            if 2 * node + 2 >= nodes or len(rows) < 2 * min_rows:
                continue
            best = (1e-6, -1, -1, 0.0, 0.0)
            for f in range(width):
                if not len(edges[f]):
                    continue
                b = binned[rows, f]
                size = len(edges[f]) + 1
                lg = np.cumsum(np.bincount(b, gr, size))[:-1]
                lh = np.cumsum(np.bincount(b, hr, size))[:-1]
                lc = np.cumsum(np.bincount(b, minlength=size))[:-1]
                vl = np.clip(-lg / (lh + l2), low, high)
                vr = np.clip(-(total_g - lg) / (total_h - lh + l2), low, high)
                gain = -(lg * vl + 0.5 * (lh + l2) * vl**2 + (total_g - lg) * vr + 0.5 * (total_h - lh + l2) * vr**2)
                gain += total_g * value + 0.5 * (total_h + l2) * value**2
                bad = (lc < min_rows) | (len(rows) - lc < min_rows)
                if signs[f]:
                    bad |= signs[f] * (vr - vl) < 0
                gain[bad] = -np.inf
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (float(gain[k]), f, k, float(vl[k]), float(vr[k]))
            _, f, k, vl, vr = best
            if f < 0:
                continue
            left, right = 2 * node + 1, 2 * node + 2
            flat.feature[t, node], flat.threshold[t, node] = f, edges[f][k]
            flat.left[t, node], flat.right[t, node] = left, right
            goes = binned[rows, f] <= k
            members[left], members[right] = rows[goes], rows[~goes]
            limits[left] = limits[right] = (low, high)
            if signs[f]:
                middle = (vl + vr) / 2
                limits[left] = (low, middle) if signs[f] > 0 else (middle, high)
                limits[right] = (middle, high) if signs[f] > 0 else (low, middle)
        node = np.zeros(n, dtype=np.int64)
        every = np.arange(n)
        for _ in range(depth):
            goes = x[every, flat.feature[t][node]] <= flat.threshold[t][node]
            node = np.where(goes, flat.left[t][node], flat.right[t][node])
        score += flat.value[t][node]
    return flat
