"""Histogram gradient-boosted trees for two classes, flattened into arrays for vectorised traversal.

Fitting runs on a bounded sample in one process; scoring is a few numpy gathers a tree level for a whole batch.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np


class Forest(NamedTuple):
    """All trees end to end. A leaf points at itself, so that every row takes `depth` steps."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                node = np.where(x[rows, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
            out += self.value[node]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-self.margin(x)))


def fit_forest(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.15, bins: int = 64, min_rows: int = 10, l2: float = 1.0) -> Forest:
    """Logistic loss, Newton leaves, level-wise growth over quantile bins. One class alone, or no rows: a constant score."""
    n, width = x.shape
    prior = (float(y.sum()) + 0.5) / (n + 1.0)
    base = float(np.log(prior / (1 - prior)))
    nodes: list[list[float]] = []  # feature, threshold, left, right, value
    roots: list[int] = []
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) if n else np.zeros(0) for f in range(width)]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], 1) if n else np.zeros((0, width), np.int64)
    margin = np.full(n, base)
    for _ in range(trees if 0 < y.sum() < n else 0):
        p = 1.0 / (1.0 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        roots.append(len(nodes))
        nodes.append([0, 0.0, 0, 0, 0.0])
        at, level = np.full(n, roots[-1]), [roots[-1]]
        for step in range(depth + 1):
            slot = np.full(len(nodes), -1)
            slot[level] = np.arange(len(level))
            own = slot[at]
            live = np.flatnonzero(own >= 0)
            k = len(level)
            total_g, total_h = (np.bincount(own[live], w[live], k) for w in (g, h))
            for i, node in enumerate(level):
                nodes[node][2] = nodes[node][3] = node
                nodes[node][4] = -rate * total_g[i] / (total_h[i] + l2)
            if step == depth:
                break
            best = np.full(k, 1e-6)
            chosen = [(-1, 0)] * k
            for f in range(width):
                if not len(edges[f]):
                    continue
                m = len(edges[f]) + 1
                key = own[live] * m + binned[live, f]
                hist_g, hist_h, hist_n = (np.bincount(key, w, k * m).reshape(k, m).cumsum(1)[:, :-1] for w in (g[live], h[live], None))
                rest_g, rest_h = total_g[:, None] - hist_g, total_h[:, None] - hist_h
                gain = hist_g**2 / (hist_h + l2) + rest_g**2 / (rest_h + l2) - (total_g**2 / (total_h + l2))[:, None]
                rows = np.bincount(own[live], minlength=k)[:, None]
                gain[(hist_n < min_rows) | (rows - hist_n < min_rows)] = -1
                cut = gain.argmax(1)
                top = gain[np.arange(k), cut]
                for i in np.flatnonzero(top > best):
                    best[i], chosen[i] = top[i], (f, int(cut[i]))
            following = []
            for i, node in enumerate(level):
                f, cut = chosen[i]
                if f < 0:
                    continue
                kids = [len(nodes), len(nodes) + 1]
                nodes[node] = [f, float(edges[f][cut]), kids[0], kids[1], 0.0]
                nodes += [[0, 0.0, 0, 0, 0.0], [0, 0.0, 0, 0, 0.0]]
                inside = live[own[live] == i]
                at[inside] = np.where(binned[inside, f] <= cut, kids[0], kids[1])
                following += kids
            level = following
            if not level:
                break
        value = np.array([v[4] for v in nodes])
        margin += value[at]
    flat = np.array(nodes, np.float64).reshape(-1, 5)
    return Forest(flat[:, 0].astype(np.int64), flat[:, 1], flat[:, 2].astype(np.int64), flat[:, 3].astype(np.int64), flat[:, 4], np.array(roots, np.int64), depth, base)


def fit_isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators: knots (score, probability) of the non-decreasing least-squares fit."""
    at, place = np.unique(score, return_inverse=True)  # equal scores are one point from the start
    blocks: list[list[float]] = []  # sum, rows, lowest and highest score
    for s, t, n in zip(at.tolist(), np.bincount(place, y, len(at)).tolist(), np.bincount(place, minlength=len(at)).tolist()):
        blocks.append([t, n, s, s])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            t2, n2, _, high = blocks.pop()
            blocks[-1] = [blocks[-1][0] + t2, blocks[-1][1] + n2, blocks[-1][2], high]
    if not blocks:
        return np.array([0.0, 1.0]), np.array([0.0, 1.0])
    knots = np.array([[x, b[0] / b[1]] for b in blocks for x in sorted({b[2], b[3]})])
    return knots[:, 0], knots[:, 1]
