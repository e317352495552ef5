"""Histogram gradient-boosted trees for a binary label, flattened into arrays.

Features are cut into at most 64 bins at quantiles; every node's best split is
read off gradient histograms.  Features may be given a monotonic direction: a
split against it is refused, and the values below a split are held on their
side of its midpoint, so that the whole score is monotonic in the feature.
A fitted model is five arrays; scoring walks all rows and trees at once, one
level at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """Node arrays of all trees; a leaf is its own child."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of ``x``."""
        raw = np.full(len(x), self.base)
        for a in range(0, len(x), 4096):
            part = x[a : a + 4096]
            rows = np.arange(len(part))[:, None]
            node = np.broadcast_to(self.roots, (len(part), len(self.roots)))
            for _ in range(self.depth):
                node = np.where(part[rows, self.feature[node]] <= self.cut[node], self.left[node], self.right[node])
            raw[a : a + 4096] += self.value[node].sum(1)
        return 1 / (1 + np.exp(-np.clip(raw, -40, 40)))


class _Grower:
    def __init__(self, binned, edges, grad, hess, direction, depth, l2, min_hess, rate):
        self.binned, self.edges, self.grad, self.hess, self.direction = binned, edges, grad, hess, direction
        self.max_depth, self.l2, self.min_hess, self.rate = depth, l2, min_hess, rate
        self.nodes: list[list] = []

    def weight(self, g, h, lo, hi):
        return np.clip(-g / (h + self.l2), lo, hi)

    def gain(self, g, h, w):
        return -(g * w + 0.5 * (h + self.l2) * w * w)

    def grow(self, rows: np.ndarray, depth: int, lo: float, hi: float) -> int:
        at = len(self.nodes)
        g, h = self.grad[rows].sum(), self.hess[rows].sum()
        w = float(self.weight(g, h, lo, hi))
        self.nodes.append([0, np.inf, at, at, w * self.rate])
        if depth == self.max_depth or len(rows) < 2:
            return at
        best = (1e-6, None)
        for f, edges in enumerate(self.edges):
            if not len(edges):
                continue
            b = self.binned[rows, f]
            gl = np.bincount(b, self.grad[rows], len(edges) + 1).cumsum()[:-1]
            hl = np.bincount(b, self.hess[rows], len(edges) + 1).cumsum()[:-1]
            wl, wr = self.weight(gl, hl, lo, hi), self.weight(g - gl, h - hl, lo, hi)
            gain = self.gain(gl, hl, wl) + self.gain(g - gl, h - hl, wr) - self.gain(g, h, w)
            bad = (hl < self.min_hess) | (h - hl < self.min_hess)
            if self.direction[f]:
                bad |= (wr - wl) * self.direction[f] < 0
            gain[bad] = -np.inf
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (gain[k], (f, k, wl[k], wr[k]))
        if best[1] is None:
            return at
        f, k, wl, wr = best[1]
        go = self.binned[rows, f] <= k
        mid = (wl + wr) / 2
        bounds = [(lo, hi), (lo, hi)]
        if self.direction[f] > 0:
            bounds = [(lo, mid), (mid, hi)]
        elif self.direction[f] < 0:
            bounds = [(mid, hi), (lo, mid)]
        left = self.grow(rows[go], depth + 1, *bounds[0])
        right = self.grow(rows[~go], depth + 1, *bounds[1])
        self.nodes[at] = [f, self.edges[f][k], left, right, w * self.rate]
        return at


def fit(x: np.ndarray, y: np.ndarray, directions: dict[int, int] | None = None, trees: int = 60, depth: int = 4, rate: float = 0.15, l2: float = 2.0, min_hess: float = 3.0, bins: int = 64) -> Trees:
    """Fit to rows ``x`` and labels ``y`` (0 or 1).

    ``directions`` gives features that may only raise (+1) or lower (-1) the
    score.  Without rows of both labels the model is a constant.
    """
    share = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(share / (1 - share)))
    if not 0 < y.sum() < len(y):
        one = np.zeros(1, np.int64)
        return Trees(one, np.array([np.inf]), one, one, np.zeros(1), one, 0, base)
    direction = np.zeros(x.shape[1], int)
    for f, d in (directions or {}).items():
        direction[f] = d
    edges = []
    for f in range(x.shape[1]):
        q = np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1]))
        edges.append(q[q < x[:, f].max()])
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], 1)
    raw, nodes, roots = np.full(len(y), base), [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        grower = _Grower(binned, edges, p - y, p * (1 - p), direction, depth, l2, min_hess, rate)
        grower.grow(np.arange(len(y)), 0, -np.inf, np.inf)
        own = np.array(grower.nodes)
        own[:, 2:4] += len(nodes)
        one = Trees(own[:, 0].astype(np.int64), own[:, 1], own[:, 2].astype(np.int64) - len(nodes), own[:, 3].astype(np.int64) - len(nodes), own[:, 4], np.zeros(1, np.int64), depth, 0.0)
        node = np.zeros(len(y), np.int64)
        for _ in range(depth):
            node = np.where(x[np.arange(len(y)), one.feature[node]] <= one.cut[node], one.left[node], one.right[node])
        raw += one.value[node]
        roots.append(len(nodes))
        nodes.extend(own.tolist())
    flat = np.array(nodes)
    return Trees(flat[:, 0].astype(np.int64), flat[:, 1], flat[:, 2].astype(np.int64), flat[:, 3].astype(np.int64), flat[:, 4], np.array(roots), depth, base)
