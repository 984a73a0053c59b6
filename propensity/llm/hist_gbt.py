"""Histogram gradient-boosted trees for a 0/1 label, flattened into arrays.

The fit works on binned columns (one histogram of gradients per node and
column); the model is five flat arrays, so scoring is a vectorised NumPy
traversal, and the trees can also be written as SQL expressions.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class FlatTrees:
    """Nodes of all trees in one numbering; a leaf points to itself."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log odds per row of ``x`` (rows x features); goes left where x <= threshold."""
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                node = np.where(x[rows, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
            out += self.value[node]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.margin(x), -35, 35))) if len(x) else np.zeros(0)


def constant(p: float) -> FlatTrees:
    """The model of no or one-sided evidence: every row gets ``p``."""
    p = min(max(p, 1e-6), 1 - 1e-6)
    none = np.zeros(0, dtype=np.int64)
    return FlatTrees(none, none, np.zeros(0), none, none, np.zeros(0), 0, float(np.log(p / (1 - p))))


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, n_trees: int = 60, depth: int = 4,
        rate: float = 0.15, max_bins: int = 64, reg: float = 1.0, min_hessian: float = 2.0) -> FlatTrees:
    """Boosted trees on the logistic loss, second-order gains. Deterministic."""
    weight = np.ones(len(y)) if weight is None else np.asarray(weight, dtype=float)
    total = weight.sum()
    if total == 0:
        return constant(0.5)
    p = float((weight * y).sum() / total)
    if p <= 0 or p >= 1:
        return constant((p * total + 0.5) / (total + 1))
    n, m = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, max_bins + 1)[1:-1], method="lower")) for j in range(m)]
    bins = np.stack([np.searchsorted(cuts[j], x[:, j], side="left") for j in range(m)])
    b = max_bins + 1
    base = float(np.log(p / (1 - p)))
    f = np.full(n, base)
    roots, feature, threshold, left, right, value = [], [], [], [], [], []

    def new() -> int:
        k = len(value)
        feature.append(0)
        threshold.append(np.inf)
        left.append(k)
        right.append(k)
        value.append(0.0)
        return k

    for _ in range(n_trees):
        prob = 1 / (1 + np.exp(-f))
        grad, hess = weight * (y - prob), np.maximum(weight * prob * (1 - prob), 1e-12)
        level, slot = [new()], np.zeros(n, dtype=np.int64)       # slot: index into level, -1 once settled
        roots.append(level[0])
        step = np.zeros(n)
        for d in range(depth + 1):
            live = slot >= 0
            g = np.bincount(slot[live], weights=grad[live], minlength=len(level))
            h = np.bincount(slot[live], weights=hess[live], minlength=len(level))
            best = np.full(len(level), 1e-7)
            pick = np.full((len(level), 2), -1)
            if d < depth:
                for j in range(m):
                    if not len(cuts[j]):
                        continue
                    key = slot[live] * b + bins[j][live]
                    gl = np.bincount(key, weights=grad[live], minlength=len(level) * b).reshape(-1, b).cumsum(1)
                    hl = np.bincount(key, weights=hess[live], minlength=len(level) * b).reshape(-1, b).cumsum(1)
                    gl, hl = gl[:, :len(cuts[j])], hl[:, :len(cuts[j])]
                    gr, hr = g[:, None] - gl, h[:, None] - hl
                    gain = gl**2 / (hl + reg) + gr**2 / (hr + reg) - (g**2 / (h + reg))[:, None]
                    gain[(hl < min_hessian) | (hr < min_hessian)] = -1
                    at = gain.argmax(1)
                    got = gain[np.arange(len(level)), at]
                    better = got > best
                    best[better], pick[better] = got[better], np.stack([np.full(len(level), j), at], 1)[better]
            nxt, go = [], np.full((len(level), 2), -1)
            for i, k in enumerate(level):
                if pick[i, 0] < 0:
                    value[k] = float(rate * g[i] / (h[i] + reg))
                else:
                    feature[k], threshold[k] = int(pick[i, 0]), float(cuts[pick[i, 0]][pick[i, 1]])
                    left[k], right[k] = new(), new()
                    go[i] = len(nxt), len(nxt) + 1
                    nxt += [left[k], right[k]]
            done = live.copy()
            done[live] = pick[slot[live], 0] < 0
            step[done] = np.asarray([value[k] for k in level])[slot[done]]
            on = live & ~done
            s = slot[on]
            side = (bins[pick[s, 0], np.flatnonzero(on)] > pick[s, 1]).astype(int)
            slot = np.full(n, -1)
            slot[on] = go[s, side]
            level = nxt
            if not level:
                break
        f += step
    return FlatTrees(np.array(roots), np.array(feature), np.array(threshold), np.array(left), np.array(right),
                     np.array(value), depth, base)
