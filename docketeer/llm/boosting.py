"""Gradient-boosted trees for small bounded training sets: logistic loss, binned features, full trees of fixed depth."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Trees:
    base: float
    depth: int
    features: list[np.ndarray] = field(default_factory=list)  # of each inner node, breadth first
    cuts: list[np.ndarray] = field(default_factory=list)  # rows above the cut go right
    leaves: list[np.ndarray] = field(default_factory=list)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Log odds of each row of x."""
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, leaf in zip(self.features, self.cuts, self.leaves, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            out += leaf[node - len(feature)]
        return out

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.scores(x), -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, rate: float = 0.25, bins: int = 32, smooth: float = 1.0) -> Trees:
    """x: rows x features, y: 0 or 1.  Rows without features or of one class give a constant model."""
    share = (y.sum() + 0.5) / (len(y) + 1.0)
    model = Trees(float(np.log(share / (1 - share))), depth)
    if not len(y) or y.min() == y.max():
        return model
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], axis=1)  # bin > i: x above edges[i]
    score, inner = np.full(len(y), model.base), 2**depth - 1
    for _ in range(trees):
        p = 1.0 / (1.0 + np.exp(-score))
        gradient, hessian = y - p, p * (1 - p)
        feature, cut, node = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(len(y), np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            place, best = node - first, np.full(count, 1e-9)
            for j, e in enumerate(edges):
                if not len(e):
                    continue
                width = len(e) + 1
                cell = place * width + binned[:, j]
                g, h = (np.bincount(cell, w, count * width).reshape(count, width) for w in (gradient, hessian))
                gl, hl = np.cumsum(g, 1)[:, :-1], np.cumsum(h, 1)[:, :-1]
                gt, ht = g.sum(1, keepdims=True), h.sum(1, keepdims=True)
                gain = gl**2 / (hl + smooth) + (gt - gl) ** 2 / (ht - hl + smooth) - gt**2 / (ht + smooth)
                at = gain.argmax(1)
                top = gain[np.arange(count), at]
                for k in np.flatnonzero(top > best):
                    best[k], feature[first + k], cut[first + k] = top[k], j, e[at[k]]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > cut[node])
        leaf_of = node - inner
        g, h = (np.bincount(leaf_of, w, inner + 1) for w in (gradient, hessian))
        leaf = rate * g / (h + smooth)
        score += leaf[leaf_of]
        model.features.append(feature)
        model.cuts.append(cut)
        model.leaves.append(leaf)
    return model


def threshold_for(probabilities: np.ndarray, y: np.ndarray, precision: float, least: float = 0.5, weights: np.ndarray | None = None) -> float:
    """The lowest score, at least `least`, from which on upward accepted rows (by weight) reach the precision; above 1 if none."""
    if not len(y) or not y.any():
        return 2.0
    order = np.argsort(-probabilities, kind="stable")
    weight = np.ones(len(y)) if weights is None else weights[order]
    p, hits = probabilities[order], np.cumsum(y[order] * weight)
    good = (hits / np.cumsum(weight) >= precision) & (p >= least) & np.append(p[1:] < p[:-1], True)
    return float(p[np.flatnonzero(good)[-1]]) if good.any() else 2.0
