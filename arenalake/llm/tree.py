"""A decision tree over numbers: binary splits at the least Gini impurity, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Tree:
    """Nodes in arrays: the feature split on (-1: a leaf), its threshold, both children, the share of class 1."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    share: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        """True where the share of class 1 in a row's leaf is one half or more."""
        at = np.zeros(len(x), np.int64)
        while (inner := np.flatnonzero(self.feature[at] >= 0)).size:
            node = at[inner]
            down = x[inner, self.feature[node]] <= self.threshold[node]
            at[inner] = np.where(down, self.left[node], self.right[node])
        return self.share[at] >= 0.5


def best_split(x: np.ndarray, y: np.ndarray, least: int) -> tuple[float, int, float] | None:
    """Weighted impurity, feature and threshold of the best split; the first feature wins ties."""
    found = None
    n = len(y)
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        v, ones = x[order, f], np.cumsum(y[order])
        cut = np.flatnonzero(v[1:] > v[:-1]) + 1  # rows to the left
        cut = cut[(cut >= least) & (n - cut >= least)]
        if not cut.size:
            continue
        a, b = ones[cut - 1], ones[-1] - ones[cut - 1]
        impurity = a * (1 - a / cut) + b * (1 - b / (n - cut))
        k = int(impurity.argmin())
        if found is None or impurity[k] < found[0] - 1e-12:
            found = (float(impurity[k]), f, float((v[cut[k]] + v[cut[k] - 1]) / 2))
    return found


def fit_tree(x: np.ndarray, y: np.ndarray, depth: int = 8, least: int = 2) -> Tree:
    """Splits until leaves are pure, ``depth`` is reached, or a leaf would have fewer than ``least`` rows."""
    nodes: list[list] = []

    def grow(rows: np.ndarray, left: int) -> int:
        own = y[rows]
        at = len(nodes)
        nodes.append([-1, 0.0, -1, -1, float(own.mean())])
        ones = int(own.sum())
        if left and 0 < ones < len(own):
            split = best_split(x[rows], own, least)
            if split and split[0] < ones * (1 - ones / len(own)) - 1e-12:
                _, f, threshold = split
                down = x[rows, f] <= threshold
                nodes[at][:4] = [f, threshold, grow(rows[down], left - 1), grow(rows[~down], left - 1)]
        return at

    grow(np.arange(len(y)), depth)
    columns = list(zip(*nodes))
    return Tree(*(np.array(c, t) for c, t in zip(columns, (np.int64, float, np.int64, np.int64, float))))
