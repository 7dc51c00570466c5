"""Gradient-boosted trees for two classes over a small matrix."""

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Settings:
    rounds: int = 80
    depth: int = 4
    rate: float = 0.3
    bins: int = 32
    least: float = 1.0  # hessian in a leaf
    ridge: float = 1.0


@dataclass(frozen=True)
class Trees:
    """Complete trees: inner nodes by level, then the leaves."""

    base: float
    column: np.ndarray  # trees x inner nodes
    limit: np.ndarray
    leaf: np.ndarray  # trees x leaves

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Log odds of class 1."""
        total = np.full(len(rows), self.base)
        here = np.arange(len(rows))
        inner = self.column.shape[1]
        for column, limit, leaf in zip(self.column, self.limit, self.leaf):
            node = np.zeros(len(rows), np.int64)
            while len(node) and node[0] < inner:
                node = 2 * node + 1 + (rows[here, column[node]] > limit[node])
            total += leaf[node - inner]
        return total


def fit(rows: np.ndarray, labels: np.ndarray, settings: Settings = Settings()) -> Trees:
    """Newton boosting on the logistic loss, with histograms of quantile bins."""
    n, columns = rows.shape
    edges = [np.unique(np.quantile(rows[:, c], np.linspace(0, 1, settings.bins + 1)[1:-1])) for c in range(columns)]
    binned = np.stack([np.searchsorted(e, rows[:, c], side="left") for c, e in enumerate(edges)], 1)
    width = settings.bins
    cell = binned + np.arange(columns) * width
    share = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    score = np.full(n, base)
    inner = (1 << settings.depth) - 1
    found = []
    for _ in range(settings.rounds):
        chance = 1 / (1 + np.exp(-score))
        slope, bend = labels - chance, chance * (1 - chance)
        column, limit = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(n, np.int64)
        for level in range(settings.depth):
            first, count = (1 << level) - 1, 1 << level
            index = ((node - first)[:, None] * (columns * width) + cell).ravel()
            shape = (count, columns, width)
            g = np.bincount(index, np.repeat(slope, columns), count * columns * width).reshape(shape).cumsum(2)
            h = np.bincount(index, np.repeat(bend, columns), count * columns * width).reshape(shape).cumsum(2)
            all_g, all_h = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + settings.ridge) + (all_g - g) ** 2 / (all_h - h + settings.ridge) - all_g**2 / (all_h + settings.ridge)
            gain[(h < settings.least) | (all_h - h < settings.least)] = -np.inf
            best = gain.reshape(count, -1).argmax(1)
            for k in range(count):
                c, b = divmod(int(best[k]), width)
                if gain[k, c, b] > 1e-6 and b < len(edges[c]):
                    column[first + k], limit[first + k] = c, edges[c][b]
            node = 2 * node + 1 + (rows[np.arange(n), column[node]] > limit[node])
        at = node - inner
        g = np.bincount(at, slope, inner + 1)
        h = np.bincount(at, bend, inner + 1)
        leaf = settings.rate * g / (h + settings.ridge)
        score += leaf[at]
        found.append((column, limit, leaf))
    return Trees(base, *(np.stack(x) for x in zip(*found)))
