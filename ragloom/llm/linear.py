"""Small numeric models: logistic regression on sparse binary features."""

from __future__ import annotations

import numpy as np


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


class Sparse:
    """Rows of ascending column numbers (compressed rows of ones)."""

    def __init__(self, columns: np.ndarray, offsets: np.ndarray, width: int):
        self.columns, self.offsets, self.width = columns, offsets, width
        small = np.int64 if len(columns) < 1 << 22 else np.int32  # what is counted with often, and what is only large
        self.row = np.repeat(np.arange(len(offsets) - 1, dtype=small), np.diff(offsets))

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.columns], minlength=len(self))

    def back(self, r: np.ndarray, step: int = 1 << 20) -> np.ndarray:
        out = np.zeros(self.width)
        for i in range(0, len(self.columns), step):
            out += np.bincount(self.columns[i:i + step], r[self.row[i:i + step]], minlength=self.width)
        return out

    def rows(self, keep: np.ndarray) -> Sparse:
        inside = keep[self.row]
        n = np.diff(self.offsets)[keep]
        return Sparse(self.columns[inside], np.concatenate([[0], np.cumsum(n)]), self.width)


def fit_logistic(x: Sparse, extra: np.ndarray, y: np.ndarray, l2: float = 3e-4, steps: int = 300, rate: float = 0.1) -> tuple[np.ndarray, np.ndarray, float]:
    """Weights of sparse columns, of dense ``extra`` columns, and the bias, by
    full-batch Adam on the mean log loss, both classes with the same total
    weight (a class that does not occur leaves the bias far on the other side)."""
    n, pos = max(len(y), 1), y.sum()
    if pos == 0 or pos == len(y):
        return np.zeros(x.width), np.zeros(extra.shape[1]), (-6.0 if pos == 0 else 6.0)
    cost = np.where(y > 0, n / (2 * pos), n / (2 * (n - pos))) / n
    w = np.zeros(x.width + extra.shape[1] + 1)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        r = cost * (sigmoid(x.dot(w[:x.width]) + extra @ w[x.width:-1] + w[-1]) - y)
        g = np.concatenate([x.back(r), extra.T @ r, [r.sum()]])
        g[:-1] += l2 * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w[:x.width], w[x.width:-1], float(w[-1])
