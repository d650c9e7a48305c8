"""Linear models of bounded training samples."""

from __future__ import annotations

import numpy as np


class Rows:
    """Sparse rows of features: indices and values end to end, with where each row starts."""

    def __init__(self, indices: list[np.ndarray], values: list[np.ndarray] | None = None):
        self.counts = np.array([len(x) for x in indices], dtype=np.int64)
        self.indices = np.concatenate(indices) if indices else np.zeros(0, dtype=np.int64)
        self.values = np.concatenate(values) if values else np.ones(len(self.indices))
        self.rows = np.repeat(np.arange(len(indices)), self.counts)

    def dot(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, self.values * weights[self.indices], minlength=len(self.counts))

    def back(self, errors: np.ndarray, dim: int) -> np.ndarray:
        return np.bincount(self.indices, self.values * errors[self.rows], minlength=dim)


def fit(rows, y: np.ndarray, dim: int, *, loss: str, l2: float, steps: int = 200, use: np.ndarray | None = None):
    """Weights and intercept for labels -1/+1, classes weighted alike.

    ``loss`` is "logistic" or "hinge" (squared hinge: a linear support vector
    machine). ``rows`` is `Rows` or a dense matrix; ``use`` masks training rows.
    Without both classes the model is the constant that the labels give.
    """
    use = np.ones(len(y), dtype=bool) if use is None else use
    positive, negative = (use & (y > 0)).sum(), (use & (y < 0)).sum()
    if not positive or not negative:
        return np.zeros(dim), 8.0 if positive else -8.0
    share = np.where(y > 0, 0.5 / positive, 0.5 / negative) * use
    dense = isinstance(rows, np.ndarray)
    w, b = np.zeros(dim), 0.0
    m, v = np.zeros(dim + 1), np.zeros(dim + 1)
    for step in range(1, steps + 1):
        margin = y * ((rows @ w.astype(rows.dtype) if dense else rows.dot(w)) + b)
        if loss == "logistic":
            error = -y * share / (1 + np.exp(np.clip(margin, -30, 30)))
        else:
            error = -2 * y * share * np.clip(1 - margin, 0, None)
        gradient = np.append((rows.T @ error.astype(rows.dtype) if dense else rows.back(error, dim)) + l2 * w, error.sum())
        m = 0.9 * m + 0.1 * gradient
        v = 0.99 * v + 0.01 * gradient * gradient
        rate = 0.1 * (1 - step / (steps + 1))
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-10)
        w -= move[:-1]
        b -= move[-1]
    return w, b


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))
