"""Small numpy models that are fitted on bounded samples on the driver."""

from __future__ import annotations

import numpy as np


class Sparse:
    """Rows of distinct feature ids, all with value 1 / sqrt(row length + 1) unless ``unit``."""

    def __init__(self, rows: list[np.ndarray], unit: bool = False):
        self.sizes = np.array([len(r) for r in rows], dtype=np.int64)
        self.ids = np.concatenate(rows).astype(np.int64) if rows else np.zeros(0, dtype=np.int64)
        self.at = np.repeat(np.arange(len(rows)), self.sizes)
        self.scale = np.ones(len(rows)) if unit else 1 / np.sqrt(self.sizes + 1.0)

    def __len__(self) -> int:
        return len(self.sizes)

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.at, weights=w[self.ids], minlength=len(self)) * self.scale

    def back(self, e: np.ndarray, dim: int) -> np.ndarray:
        return np.bincount(self.ids, weights=(e * self.scale)[self.at], minlength=dim)


class Dense:
    def __init__(self, x: np.ndarray):
        self.x = x

    def __len__(self) -> int:
        return len(self.x)

    def dot(self, w: np.ndarray) -> np.ndarray:
        return self.x @ w

    def back(self, e: np.ndarray, dim: int) -> np.ndarray:
        return self.x.T @ e


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def logistic(x, y: np.ndarray, dim: int, weight: np.ndarray | None = None, l2: float = 1e-4, steps: int = 120, rate: float = 0.5) -> np.ndarray:
    """Weights (the last one the constant) of a logistic regression, full-batch Adagrad."""
    w, seen = np.zeros(dim + 1), np.full(dim + 1, 1e-8)
    share = np.ones(len(y)) if weight is None else weight
    for _ in range(steps):
        e = (sigmoid(x.dot(w[:-1]) + w[-1]) - y) * share / max(share.sum(), 1e-9)
        g = np.append(x.back(e, dim) + l2 * w[:-1], e.sum())
        seen += g * g
        w -= rate * g / np.sqrt(seen)
    return w


def margin(x, w: np.ndarray) -> np.ndarray:
    return x.dot(w[:-1]) + w[-1]


def newton_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 40) -> np.ndarray:
    """Weights (the last one the constant) of a logistic regression on a few dense columns."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = sigmoid(x @ w)
        h = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(len(w))
        w -= np.linalg.solve(h, x.T @ (p - y) + ridge * w)
    return w


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def multinomial(x: np.ndarray, y: np.ndarray, classes: int, l2: float = 1e-3, steps: int = 150, rate: float = 0.5) -> np.ndarray:
    """Weights (a row a column of ``x``, which ends with the constant 1) of a softmax regression, full-batch Adagrad."""
    w, seen, target = np.zeros((x.shape[1], classes)), np.full((x.shape[1], classes), 1e-8), np.eye(classes)[y]
    for _ in range(steps):
        g = x.T @ (softmax(x @ w) - target) / len(x) + l2 * w
        seen += g * g
        w -= rate * g / np.sqrt(seen)
    return w
