"""Follow-the-regularised-leader for sparse multinomial logistic regression.

The model is fitted on a bounded sample (the callers document the bound);
its size is classes x buckets whatever the corpus.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

Row = tuple[np.ndarray, np.ndarray]  # feature indices, values


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=0))
    return e / e.sum(axis=0)


class SparseFTRL:
    """FTRL-proximal with elastic-net penalties: l1 keeps weights at exactly zero, l2 shrinks the rest."""

    def __init__(self, classes: int, buckets: int, alpha=0.5, beta=1.0, l1=0.02, l2=0.05) -> None:
        self.z = np.zeros((classes, buckets + 1))  # the last bucket is the bias
        self.n = np.zeros((classes, buckets + 1))
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def _weights(self, z: np.ndarray, n: np.ndarray) -> np.ndarray:
        step = (self.beta + np.sqrt(n)) / self.alpha + self.l2
        return np.where(np.abs(z) <= self.l1, 0.0, (np.sign(z) * self.l1 - z) / step)

    def fit(self, rows: Sequence[Row], labels: Sequence[int], epochs: int, seed: int = 7) -> SparseFTRL:
        order = np.random.default_rng(seed)
        bias = self.z.shape[1] - 1
        for _ in range(epochs):
            for i in order.permutation(len(rows)):
                at, x = np.append(rows[i][0], bias), np.append(rows[i][1], 1.0)
                z, n = self.z[:, at], self.n[:, at]
                w = self._weights(z, n)
                g = softmax(w @ x)
                g[labels[i]] -= 1.0
                g = np.outer(g, x)
                root = np.sqrt(n + g * g)
                self.z[:, at] = z + g - (root - np.sqrt(n)) / self.alpha * w
                self.n[:, at] = n + g * g
        return self

    @property
    def weights(self) -> np.ndarray:
        return self._weights(self.z, self.n).astype(np.float32)


def logits(weights: np.ndarray, row: Row) -> np.ndarray:
    return weights[:, row[0]] @ row[1] + weights[:, -1]


def temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits (classes x rows) that minimises the log loss, by golden section on its log (0.25 to 20)."""
    if scores.shape[1] == 0:
        return 1.0

    def loss(log_t: float) -> float:
        p = softmax(scores / np.exp(log_t))
        return -np.log(np.maximum(p[labels, np.arange(len(labels))], 1e-12)).mean()

    low, high, ratio = np.log(0.25), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        if loss(a) <= loss(b):
            high = b
        else:
            low = a
    return float(np.exp((low + high) / 2))
