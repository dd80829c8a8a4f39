"""Follow-the-regularised-leader (proximal) for sparse linear models with elastic net.

Fits on a bounded sample of examples that a caller has gathered; an example is a pair of
arrays (feature numbers, values). Per-coordinate learning rates; the L1 part keeps
weights that carry no signal at exactly zero.
"""

from __future__ import annotations

import numpy as np

Example = tuple[np.ndarray, np.ndarray]


class Ftrl:
    """``classes`` > 1: softmax over that many outputs; 1: logistic."""

    def __init__(self, features: int, classes: int = 1, alpha: float = 0.5, beta: float = 1.0,
                 l1: float = 0.05, l2: float = 0.01):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z = np.zeros((features + 1, classes), np.float32)     # the last row: intercepts
        self.n = np.zeros((features + 1, classes), np.float32)

    def _weights(self, z: np.ndarray, n: np.ndarray) -> np.ndarray:
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0)
        return -shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def weights(self) -> np.ndarray:
        return self._weights(self.z, self.n)

    def step(self, example: Example, target: np.ndarray) -> None:
        at = np.append(example[0], len(self.z) - 1)
        x = np.append(example[1], 1).astype(np.float32)[:, None]
        z, n = self.z[at], self.n[at]
        w = self._weights(z, n)
        g = x * (probabilities((x * w).sum(0)) - target)
        grown = n + g * g
        self.z[at] = z + g - (np.sqrt(grown) - np.sqrt(n)) / self.alpha * w
        self.n[at] = grown

    def fit(self, examples: list[Example], targets: np.ndarray, epochs: int, seed: int = 1) -> Ftrl:
        """``targets``: one row per example. The order of each pass is drawn from ``seed``."""
        order = np.random.default_rng(seed)
        for _ in range(epochs):
            for i in order.permutation(len(examples)):
                self.step(examples[i], targets[i])
        return self


def probabilities(margin: np.ndarray) -> np.ndarray:
    """Softmax over the last axis, or the logistic function if it has one entry."""
    if margin.shape[-1] == 1:
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
    e = np.exp(margin - margin.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def best_temperature(margins: np.ndarray, classes: np.ndarray) -> float:
    """The divisor of margins with the least negative log likelihood, by golden section."""
    if not len(margins) or margins.shape[1] < 2:
        return 1.0

    def loss(log_t: float) -> float:
        m = margins / np.exp(log_t)
        m = m - m.max(1, keepdims=True)
        return float((np.log(np.exp(m).sum(1)) - m[np.arange(len(m)), classes]).mean())

    # at least 1: a calibration set without errors would drive the temperature to zero
    lo, hi, ratio = 0.0, 3.0, (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = hi - ratio * (hi - lo), lo + ratio * (hi - lo)
        lo, hi = (lo, b) if loss(a) <= loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))
