"""A linear-chain conditional random field with two labels, in numpy.

A token enters as one of a few evidence classes.  ``emission`` holds a weight per
class and label, ``transition`` one per pair of labels, ``initial`` one per
label.  Sequences come as windows of equal length, one row each.  Messages are
kept as probabilities, scaled to one at every token.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Crf:
    emission: np.ndarray
    transition: np.ndarray
    initial: np.ndarray

    def _messages(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Forward and backward messages, and per token what its label receives
        from the right; token first, then window, then label."""
        e = np.exp(self.emission - self.emission.max(axis=1, keepdims=True))[windows.T]
        step = np.exp(self.transition - self.transition.max())
        forward, backward, right = np.empty_like(e), np.ones_like(e), np.empty_like(e)
        scale = np.empty((*e.shape[:2], 1))
        now = np.exp(self.initial - self.initial.max()) * e[0]
        for t in range(len(e)):
            if t:
                now = (forward[t - 1] @ step) * e[t]
            scale[t] = now.sum(axis=1, keepdims=True)
            forward[t] = now / scale[t]
        for t in range(len(e) - 1, -1, -1):
            right[t] = e[t] * backward[t] / scale[t]
            if t:
                backward[t - 1] = right[t] @ step.T
        return forward, backward, right

    def marginals(self, windows: np.ndarray) -> np.ndarray:
        """Probability of label 1 at every token."""
        if not len(windows):
            return np.zeros(windows.shape)
        forward, backward, _ = self._messages(windows)
        return np.clip((forward * backward)[:, :, 1].T, 0.0, 1.0)

    @classmethod
    def fit(cls, windows: np.ndarray, labels: np.ndarray, classes: int, steps: int = 100, rate: float = 0.2, ridge: float = 1e-3) -> Crf:
        """Maximum likelihood with a ridge, by Adam from zero weights."""
        weights = [np.zeros((classes, 2)), np.zeros((2, 2)), np.zeros(2)]
        if not len(windows):
            return cls(*weights)
        seen = [np.zeros_like(w) for w in weights]
        np.add.at(seen[0], (windows, labels), 1)
        np.add.at(seen[1], (labels[:, :-1], labels[:, 1:]), 1)
        np.add.at(seen[2], labels[:, 0], 1)
        first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
        flat = windows.T.ravel()
        for step in range(1, steps + 1):
            forward, backward, right = cls(*weights)._messages(windows)
            node = forward * backward
            pairs = np.exp(weights[1] - weights[1].max()) * np.einsum("tni,tnj->ij", forward[:-1], right[1:])
            expected = [np.zeros_like(weights[0]), pairs, node[0].sum(axis=0)]
            for label in (0, 1):
                expected[0][:, label] = np.bincount(flat, node[:, :, label].ravel(), minlength=classes)
            for i, w in enumerate(weights):
                slope = (seen[i] - expected[i]) / len(windows) - ridge * w
                first[i] = 0.9 * first[i] + 0.1 * slope
                second[i] = 0.999 * second[i] + 0.001 * slope**2
                w += rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
        return cls(*weights)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 30) -> np.ndarray:
    """Weights of a logistic regression, the intercept last, by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    if not len(x):
        return w
    penalty = ridge * np.append(np.ones(x.shape[1] - 1), 1e-3)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        w = w + np.clip(np.linalg.solve(curve, x.T @ (y - p) - penalty * w), -5, 5)
    return w
