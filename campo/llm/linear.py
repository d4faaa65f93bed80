"""Sparse logistic regression on mean-pooled hashed features, trained by
averaging models that tasks fit on shares of a bounded sample."""

from __future__ import annotations

import numpy as np


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def pooled(weights: np.ndarray, parts: list[tuple[np.ndarray, np.ndarray]], counts: np.ndarray) -> np.ndarray:
    """Mean weight of each text's features (0 for a text without any);
    ``parts``: feature numbers and their text numbers."""
    total = sum((np.bincount(text, weights[index], len(counts)) for index, text in parts), np.zeros(len(counts)))
    return total / np.maximum(counts, 1)


class Trainer:
    """AdaGrad on log-loss.  A text has several groups of features (see
    :func:`pooled`), each with its index range in ``weights``; a group adds ``gain`` times the mean of its
    weights to the text's logit."""

    def __init__(self, size: int, gain: float = 6.0, rate: float = 0.15, decay: float = 1e-5):
        self.w, self.seen = np.zeros(size), np.zeros(size)
        self.bias, self.bias_seen = 0.0, 0.0
        self.gain, self.rate, self.decay = gain, rate, decay

    def step(self, groups: list[tuple[list, np.ndarray]], label: np.ndarray, weight: np.ndarray) -> None:
        z = self.bias + sum(self.gain * pooled(self.w, i, n) for i, n in groups)
        error = (sigmoid(z) - label) * weight / len(label)
        for parts, counts in groups:
            each = error * self.gain / np.maximum(counts, 1)
            slope = sum((np.bincount(index, each[text], len(self.w)) for index, text in parts), np.zeros(len(self.w)))
            hit = np.flatnonzero(slope)
            g = slope[hit] + self.decay * self.w[hit]
            self.seen[hit] += g * g
            self.w[hit] -= self.rate * g / np.sqrt(self.seen[hit] + 1e-12)
        g = error.sum()
        self.bias_seen += g * g
        self.bias -= self.rate * g / np.sqrt(self.bias_seen + 1e-12)


def platt(score: np.ndarray, label: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and offset of the logistic curve of label over score (Platt's
    smoothed targets, Newton's method).  Slope is never negative; with one
    class only, the curve is left as it is."""
    n1, n0 = label.sum(), (1 - label).sum()
    if not n1 or not n0:
        return 1.0, 0.0
    target = np.where(label > 0.5, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(rounds):
        p = sigmoid(a * score + b)
        r, h = p - target, np.maximum(p * (1 - p), 1e-9)
        ga, gb = (r * score).sum() + 1e-3 * (a - 1), r.sum()
        haa, hab, hbb = (h * score * score).sum() + 1e-3, (h * score).sum(), h.sum() + 1e-9
        det = haa * hbb - hab * hab
        if det <= 0:
            break
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        step = min(1.0, 2.0 / max(abs(da), abs(db), 1e-9))
        a, b = a - step * da, b - step * db
        if abs(da) + abs(db) < 1e-7:
            break
    return max(a, 0.0), b
