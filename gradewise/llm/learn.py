"""Small trainers over bounded samples, in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


# Entries that a sum over rows works on at once.
BLOCK_ENTRIES = 1 << 20


@dataclass
class Sparse:
    """Rows of (feature, value) pairs: row i has the entries starts[i] to starts[i + 1]."""

    starts: np.ndarray
    index: np.ndarray
    value: np.ndarray
    width: int

    def __len__(self) -> int:
        return len(self.starts) - 1

    @classmethod
    def of(cls, index: list[np.ndarray], value: list[np.ndarray], width: int) -> Sparse:
        none = np.zeros(0, np.int32)
        starts = np.concatenate(([0], np.cumsum([len(i) for i in index], dtype=np.int64)))
        return cls(starts, np.concatenate([none, *index]), np.concatenate([none.astype(np.float32), *value]), width)

    def _blocks(self) -> Iterator[tuple[int, int]]:
        """(first row, row behind the last) of runs of rows with about `BLOCK_ENTRIES` entries; every row comes once."""
        row = 0
        while row < len(self):
            stop = max(row + 1, int(np.searchsorted(self.starts, self.starts[row] + BLOCK_ENTRIES, "right")) - 1)
            yield row, stop
            row = stop

    def dot(self, weights: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self))
        for a, b in self._blocks():
            low, high = self.starts[a], self.starts[b]
            sums = np.concatenate(([0.0], np.cumsum(weights[self.index[low:high]] * self.value[low:high])))
            at = self.starts[a: b + 1] - low
            out[a:b] = sums[at[1:]] - sums[at[:-1]]
        return out

    def back(self, gradient: np.ndarray) -> np.ndarray:
        out = np.zeros(self.width)
        for a, b in self._blocks():
            low, high = self.starts[a], self.starts[b]
            rows = np.repeat(gradient[a:b], np.diff(self.starts[a: b + 1]))
            out += np.bincount(self.index[low:high], rows * self.value[low:high], self.width)
        return out


def fit_logistic(x: Sparse, y: np.ndarray, *, steps: int = 50, rate: float = 0.15, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias of an L2-penalised logistic regression, by full-batch Adam from zero; classes weigh alike."""
    weights, bias = np.zeros(x.width), 0.0
    share = np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3)
    weigh = np.where(y > 0.5, 0.5 / share, 0.5 / (1 - share))
    m, v = np.zeros(x.width + 1), np.zeros(x.width + 1)
    for t in range(1, steps + 1 if len(y) else 1):
        error = (sigmoid(x.dot(weights) + bias) - y) * weigh / len(y)
        g = np.append(x.back(error) + decay * weights, error.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
        weights -= step[:-1]
        bias -= step[-1]
    return weights, bias


def calibrate(raw: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift that make sigmoid(slope * raw + shift) a probability (Platt's targets, Newton's method with halved
    steps, since full ones run away where the scores tell the labels apart by far)."""
    up, down = (y > 0.5).sum(), (y <= 0.5).sum()
    if not up or not down:
        return 1.0, 0.0
    target = np.where(y > 0.5, (up + 1) / (up + 2), 1 / (down + 2))
    slope, shift = 1.0, 0.0

    def loss(slope: float, shift: float) -> float:
        z = slope * raw + shift
        return float((np.logaddexp(0, z) - target * z).sum())

    for _ in range(50):
        p = sigmoid(slope * raw + shift)
        w = np.maximum(p * (1 - p), 1e-9)
        g = np.array([((p - target) * raw).sum(), (p - target).sum()])
        h = np.array([[(w * raw * raw).sum(), (w * raw).sum()], [(w * raw).sum(), w.sum()]]) + 1e-6 * np.eye(2)
        step, now = np.linalg.solve(h, g), loss(slope, shift)
        for _ in range(40):
            if loss(slope - step[0], shift - step[1]) <= now:
                break
            step = step / 2
        slope, shift = slope - step[0], shift - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return (float(slope), float(shift)) if slope > 0 and np.isfinite(slope) else (1.0, 0.0)
