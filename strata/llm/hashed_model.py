"""Hashed n-gram logistic regression with Platt calibration, fitted in numpy.

The fit uses a bounded sample of labelled documents (the callers' documented
``max_rows``): their sparse hashed rows are computed on the executors and only
those bounded rows reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class HashedModel:
    weights: np.ndarray  # float32, one per hashed feature
    bias: float
    slope: float = 1.0  # calibration: p = sigmoid(slope * raw + shift)
    shift: float = 0.0

    def probability(self, raw: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * (raw + self.bias) + self.shift)


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))


def _row_sums(values: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[ptr[1:]] - total[ptr[:-1]]


def g_statistic(n1: np.ndarray, n0: np.ndarray, rows1: float, rows0: float) -> np.ndarray:
    """G statistic of the tables (rows with and without a feature, by class)."""
    with_it, total = n1 + n0, rows1 + rows0
    out = np.zeros(len(n1))
    for seen, margin, rows in ((n1, with_it, rows1), (n0, with_it, rows0), (rows1 - n1, total - with_it, rows1), (rows0 - n0, total - with_it, rows0)):
        some = seen > 0
        out[some] += 2 * seen[some] * np.log(seen[some] * total / (margin[some] * rows))
    return out


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, dim: int, rounds: int = 20,
        rate: float = 0.1, decay: float = 1e-4, seed: int = 7, least_z: float = 0.0) -> HashedModel | None:
    """Adagrad over sparse rows ``(feature ids, values)``; every fifth row is
    held back for the calibration.  None when only one class is present.  With
    ``least_z`` only features whose presence differs between the classes by that
    many standard errors get a weight: the G statistic of presence by class, which
    needs no smoothing where a class never shows the feature, is the square."""
    labels = np.asarray(labels, np.float64)
    if len(labels) == 0 or labels.min() == labels.max():
        return None
    order = np.random.default_rng(seed).permutation(len(rows))
    held = order[::5] if len(rows) >= 50 else order[:0]
    train = np.setdiff1d(order, held)
    np.random.default_rng(seed).shuffle(train)
    allowed = np.ones(dim)
    if least_z:
        n1, n0 = (np.bincount(np.concatenate([rows[i][0] for i in train if labels[i] == k]), minlength=dim).astype(float) for k in (1, 0))
        allowed = (g_statistic(n1, n0, labels[train].sum(), (1 - labels[train]).sum()) >= least_z**2).astype(float)
    w, g2, b, gb2 = np.zeros(dim), np.full(dim, 1e-8), 0.0, 1e-8
    size = max(16, len(train) // 40)
    batches = []
    for lo in range(0, len(train), size):
        ids = train[lo : lo + size]
        ptr = np.concatenate([[0], np.cumsum([len(rows[i][0]) for i in ids])])
        batches.append((ids, ptr, np.concatenate([rows[i][0] for i in ids]), np.concatenate([rows[i][1] for i in ids])))
    positive = labels[train].mean()
    weight = np.where(labels > 0, 0.5 / max(positive, 1e-6), 0.5 / max(1 - positive, 1e-6))
    for _ in range(rounds):
        for ids, ptr, idx, val in batches:
            err = (sigmoid(_row_sums(w[idx] * val, ptr) + b) - labels[ids]) * weight[ids] / len(ids)
            grad = np.bincount(idx, np.repeat(err, np.diff(ptr)) * val, minlength=dim)
            grad = (grad + decay * w) * allowed
            g2 += grad * grad
            w -= rate * grad / np.sqrt(g2)
            gb2 += err.sum() ** 2
            b -= rate * err.sum() / np.sqrt(gb2)
    model = HashedModel(w.astype(np.float32), float(b))
    if len(held) >= 20 and 0 < labels[held].sum() < len(held):
        raw = np.array([float((w[rows[i][0]] * rows[i][1]).sum()) for i in held]) + b
        model.slope, model.shift = _platt(raw, labels[held])
    return model


def _platt(raw: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Two-parameter logistic fit with Platt's soft targets: Newton steps on a
    ridge towards (1, 0), halved until the loss falls."""
    n1, n0 = y.sum(), len(y) - y.sum()
    t = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))

    def loss(a, c):
        z = a * raw + c
        return (np.logaddexp(0, z) - t * z).sum() + 0.5 * (a - 1) ** 2 + 0.5 * c * c

    a, c = 1.0, 0.0
    for _ in range(50):
        p = sigmoid(a * raw + c)
        d, v = p - t, p * (1 - p)
        grad = np.array([(d * raw).sum() + a - 1, d.sum() + c])
        step = np.linalg.solve([[(v * raw * raw).sum() + 1, (v * raw).sum()], [(v * raw).sum(), v.sum() + 1]], grad)
        share, now = 1.0, loss(a, c)
        while share > 1e-6 and loss(a - share * step[0], c - share * step[1]) > now:
            share /= 2
        a, c = a - share * step[0], c - share * step[1]
        if abs(step).max() < 1e-9:
            break
    return (float(a), float(c)) if a > 0 else (1.0, 0.0)
