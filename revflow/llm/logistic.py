"""Logistic regression on a few features, by Newton steps."""

from __future__ import annotations

import numpy as np


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Weights of the features and, last, the constant. Features are scaled inside; ``ridge`` keeps separable data finite."""
    scale = np.maximum(x.std(axis=0), 1e-12)
    z = np.column_stack([x / scale, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    penalty = np.append(np.full(x.shape[1], ridge), 1e-6)
    for _ in range(steps):
        p = sigmoid(z @ w)
        gradient = z.T @ (p - y) + penalty * w
        hessian = (z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        w = w - step * min(1.0, 4 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return np.append(w[:-1] / scale, w[-1])
