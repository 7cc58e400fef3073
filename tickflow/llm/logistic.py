"""A small logistic regression that turns margins into probabilities."""

from __future__ import annotations

import numpy as np


def fit(x: np.ndarray, y: np.ndarray, ridge: float) -> np.ndarray:
    """Weights and, last, the intercept, by Newton's method with a ridge on the weights."""
    x = np.column_stack([x, np.ones(len(x))])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = probability(x[:, :-1], w)
        gradient = x.T @ (p - y) + penalty * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        # Far steps overshoot where the classes are nearly apart.
        w -= step * min(1.0, 5.0 / max(1e-12, np.abs(step).max()))
        if np.abs(step).max() < 1e-9:
            break
    return w


def probability(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))
