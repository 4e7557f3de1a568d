"""Small logistic models, fitted on bounded samples.

Rows are numbers without nulls; callers turn nulls into values of their own and see to it that there
are rows. Repeated rows count each time. With one class the ridge keeps the weights finite. The order of
rows matters for rounding only.
"""

from __future__ import annotations

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 12) -> np.ndarray:
    """Weights, the last one the intercept (which is not shrunk), by Newton's method."""
    x = np.hstack((x, np.ones((len(x), 1))))
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    weights = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = sigmoid(x @ weights)
        slope = x.T @ (p - y) + penalty * weights
        curve = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        # Long steps overshoot where classes are separable.
        step *= min(1.0, 10.0 / (np.abs(x @ step).max() + 1e-12))
        weights -= step
        if np.abs(step).max() < 1e-6:
            break
    return weights


def apply_logistic(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Log odds."""
    return x @ weights[:-1] + weights[-1]
