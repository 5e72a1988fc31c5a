"""Logistic regression on a bounded sample, by Newton steps."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Logistic:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    intercept: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) / self.scale @ self.weights + self.intercept

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30) -> Logistic:
    """Features are standardised; without rows of both classes the weights are zero and the share decides."""
    share = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.5
    start = float(np.log(share / (1 - share)))
    if len(np.unique(y)) < 2:
        return Logistic(np.zeros(x.shape[1]), np.ones(x.shape[1]), np.zeros(x.shape[1]), start)
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale == 0] = 1
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    beta = np.append(np.zeros(x.shape[1]), start)
    penalty = np.append(np.full(x.shape[1], ridge), 1e-6)

    def loss(beta: np.ndarray) -> float:
        raw = z @ beta
        return float(np.logaddexp(0, raw).sum() - raw @ y + 0.5 * (penalty * beta * beta).sum())

    now = loss(beta)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        gradient = z.T @ (p - y) + penalty * beta
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty), gradient)
        while (then := loss(beta - step)) > now and np.abs(step).max() > 1e-9:  # a full step may go too far
            step = step / 2
        beta, now = beta - step, min(now, then)
        if np.abs(step).max() < 1e-8:
            break
    return Logistic(mean, scale, beta[:-1], float(beta[-1]))
