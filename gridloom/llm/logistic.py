"""Ridge logistic regression by damped Newton steps."""

from __future__ import annotations

import numpy as np


def logistic(x: np.ndarray, y: np.ndarray, ridge: float, intercept: float) -> np.ndarray:
    """Weights for columns of x, of which the first is ones and is not shrunk. ``intercept`` is where it starts, and
    the answer without both labels."""
    w = np.zeros(x.shape[1])
    w[0] = intercept
    if not 0 < y.sum() < len(y):
        return w
    penalty = np.full(len(w), ridge)
    penalty[0] = 1e-6

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float((np.logaddexp(0, z) - y * z).sum() + (penalty * w * w).sum() / 2)

    now = loss(w)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (y - p) - penalty * w)
        size = 1.0
        while size > 1e-6 and (new := loss(w + size * step)) > now:
            size /= 2
        if size <= 1e-6 or now - new < 1e-9 * max(1.0, now):
            break
        w, now = w + size * step, new
    return w
