"""A small logistic regression, fitted on a bounded sample and applied as a column expression."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estatelens.llm.sampling import hash_sample

#: Rows of a sample; the sample is taken by a hash of the id, alike at every size.
SAMPLE_ROWS = 20_000


@dataclass(frozen=True)
class Logistic:
    means: tuple[float, ...]
    scales: tuple[float, ...]
    weights: tuple[float, ...]
    bias: float

    def column(self, features: Sequence[Column]) -> Column:
        total = F.lit(self.bias)
        for x, m, s, w in zip(features, self.means, self.scales, self.weights):
            total = total + (x - F.lit(m)) / F.lit(s) * F.lit(w)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), total))))


def fit_logistic(features: np.ndarray, labels: np.ndarray, ridge: float = 1e-3, rounds: int = 50) -> Logistic:
    """Newton's method; without rows of both labels the score is their share, or a half."""
    width = features.shape[1]
    if len(labels) == 0 or labels.min() == labels.max():
        share = float(np.clip(labels.mean(), 0.01, 0.99)) if len(labels) else 0.5
        return Logistic((0.0,) * width, (1.0,) * width, (0.0,) * width, float(np.log(share / (1 - share))))
    means, scales = features.mean(0), features.std(0) + 1e-9
    x = np.column_stack([(features - means) / scales, np.ones(len(labels))])
    penalty = np.diag([ridge * len(labels)] * width + [0.0])
    beta = np.zeros(width + 1)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (labels - p) - penalty @ beta
        curvature = (x * np.maximum(p * (1 - p), 1e-9)[:, None]).T @ x + penalty + 1e-9 * np.eye(width + 1)
        step = np.linalg.solve(curvature, gradient)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return Logistic(
        tuple(map(float, means)), tuple(map(float, scales)), tuple(map(float, beta[:-1])), float(beta[-1])
    )


def sample_and_fit(rows: DataFrame, features: Sequence[str], label: str, sample_rows: int = SAMPLE_ROWS) -> Logistic:
    """Fit on at most ``sample_rows`` rows of ``doc_id``, features and label."""
    taken = hash_sample(rows, sample_rows, "doc_id", *features).select(*features, label).toPandas()
    return fit_logistic(taken[list(features)].to_numpy(np.float64), taken[label].to_numpy(np.float64))
