"""Statistics of association."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def chi2_statistic(a: Column, b: Column, cases: Column, controls: Column) -> Column:
    """Goodness of fit of carriers among cases (a) and controls (b) to the shares of either; 1 degree of freedom.

    Null where there are no carriers, no cases or no controls.
    """
    m, n = a + b, cases + controls
    e1, e2 = m * cases / n, m * controls / n
    return F.when((m > 0) & (cases > 0) & (controls > 0), (a - e1) * (a - e1) / e1 + (b - e2) * (b - e2) / e2)


def chi2_pvalue(statistic: float | None) -> float:
    """Chance of a larger statistic with 1 degree of freedom; 1 if there is none."""
    return 1.0 if statistic is None or math.isnan(statistic) else math.erfc(math.sqrt(statistic / 2))


@F.pandas_udf(T.DoubleType())
def chi2_pvalue_udf(statistic: pd.Series) -> pd.Series:
    return statistic.map(lambda x: chi2_pvalue(None if pd.isna(x) else x))


def standardized(columns: np.ndarray) -> np.ndarray:
    """Columns less their means, over their sample deviations (unchanged if that is 0)."""
    deviation = columns.std(axis=0, ddof=1) if len(columns) > 1 else np.ones(columns.shape[1])
    return (columns - columns.mean(axis=0)) / np.where(deviation > 0, deviation, 1)


def log_likelihood(x: np.ndarray, y: np.ndarray, rounds: int = 100, tolerance: float = 1e-12) -> float:
    """Greatest log-likelihood of a logistic regression of y on x, by Newton's method; NaN if x is singular."""
    if np.linalg.matrix_rank(x) < x.shape[1]:
        return math.nan
    beta, last = np.zeros(x.shape[1]), -math.inf
    for _ in range(rounds):
        eta = x @ beta
        now = float(np.sum(y * eta - np.logaddexp(0, eta)))
        if abs(now - last) <= tolerance * max(1.0, abs(now)):
            return now
        last = now
        p = 1 / (1 + np.exp(-eta))
        w = np.maximum(p * (1 - p), 1e-12)
        try:
            step = np.linalg.solve((x * w[:, None]).T @ x, x.T @ (y - p))
        except np.linalg.LinAlgError:
            return math.nan
        beta = beta + np.clip(step, -20, 20)
    return last


def likelihood_ratio_pvalue(onehot: np.ndarray, covariates: np.ndarray, y: np.ndarray, null: float | None = None) -> float:
    """p of adding ``onehot`` to a logistic model of a constant and standardized covariates; NaN if that is singular."""
    base = np.column_stack([np.ones(len(y)), standardized(covariates)]) if covariates.size else np.ones((len(y), 1))
    null = log_likelihood(base, y) if null is None else null
    full = log_likelihood(np.column_stack([base, onehot.astype(float)]), y)
    if math.isnan(null) or math.isnan(full):
        return math.nan
    return chi2_pvalue(max(0.0, 2 * (full - null)))
