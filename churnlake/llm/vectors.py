"""Vector helpers of the embedding operators."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vec: Column) -> Column:
    """Not null, not empty, every component finite, not all zero."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vec.isNotNull() & finite & F.exists(vec, lambda x: x != 0), F.lit(False))


def matrix(s: pd.Series) -> np.ndarray:
    """Rows of equal length as a double matrix."""
    return np.stack(s.to_numpy()).astype(np.float64) if len(s) else np.zeros((0, 0))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one in double precision; the first scaling keeps
    very large and very small components from over- and underflow."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def sample(df: DataFrame, total: int, rows: int, by: str, vec: str) -> np.ndarray:
    """Unit vectors of about ``rows`` of the ``total`` rows, those whose ids
    hash lowest: a bounded, repeatable sample."""
    share = int(min(1.0, rows / max(1, total)) * (1 << 30))
    some = df.filter(F.pmod(F.xxhash64(by), F.lit(1 << 30)) < F.lit(share))
    got = some.select(by, vec).limit(2 * rows).toPandas().sort_values(by)
    return unit(matrix(got[vec])) if len(got) else np.zeros((0, 0))


def kmeans(x: np.ndarray, k: int, rounds: int, seed: int, spherical: bool) -> np.ndarray:
    """``k`` centroids (fewer, if there are fewer rows) of the rows of ``x``;
    spherical: rows and centroids are unit vectors and cosine decides."""
    k = max(1, min(k, len(x)))
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        own = nearest(x, c)
        total = np.zeros_like(c)
        np.add.at(total, own, x)
        n = np.bincount(own, minlength=k)
        c[n > 0] = total[n > 0] / n[n > 0, None]
        if spherical:
            length = np.sqrt((c * c).sum(axis=1, keepdims=True))
            c = np.where(length > 1e-9, c / np.maximum(length, 1e-9), c)
    return c


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return (2 * x @ c.T - (c * c).sum(axis=1)).argmax(axis=1)
