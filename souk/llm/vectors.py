"""Helpers of the vector operators: which vectors count, bounded samples, k-means."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def doubles(c: str) -> Column:
    return F.col(c).cast("array<double>")


def usable(c: Column) -> Column:
    """True for vectors that are not null, not zero and hold finite components only (c: array<double>)."""
    finite = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(c, lambda x: x != 0), F.lit(False))


def sample(vectors: DataFrame, column: str, rows: int, total: int, order: Column) -> np.ndarray:
    """About `rows` of the `total` vectors, drawn by the hash `order`, as unit rows in a fixed order (at most 2 * rows)."""
    share = min(1.0, rows / max(1, total))
    drawn = vectors.where(F.pmod(order, F.lit(1_000_000)) < share * 1_000_000).select(order.alias("o"), column)
    got = drawn.orderBy("o").limit(2 * rows).toPandas()
    x = np.array(got[column].tolist(), dtype=np.float64)
    return unit(x) if len(x) else x.reshape(0, 0)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows at length 1, without overflow for very long or short ones."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Row of the nearest centre for each x."""
    return ((centres**2).sum(axis=1) - 2 * (x @ centres.T)).argmin(axis=1)


def k_means(x: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    """k centres (fewer if x has fewer rows), the same for the same rows."""
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        own = nearest(x, centres)
        n = np.bincount(own, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres
