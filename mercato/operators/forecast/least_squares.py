"""Least squares of many keys at once.

The rows are reduced to the sums of products of each key (XᵀX, Xᵀy) by one
map-side combined aggregation; a pandas UDF stacks the small systems of a
whole Arrow batch and solves them in one call.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType


def gram_aggs(feats: Sequence[str], y: str) -> list[Column]:
    """Aggregates ``_xtx`` (upper triangle, row by row) and ``_xty``."""
    upper = [F.sum(F.col(a) * F.col(b)) for i, a in enumerate(feats) for b in feats[i:]]
    return [F.array(*upper).alias("_xtx"), F.array(*[F.sum(F.col(a) * F.col(y)) for a in feats]).alias("_xty")]


def solve_stack(upper: np.ndarray, rhs: np.ndarray, ridge: float = 0.0) -> np.ndarray:
    """Coefficients of a stack of systems given by their upper triangles; a
    singular system gets its shortest solution."""
    n, k = rhs.shape
    i, j = np.triu_indices(k)
    a = np.empty((n, k, k))
    a[:, i, j] = upper
    a[:, j, i] = upper
    a += ridge * np.eye(k)
    return np.einsum("nij,nj->ni", np.linalg.pinv(a, rcond=1e-12, hermitian=True), rhs)


def solve(ridge: float = 0.0):
    """The pandas UDF ``(_xtx, _xty) -> coefficients``. An empty batch has none."""
    @F.pandas_udf(ArrayType(DoubleType()))
    def coefficients(xtx: pd.Series, xty: pd.Series) -> pd.Series:
        if len(xty) == 0:
            return pd.Series([], dtype=object)
        return pd.Series(list(solve_stack(np.stack(xtx.to_numpy()).astype(float),
                                          np.stack(xty.to_numpy()).astype(float), ridge)))
    return coefficients


def dot(beta: str, feats: Sequence[str]) -> Column:
    out = F.lit(0.0)
    for i, c in enumerate(feats):
        out = out + F.col(beta)[i] * F.col(c)
    return out


def join_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key attached to that key's rows; without keys ``right`` has
    a single row."""
    return left.join(right, on=list(keys)) if keys else left.crossJoin(F.broadcast(right))
