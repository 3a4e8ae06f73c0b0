"""Choosing and comparing clusterers.

Every model labels all rows, and every metric is built from per-cluster
aggregates over all rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import metrics as Me
from . import models as M
from .dbscan import dbscan
from .ward import ward

ALGORITHMS = ("kmeans", "dbscan", "ward", "gmm")


def fit_labels(df: DataFrame, feats: Sequence[str], key: str, algorithm: str = "kmeans", k: int = 4,
               seed: int = 42, eps: float = 0.7, min_samples: int = 10) -> DataFrame:
    """``(key, cluster)`` from one of the four clusterers (G19 dispatch)."""
    if algorithm == "kmeans":
        lab, _ = M.kmeans(df, feats, k=k, seed=seed)
    elif algorithm == "gmm":
        lab, _ = M.gmm(df, feats, k=k, seed=seed)
    elif algorithm == "dbscan":
        return dbscan(df, feats, key, eps=eps, min_samples=min_samples)
    elif algorithm == "ward":
        lab, _ = ward(df, feats, key, k=k, seed=seed)
        return lab
    else:
        raise ValueError(f"unknown algorithm {algorithm!r}; expected one of {ALGORITHMS}")
    return lab.select(key, "cluster")


def score(df: DataFrame, labels: DataFrame, feats: Sequence[str], key: str, model: str,
          with_inertia: bool = False) -> DataFrame:
    """One metrics row for a labelling: silhouette, CH, DB, inertia (K-Means
    only, as in the reference), each over all rows."""
    rows = df.select(key, *feats).join(labels, key)
    table = Me.label_table(rows, feats)
    out = Me.silhouette(rows, feats, key=key) \
        .crossJoin(Me.calinski_harabasz(rows, feats, table=table)).crossJoin(Me.davies_bouldin(rows, feats, table=table))
    inertia = Me.inertia(rows, feats, table=table) if with_inertia else \
        df.sparkSession.createDataFrame([(None,)], "inertia double")
    return out.crossJoin(inertia).withColumn("model", F.lit(model)) \
        .select("model", "silhouette", "calinski_harabasz", "davies_bouldin", "inertia")


def compare_clusterers(df: DataFrame, feats: Sequence[str], key: str, k: int = 4, seed: int = 42) -> DataFrame:
    """All four clusterers with their metrics (G13), one row per model."""
    rows = df.select(key, *feats).checkpoint(eager=True)
    parts = []
    for alg in ALGORITHMS:
        lab = fit_labels(rows, feats, key, alg, k, seed).checkpoint(eager=True)
        parts.append(score(rows, lab, feats, key, alg, with_inertia=(alg == "kmeans")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def segment(df: DataFrame, feats: Sequence[str], key: str, algorithm: str = "kmeans", k: int = 4,
            n_components: int = 2, extra: Sequence[str] = ()) -> DataFrame:
    """Labels plus a PCA projection for display (G19; G20 with 3 components)."""
    lab = fit_labels(df, feats, key, algorithm, k)
    rows = df.join(lab, key)
    return M.pca(rows, feats, k=n_components).select(
        key, *[f"pc{i + 1}" for i in range(n_components)], "cluster", *extra)
