"""The flagship question: who are our customers, in four segments?"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cluster import models as M
from ..operators.cluster.profile import cluster_stats
from . import views as V


def segments(spark: SparkSession, sf_dir: str, k: int = 4, seed: int = 42) -> DataFrame:
    """customer_id, raw features, cluster (K-Means on standardised features,
    clusters numbered by descending mean spend)."""
    from ..session import checkpoint_dir
    checkpoint_dir(spark)
    raw = V.customers(spark, sf_dir).checkpoint(eager=True)  # read by every K-Means pass
    feats = list(V.FEATURES)
    z = raw.select("customer_id", *[F.col(f).alias(f"z_{f}") for f in feats])
    from ..operators.scale import scale
    z = scale(z, [f"z_{f}" for f in feats])
    labelled, _ = M.kmeans(z, [f"z_{f}" for f in feats], k=k, seed=seed)
    out = labelled.select("customer_id", "cluster").join(raw, "customer_id")
    return M.relabel(out, "cluster", "total_spent")


def segment_summary(spark: SparkSession, sf_dir: str, k: int = 4) -> DataFrame:
    """Per segment and feature: size, mean, median, std (A14 over G1)."""
    return cluster_stats(segments(spark, sf_dir, k), list(V.FEATURES))
