"""Comparison of clusterers by their metrics.

Metric tables hold one row per model: they are as small as the list of
models, so the windows over them have no partition key on purpose.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

METRICS = ("silhouette", "calinski_harabasz", "davies_bouldin", "inertia")


def best_clusterer(metrics: DataFrame, by: str = "silhouette", model_order: Sequence[str] | None = None) -> DataFrame:
    """The model with the highest ``by`` (NULLs ignored); ties go to the
    earlier model in ``model_order`` (G14)."""
    ranked = metrics.where(F.col(by).isNotNull())
    if model_order:
        pos = F.array_position(F.array(*[F.lit(m) for m in model_order]), F.col("model"))
        ranked = ranked.withColumn("_o", pos)
    else:
        ranked = ranked.withColumn("_o", F.col("model"))
    return ranked.orderBy(F.desc(by), F.asc("_o")).limit(1).drop("_o")


def metrics_table(metrics: DataFrame) -> DataFrame:
    """silhouette, CH, DB, inverse DB (0 when DB is 0 or missing), inertia."""
    return metrics.withColumn(
        "inverse_davies_bouldin",
        F.when(F.col("davies_bouldin").isNull() | (F.col("davies_bouldin") == 0), F.lit(0.0))
         .otherwise(1.0 / F.col("davies_bouldin")))


def metric_radar(metrics: DataFrame, cols: Sequence[str] = ("silhouette", "calinski_harabasz", "davies_bouldin")) -> DataFrame:
    """Each metric min-max normalised across models; 0.5 when all equal."""
    w = Window.partitionBy()  # one row per model
    out = metrics
    for c in cols:
        lo, hi = F.min(c).over(w), F.max(c).over(w)
        out = out.withColumn(f"{c}_norm", F.when(hi == lo, F.lit(0.5)).otherwise((F.col(c) - lo) / (hi - lo)))
    return out.select("model", *[f"{c}_norm" for c in cols])


def metric_correlation(metrics: DataFrame, cols: Sequence[str] = METRICS, fill_zero: bool = True) -> DataFrame:
    """Pearson correlation of metrics across models (G17). Zero-valued
    metrics are treated as missing; with ``fill_zero`` undefined
    correlations become 0 (the clustermap variant)."""
    cleaned = metrics.select(*[F.nullif(F.col(c), F.lit(0.0)).alias(c) for c in cols])
    from ..explore import correlation
    out = correlation(cleaned, list(cols))
    return out.withColumn("corr", F.coalesce("corr", F.lit(0.0))) if fill_zero else out
