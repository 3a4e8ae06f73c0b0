"""Per-cluster profiles (A14) and the labelling used by SQL checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..rank import exact_quantiles, row_positions


def cluster_stats(df: DataFrame, feats: Sequence[str], label: str = "cluster") -> DataFrame:
    """mean, median, sample std and size of every feature per cluster (A14),
    long form ``(cluster, feature, n, mean, median, std)``."""
    long = df.select(label, *[F.col(f).cast("double").alias(f) for f in feats]) \
        .unpivot([label], list(feats), "feature", "value")
    moments = long.groupBy(label, "feature").agg(
        F.count("value").alias("n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"))
    med = exact_quantiles(df, feats, [0.5], by=[label]) \
        .select(label, F.col("column").alias("feature"), F.col("value").alias("median"))
    return moments.join(med, on=[label, "feature"], how="left") \
        .select(label, "feature", "n", "mean", "median", "std")


def rank_labels(df: DataFrame, k: int, order: Sequence[str], label: str = "cluster", stable: bool = True) -> DataFrame:
    """Deterministic labelling into k equal-count groups by ``order``:
    ``floor(position * k / n)``, positions computed without a global window.
    ``stable=False`` is for rows that are already written."""
    pos = row_positions(df, order, stable=stable)
    return pos.withColumn(label, F.floor(F.col("pos") * k / F.col("n")).cast("int")).drop("pos", "n")
