"""Internal clustering metrics (G5-G9, G11), scikit-learn definitions.

Features are plain double columns. Every metric is built from per-cluster
aggregates (k rows, broadcast) and one pass over the labelled rows, the
silhouette of all rows included; row pairs are never formed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _sq_dist(feats: Sequence[str], prefix: str = "_c_"):
    terms = [(F.col(f) - F.col(f"{prefix}{f}")) ** 2 for f in feats]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return total


def label_table(df: DataFrame, feats: Sequence[str], label: str = "cluster") -> DataFrame:
    """One row per label, written: size, and mean and population variance of every feature.

    One pass over the rows; Spark merges counts, means and variances of partial groups without cancellation. All that
    the dispersion metrics need is in these rows, so however many labels there are, none is sent to the rows again."""
    from ...session import checkpoint_dir
    checkpoint_dir(df.sparkSession)
    stats = [a for f in feats for a in (F.avg(f).alias(f"_c_{f}"), F.var_pop(f).alias(f"_v_{f}"))]
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"), *stats).checkpoint(eager=True)


def _table(df: DataFrame, feats: Sequence[str], label: str, table: DataFrame | None) -> DataFrame:
    """The ``label_table`` of the rows: the one passed in, so that several metrics share it, or a new one."""
    return label_table(df, feats, label) if table is None else table


def centroids(df: DataFrame, feats: Sequence[str], label: str = "cluster", table: DataFrame | None = None) -> DataFrame:
    """One row per cluster: size and mean of every feature."""
    return _table(df, feats, label, table).select(label, "_n", *[f"_c_{f}" for f in feats])


def with_centroid_distance(df: DataFrame, feats: Sequence[str], label: str = "cluster",
                           table: DataFrame | None = None) -> DataFrame:
    """Rows plus ``_sq`` = squared distance to their own cluster centroid. The
    centroids are broadcast only if they are few, and joined by shuffle otherwise."""
    from ..joins import broadcast_if_small
    return df.join(broadcast_if_small(centroids(df, feats, label, table), 200_000), on=label).withColumn("_sq", _sq_dist(feats))


def _within(feats: Sequence[str]):
    return F.sum(F.col("_n") * sum((F.col(f"_v_{f}") for f in feats), F.lit(0.0)))


def inertia(df: DataFrame, feats: Sequence[str], label: str = "cluster", table: DataFrame | None = None) -> DataFrame:
    """Sum of squared distances to the cluster centroids (G9): sizes times variances."""
    return _table(df, feats, label, table).where(F.col(label).isNotNull()).agg(_within(feats).alias("inertia"))


def calinski_harabasz(df: DataFrame, feats: Sequence[str], label: str = "cluster", table: DataFrame | None = None) -> DataFrame:
    """Between/within dispersion ratio (G7); NULL with fewer than two labels
    (G11), 1.0 when the within dispersion is 0. One pass over the rows."""
    table = _table(df, feats, label, table).where(F.col(label).isNotNull())
    means = [(F.sum(F.col("_n") * F.col(f"_c_{f}")) / F.sum("_n")).alias(f"_m_{f}") for f in feats]
    gap = sum(((F.col(f"_c_{f}") - F.col(f"_m_{f}")) ** 2 for f in feats), F.lit(0.0))
    out = table.crossJoin(F.broadcast(table.agg(*means))).agg(
        F.sum(F.col("_n") * gap).alias("_B"), _within(feats).alias("_W"), F.count(F.lit(1)).alias("_k"),
        F.sum("_n").alias("_rows"))
    score = F.when(F.col("_k") < 2, F.lit(None).cast("double")) \
        .when(F.col("_W") == 0, F.lit(1.0)) \
        .otherwise(F.col("_B") * (F.col("_rows") - F.col("_k")) / (F.col("_W") * (F.col("_k") - 1)))
    return out.select(score.alias("calinski_harabasz"))


def davies_bouldin(df: DataFrame, feats: Sequence[str], label: str = "cluster", table: DataFrame | None = None) -> DataFrame:
    """Mean over clusters of the worst (s_i + s_j) / d(c_i, c_j) (G8); NULL
    with fewer than two labels, 0 when all spreads or all centroid gaps are 0.
    The pair table has k² rows (k clusters), never row pairs."""
    spread = with_centroid_distance(df, feats, label, table).groupBy(label).agg(
        F.avg(F.sqrt("_sq")).alias("_s"), *[F.first(f"_c_{f}").alias(f"_c_{f}") for f in feats])
    a = spread.select(*[F.col(c).alias(f"a{c}") for c in spread.columns])
    b = spread.select(*[F.col(c).alias(f"b{c}") for c in spread.columns])
    gap_terms = [(F.col(f"a_c_{f}") - F.col(f"b_c_{f}")) ** 2 for f in feats]
    gap = gap_terms[0]
    for t in gap_terms[1:]:
        gap = gap + t
    pairs = a.join(F.broadcast(b), F.col(f"a{label}") != F.col(f"b{label}")) \
        .withColumn("_d", F.sqrt(gap))
    worst = pairs.groupBy(f"a{label}").agg(
        F.max(F.when(F.col("_d") > 0, (F.col("a_s") + F.col("b_s")) / F.col("_d"))
              .otherwise(F.lit(0.0))).alias("_r"),
        F.max("_d").alias("_dmax"), F.max("a_s").alias("_smax"))
    score = worst.agg(F.avg("_r").alias("_db"), F.max("_dmax").alias("_dmax"),
                      F.max("_smax").alias("_smax"), F.count(F.lit(1)).alias("_k"))
    return score.select(
        F.when(F.col("_k").isNull() | (F.col("_k") < 2), F.lit(None).cast("double"))
         .when((F.col("_smax") == 0) | (F.col("_dmax") == 0), F.lit(0.0))
         .otherwise(F.col("_db")).alias("davies_bouldin"))


def silhouette_samples(df: DataFrame, feats: Sequence[str], label: str = "cluster",
                       key: str = "customer_id") -> DataFrame:
    """Silhouette of every row with squared Euclidean distance (G6), the
    measure Spark's ``ClusteringEvaluator`` averages, in O(n·k):
    ``(key, label, silhouette)``.

    The mean squared distance from x to cluster C is
    ‖x‖² − 2·x·μ_C + mean_C(‖y‖²), so one k-row table of cluster sizes,
    means and mean squared norms (broadcast) replaces all pairs. The own
    cluster excludes the point itself: a = n_C/(n_C − 1) · d(x, C); a
    single-point cluster scores 0. A row with a missing feature or label
    keeps its place with a NULL score and counts in no cluster."""
    feats = list(feats)
    norm = sum((F.col(f) * F.col(f) for f in feats), F.lit(0.0))
    every = df.select(key, label, *[F.col(f).cast("double").alias(f) for f in feats]).withColumn("_nx", norm)
    whole = F.col("_nx").isNotNull() & F.col(label).isNotNull()
    stats = every.where(whole).groupBy(label).agg(F.count(F.lit(1)).alias("_n"), F.avg("_nx").alias("_ny"),
                                    *[F.avg(f).alias(f"_m_{f}") for f in feats])
    packed = stats.select(F.collect_list(F.struct(F.col(label).alias("c"), "_n", "_ny",
                                                  F.array(*[F.col(f"_m_{f}") for f in feats]).alias("m")))
                          .alias("_cs"))  # one row holding k entries
    x = F.array(*[F.col(f) for f in feats])
    dot = lambda m: F.aggregate(F.zip_with(x, m, lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v)
    with_d = every.crossJoin(F.broadcast(packed)).withColumn(
        "_d", F.transform("_cs", lambda s: F.struct(s["c"].alias("c"), s["_n"].alias("n"),
                                                    (F.col("_nx") - 2 * dot(s["m"]) + s["_ny"]).alias("d"))))
    own = F.filter("_d", lambda s: s["c"] == F.col(label))[0]
    others = F.filter("_d", lambda s: s["c"] != F.col(label))
    a = F.when(own["n"] <= 1, F.lit(0.0)).otherwise(own["d"] * own["n"] / (own["n"] - 1))
    b = F.array_min(F.transform(others, lambda s: s["d"]))
    s = F.when(own["n"] <= 1, F.lit(0.0)).when(a < b, 1 - a / b).when(a > b, b / a - 1).otherwise(F.lit(0.0))
    return with_d.select(key, label, F.when(whole, s).alias("silhouette"))


def silhouette(df: DataFrame, feats: Sequence[str], label: str = "cluster", key: str = "customer_id") -> DataFrame:
    """Mean of ``silhouette_samples`` (G5); NULL with fewer than two labels."""
    per = silhouette_samples(df, feats, label, key).where("silhouette IS NOT NULL")
    return per.agg(F.when(F.countDistinct(label) < 2, F.lit(None).cast("double"))
                   .otherwise(F.avg("silhouette")).alias("silhouette"))
