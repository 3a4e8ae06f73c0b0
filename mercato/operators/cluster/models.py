"""Clustering models on a keyed feature table.

Labels always stay next to the row key (never positional). Label numbers are
made stable by renumbering clusters in descending order of a chosen column's
mean, since the raw numbers of any clusterer are arbitrary.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from multiprocessing.pool import ThreadPool

from pyspark.ml.clustering import GaussianMixture, KMeans
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target


def assemble(df: DataFrame, feats: Sequence[str], out: str = "features") -> DataFrame:
    """Feature vector column. ``VectorAssembler`` rejects NULLs, so rows with
    a missing feature must be imputed or dropped first (done here: dropped)."""
    clean = df.dropna(subset=list(feats))
    return VectorAssembler(inputCols=list(feats), outputCol=out).transform(clean)


def relabel(df: DataFrame, label: str = "cluster", by_mean_of: str = "total_spent",
            keep: Sequence[int] = (-1,)) -> DataFrame:
    """Renumber clusters 0..k-1 by descending mean of ``by_mean_of``.

    Labels in ``keep`` (DBSCAN noise, -1) are left as they are. The mapping
    has one row per cluster, so broadcasting it is safe.
    """
    means = df.where(~F.col(label).isin(list(keep))).groupBy(label).agg(F.avg(by_mean_of).alias("_m"))
    order = Window.orderBy(F.desc("_m"), F.asc(label))  # k rows only
    mapping = means.select(F.col(label).alias("_old"), (F.row_number().over(order) - 1).alias("_new"))
    out = df.join(F.broadcast(mapping), F.col(label) == F.col("_old"), "left")
    return out.withColumn(label, F.coalesce(F.col("_new"), F.col(label)).cast("int")).drop("_old", "_new")


def _kmeans(k: int, seed: int, label: str = "cluster", max_iter: int = 20, init_steps: int = 2) -> KMeans:
    return KMeans(k=k, seed=seed, featuresCol="features", predictionCol=label, maxIter=max_iter, initSteps=init_steps)


def kmeans(df: DataFrame, feats: Sequence[str], k: int = 4, seed: int = 42, label: str = "cluster",
           max_iter: int = 20, init_steps: int = 2):
    """K-Means (G1): returns ``(labelled rows, model)``.

    Each iteration is one distributed pass (partial sums per centre, combined
    map-side); only k centres travel to the driver. ``model.summary.trainingCost``
    is the inertia.
    """
    data = assemble(df, feats)
    model = _kmeans(k, seed, label, max_iter, init_steps).fit(data)
    return model.transform(data).drop("features"), model


def kmeans_costs(df: DataFrame, feats: Sequence[str], ks: Iterable[int], seed: int = 42, parallelism: int = 3) -> dict[int, float]:
    """Inertia of one K-Means fit (G1) for each k >= 2, by k.

    The vectors are assembled and kept once; every fit reads them three times (form of the data, training, cluster sizes).
    The fits do not depend on each other, so ``parallelism`` of them run side by side, those with most centres first: one
    fit is a chain of short jobs that leaves cores idle.
    """
    data = assemble(df, feats).select("features").persist()
    # A frame that is itself persisted is decoded by Spark's K-Means in every iteration; from one read off it, each fit keeps its own vectors.
    read = data.where(F.col("features").isNotNull())

    def cost(k: int) -> tuple[int, float]:
        return k, float(_kmeans(k, seed).fit(read).summary.trainingCost)

    try:
        with ThreadPool(parallelism) as pool:
            return dict(pool.map(inheritable_thread_target(df.sparkSession)(cost), sorted(ks, reverse=True), chunksize=1))
    finally:
        data.unpersist()


def gmm(df: DataFrame, feats: Sequence[str], k: int = 4, seed: int = 42, label: str = "cluster",
        max_iter: int = 100):
    """Gaussian mixture (G4): hard labels = most probable component."""
    data = assemble(df, feats)
    model = GaussianMixture(k=k, seed=seed, featuresCol="features", predictionCol=label,
                            probabilityCol="_prob", maxIter=max_iter).fit(data)
    return model.transform(data).drop("features", "_prob"), model


def centers(model, feats: Sequence[str]) -> list[tuple]:
    """Cluster centres of a fitted model as (cluster, *coords): k small rows."""
    out = []
    for i, c in enumerate(model.clusterCenters()):
        out.append((i, *[float(x) for x in c]))
    return out


def pca(df: DataFrame, feats: Sequence[str], k: int = 2, prefix: str = "pc") -> DataFrame:
    """Principal components of (already standardised) features.

    Spark's PCA does not centre its output, so features are centred first;
    each component's sign is fixed so that its largest loading is positive,
    which makes the projection deterministic.
    """
    cols = list(feats)
    means = df.agg(*[F.avg(c).alias(f"_mu_{c}") for c in cols])
    centred = df.crossJoin(F.broadcast(means))
    for c in cols:
        centred = centred.withColumn(f"_x_{c}", F.col(c) - F.col(f"_mu_{c}"))
    data = assemble(centred, [f"_x_{c}" for c in cols], out="_xv")
    model = PCA(k=k, inputCol="_xv", outputCol="_pcs").fit(data)
    pc = model.pc.toArray()  # d × k loadings, bounded by the feature count
    signs = [1.0 if pc[abs(pc[:, j]).argmax(), j] >= 0 else -1.0 for j in range(k)]
    out = model.transform(data).withColumn("_arr", vector_to_array("_pcs"))
    for j in range(k):
        out = out.withColumn(f"{prefix}{j + 1}", F.col("_arr")[j] * F.lit(signs[j]))
    drop = ["_xv", "_pcs", "_arr", *[f"_mu_{c}" for c in cols], *[f"_x_{c}" for c in cols]]
    return out.drop(*drop)


def attach_labels(rows: DataFrame, labels: DataFrame, key: str = "customer_id") -> DataFrame:
    """Labels to rows by key (J1): an equi-join, never by position."""
    return rows.join(labels, on=key, how="inner")
