"""Ward agglomerative clustering over all rows.

Rows are first summarised into at most ``micro_clusters`` weighted
micro-clusters by Spark K-Means (each carries its size and centroid); Ward
merges then run on those summaries, whose number is a parameter and does not
grow with the data. The path is the same at every size; a few thousand
micro-clusters take seconds and some megabytes on the driver. The merge cost of clusters i, j is
n_i n_j / (n_i + n_j) · ‖c_i − c_j‖²; the height reported is √(2 · cost),
which equals the Euclidean distance for two single points.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .models import kmeans

MICRO_CLUSTERS = 500


def _summaries(df: DataFrame, feats: Sequence[str], key: str, micro_clusters: int, seed: int):
    """(item table with key → item id, item sizes, item centroids)."""
    items, _ = kmeans(df.select(key, *feats), feats, k=micro_clusters, seed=seed, label="_item")
    summ = items.groupBy("_item").agg(F.count(F.lit(1)).alias("_n"), *[F.avg(f).alias(f) for f in feats]) \
        .orderBy("_item").collect()  # at most micro_clusters rows
    ids = [r["_item"] for r in summ]
    sizes = np.array([r["_n"] for r in summ], dtype=float)
    cents = np.array([[r[f] for f in feats] for r in summ], dtype=float)
    return items.select(key, "_item"), ids, sizes, cents


def ward_merges(sizes: np.ndarray, cents: np.ndarray):
    """Ward linkage on weighted items: list of (left, right, height, size)
    in merge order, new clusters numbered from len(items) upward.

    Nearest-neighbour chain: follow nearest neighbours until two clusters are
    each other's nearest, merge these, and go on from what is left of the
    chain. Ward's cost never falls by a merge, so such pairs are merges of the
    greedy order too, and sorting them by height gives that order. A step costs
    one row of costs; the memory is that of 2 m centroids, never m x m."""
    m = len(sizes)
    n = np.concatenate([np.asarray(sizes, dtype=float), np.zeros(max(m - 1, 0))])
    c = np.vstack([np.asarray(cents, dtype=float), np.zeros((max(m - 1, 0), np.shape(cents)[1]))])
    alive = np.arange(m)  # ids of the clusters, in ascending order
    chain, found = [], []
    for new in range(m, 2 * m - 1):
        while True:
            if not chain:
                chain.append(int(alive[0]))
            top = chain[-1]
            cost = n[top] * n[alive] / (n[top] + n[alive]) * ((c[alive] - c[top]) ** 2).sum(axis=1)
            cost[np.searchsorted(alive, top)] = np.inf
            at = int(np.argmin(cost))
            if len(chain) > 1:  # a tie goes back to where the chain came from, so that it ends
                back = int(np.searchsorted(alive, chain[-2]))
                if cost[back] <= cost[at]:
                    break
            chain.append(int(alive[at]))
        a, b = sorted((chain.pop(), chain.pop()))
        n[new] = n[a] + n[b]
        c[new] = (n[a] * c[a] + n[b] * c[b]) / n[new]
        found.append((a, b, float(np.sqrt(2 * cost[back])), new))
        alive = np.append(alive[(alive != a) & (alive != b)], new)
    # a cluster is younger than its parts, so equal heights keep parts first
    found.sort(key=lambda f: (f[2], f[3]))
    number = {f[3]: m + i for i, f in enumerate(found)}
    return [(*sorted((number.get(a, a), number.get(b, b))), h, int(n[new])) for a, b, h, new in found]


def cut_tree(m: int, merges, k: int) -> np.ndarray:
    """Item → cluster index after stopping with k clusters left."""
    parent = list(range(m + len(merges)))
    for step, (a, b, _, _) in enumerate(merges[: max(m - k, 0)]):
        parent[a] = m + step
        parent[b] = m + step

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    roots = [root(i) for i in range(m)]
    order = {r: n for n, r in enumerate(sorted(set(roots)))}
    return np.array([order[r] for r in roots])


def ward(df: DataFrame, feats: Sequence[str], key: str, k: int = 4, micro_clusters: int = MICRO_CLUSTERS,
         seed: int = 42, label: str = "cluster"):
    """Labels ``(key, label)`` and the merge log as a DataFrame (G18): one
    merge less than there are micro-clusters. ``micro_clusters`` bounds the
    driver's work at every size; a row with a missing feature keeps its place
    with a NULL label."""
    spark = df.sparkSession
    item_of, ids, sizes, cents = _summaries(df, feats, key, micro_clusters, seed)
    merges = ward_merges(sizes, cents)
    assign = cut_tree(len(ids), merges, k)
    mapping = spark.createDataFrame([(ids[i], int(assign[i])) for i in range(len(ids))], f"_item int, {label} int")
    labels = item_of.join(F.broadcast(mapping), "_item").select(key, label)
    incomplete = df.where(" OR ".join(f"`{f}` IS NULL" for f in feats)) \
        .select(key, F.lit(None).cast("int").alias(label))
    labels = labels.unionByName(incomplete)
    log = spark.createDataFrame([(s, a, b, h, n) for s, (a, b, h, n) in enumerate(merges)],
                                "step int, left long, right long, height double, size long")
    return labels, log
