"""Clusterers recover planted blobs; metrics follow their definitions;
DBSCAN equals a brute-force implementation."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from mercato.operators.cluster import metrics as Me
from mercato.operators.cluster import models as M
from mercato.operators.cluster.dbscan import dbscan
from mercato.operators.cluster.ward import ward

FEATS = ["a", "b"]


def blobs(spark, n_per=60, seed=1, noise=0):
    rng = np.random.default_rng(seed)
    centres = np.array([[0, 0], [8, 0], [0, 8], [8, 8]], dtype=float)
    rows, truth = [], {}
    i = 0
    for c, ctr in enumerate(centres):
        for p in rng.normal(ctr, 0.5, size=(n_per, 2)):
            rows.append((i, float(p[0]), float(p[1])))
            truth[i] = c
            i += 1
    for p in rng.uniform(20, 40, size=(noise, 2)):
        rows.append((i, float(p[0]), float(p[1])))
        truth[i] = -1
        i += 1
    return spark.createDataFrame(rows, "id long, a double, b double"), truth


def same_partition(got: dict, truth: dict) -> bool:
    pairs = {}
    for k, t in truth.items():
        pairs.setdefault(t, set()).add(got[k])
    return all(len(v) == 1 for v in pairs.values()) and len({next(iter(v)) for v in pairs.values()}) == len(pairs)


def test_kmeans_recovers_blobs_and_covers_every_key(spark):
    df, truth = blobs(spark)
    lab, model = M.kmeans(df, FEATS, k=4)
    got = {r["id"]: r["cluster"] for r in lab.collect()}
    assert len(got) == len(truth)
    assert same_partition(got, truth)
    assert model.summary.trainingCost > 0


def test_gmm_and_ward_recover_blobs(spark):
    df, truth = blobs(spark)
    g, _ = M.gmm(df, FEATS, k=4)
    assert same_partition({r["id"]: r["cluster"] for r in g.collect()}, truth)
    w, log = ward(df, FEATS, "id", k=4)
    assert same_partition({r["id"]: r["cluster"] for r in w.collect()}, truth)
    merges = log.orderBy("step").collect()
    assert merges[-1]["size"] == df.count() and len(merges) <= df.count() - 1
    heights = [r["height"] for r in merges]
    assert heights[-1] == max(heights)


def test_ward_bounds_its_items_and_keeps_string_keys_and_incomplete_rows(spark):
    df, truth = blobs(spark)
    df = df.withColumn("id", F.concat(F.lit("c"), F.col("id")))
    gap = spark.createDataFrame([("gap", None, 1.0)], "id string, a double, b double")
    w, log = ward(df.unionByName(gap), FEATS, "id", k=4, micro_clusters=20)
    got = {r["id"]: r["cluster"] for r in w.collect()}
    assert got.pop("gap") is None
    assert same_partition(got, {f"c{i}": t for i, t in truth.items()})
    assert log.count() <= 19


def _brute_dbscan(x, eps, min_samples, ids):
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2))
    nb = d <= eps
    core = nb.sum(axis=1) >= min_samples
    comp = -np.ones(len(x), dtype=int)
    for s in np.argsort(ids):
        if not core[s] or comp[s] >= 0:
            continue
        stack = [s]
        comp[s] = s
        while stack:
            i = stack.pop()
            for j in np.nonzero(nb[i] & core)[0]:
                if comp[j] < 0:
                    comp[j] = s
                    stack.append(j)
    root_id = {c: min(ids[comp == c]) for c in set(comp[core])}
    order = {c: n for n, c in enumerate(sorted(root_id, key=lambda c: root_id[c]))}
    out = {}
    for i in range(len(x)):
        if core[i]:
            out[ids[i]] = order[comp[i]]
        else:
            reach = [order[comp[j]] for j in np.nonzero(nb[i] & core)[0]]
            out[ids[i]] = min(reach) if reach else -1
    return out


@pytest.mark.parametrize("eps,min_samples", [(0.7, 10), (1.2, 5), (0.3, 3)])
def test_dbscan_equals_brute_force(spark, eps, min_samples):
    df, _ = blobs(spark, n_per=40, noise=15, seed=3)
    # duplicate some points so identical rows are collapsed and weighted
    dup = df.where(F.col("id") < 10).withColumn("id", F.col("id") + 10_000)
    df = df.unionByName(dup)
    pdf = df.toPandas()
    want = _brute_dbscan(pdf[FEATS].to_numpy(), eps, min_samples, pdf["id"].to_numpy())
    got = {r["id"]: r["cluster"] for r in dbscan(df, FEATS, "id", eps=eps, min_samples=min_samples).collect()}
    assert got == want


def test_dbscan_keeps_string_keys_and_rows_with_missing_features(spark):
    df, _ = blobs(spark, n_per=40, noise=15, seed=3)
    named = df.withColumn("id", F.format_string("k%06d", F.col("id")))
    gap = spark.createDataFrame([("gap", None, 1.0), ("nan", float("nan"), 1.0), ("inf", 1.0, float("inf"))],
                                "id string, a double, b double")
    got = {r["id"]: r["cluster"] for r in dbscan(named.unionByName(gap), FEATS, "id").collect()}
    assert [got.pop(k) for k in ("gap", "nan", "inf")] == [None, None, None]
    want = {r["id"]: r["cluster"] for r in dbscan(df, FEATS, "id").collect()}
    assert got == {f"k{k:06d}": c for k, c in want.items()}


def test_dbscan_on_hot_points_and_dense_cells_in_chunks(spark):
    """A third of the rows are one point, dense sub-cells are met in chunks, and two dense bands lie just apart."""
    rng = np.random.default_rng(9)
    pts = [(0.0, 0.0)] * 300 + [tuple(p) for p in rng.uniform((0, 0), (1, 1), (300, 2))] \
        + [tuple(p) for p in rng.uniform((1.45, 0), (2.4, 1), (300, 2))] \
        + [tuple(p) for p in rng.uniform((3.3, 0), (6, 4), (60, 2))]
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(pts)], "id long, a double, b double")
    pdf = df.toPandas()
    for eps, least in ((0.5, 10), (0.44, 6), (0.9, 40)):
        want = _brute_dbscan(pdf[FEATS].to_numpy(), eps, least, pdf["id"].to_numpy())
        got = {r["id"]: r["cluster"] for r in dbscan(df, FEATS, "id", eps=eps, min_samples=least, chunk=7).collect()}
        assert got == want


def test_dbscan_empty_and_all_noise(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0), (2, 9.0, 9.0)], "id long, a double, b double")
    assert {r["cluster"] for r in dbscan(df, FEATS, "id").collect()} == {-1}
    assert dbscan(df.limit(0), FEATS, "id").count() == 0


def test_metrics_match_numpy_definitions(spark):
    df, truth = blobs(spark, n_per=30)
    lab = df.withColumn("cluster", (F.col("id") / 30).cast("int"))
    pdf = lab.toPandas()
    x, y = pdf[FEATS].to_numpy(), pdf["cluster"].to_numpy()
    cents = np.array([x[y == c].mean(axis=0) for c in range(4)])
    w = sum(((x[y == c] - cents[c]) ** 2).sum() for c in range(4))
    b = sum((y == c).sum() * ((cents[c] - x.mean(axis=0)) ** 2).sum() for c in range(4))
    ch = b * (len(x) - 4) / (w * 3)
    s = np.array([np.sqrt(((x[y == c] - cents[c]) ** 2).sum(axis=1)).mean() for c in range(4)])
    dc = np.sqrt(((cents[:, None] - cents[None]) ** 2).sum(axis=2))
    np.fill_diagonal(dc, np.inf)
    db = np.mean(np.max((s[:, None] + s[None]) / dc, axis=1))
    d = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    sil = []
    for i in range(len(x)):
        a = d[i, y == y[i]].sum() / ((y == y[i]).sum() - 1)
        bb = min(d[i, y == c].mean() for c in range(4) if c != y[i])
        sil.append((bb - a) / max(a, bb))
    assert Me.inertia(lab, FEATS).first()[0] == pytest.approx(w)
    assert Me.calinski_harabasz(lab, FEATS).first()[0] == pytest.approx(ch)
    assert Me.davies_bouldin(lab, FEATS).first()[0] == pytest.approx(db)
    assert Me.silhouette(lab, FEATS, key="id").first()[0] == pytest.approx(np.mean(sil))


def test_metric_guard_single_label(spark):
    df, _ = blobs(spark, n_per=10)
    one = df.withColumn("cluster", F.lit(0))
    assert Me.calinski_harabasz(one, FEATS).first()[0] is None
    assert Me.davies_bouldin(one, FEATS).first()[0] is None
    assert Me.silhouette(one, FEATS, key="id").first()[0] is None


def test_silhouette_scores_all_rows_and_keeps_incomplete_ones(spark):
    df, _ = blobs(spark, n_per=10)
    lab = df.withColumn("cluster", (F.col("id") % 2).cast("int"))
    gaps = spark.createDataFrame([(900, None, 1.0, 0), (901, 1.0, 1.0, None)],
                                 "id long, a double, b double, cluster int")
    per = {r["id"]: r["silhouette"] for r in Me.silhouette_samples(lab.unionByName(gaps), FEATS, key="id").collect()}
    plain = {r["id"]: r["silhouette"] for r in Me.silhouette_samples(lab, FEATS, key="id").collect()}
    assert per.pop(900) is None and per.pop(901) is None
    assert per == pytest.approx(plain) and len(plain) == 40


def test_stratified_sample_quotas(spark):
    from mercato.operators.sample import stratified_sample
    rows = [(i, 0 if i < 900 else 1) for i in range(1000)]
    df = spark.createDataFrame(rows, "id long, cluster int")
    s = stratified_sample(df, "cluster", 100, "id").groupBy("cluster").count().collect()
    assert {r["cluster"]: r["count"] for r in s} == {0: 90, 1: 10}


def test_pca_projection_centred(spark):
    df, _ = blobs(spark)
    p = M.pca(df, FEATS, k=2).agg(F.avg("pc1"), F.avg("pc2")).first()
    assert abs(p[0]) < 1e-9 and abs(p[1]) < 1e-9


def test_full_squared_silhouette_matches_spark_evaluator(spark):
    from pyspark.ml.evaluation import ClusteringEvaluator
    df, _ = blobs(spark, n_per=40)
    lab = df.withColumn("cluster", (F.col("id") % 3).cast("int"))
    ours = Me.silhouette(lab, FEATS, key="id").first()[0]
    vec = M.assemble(lab, FEATS)
    ref = ClusteringEvaluator(featuresCol="features", predictionCol="cluster",
                              distanceMeasure="squaredEuclidean").evaluate(vec)
    assert ours == pytest.approx(ref, rel=1e-9, abs=1e-12)


def test_dispersion_of_a_hundred_thousand_labels_sends_none_to_the_rows(spark):
    """One row per label is kept as a row: neither the inertia nor the Calinski-Harabasz score broadcasts them."""
    df = spark.range(200_000).selectExpr("id", "int(id % 100000) AS cluster", "double(id % 100000) AS a",
                                         "IF(id < 100000, 1e6 + 1, 1e6 - 1) AS b")
    assert Me.inertia(df, FEATS).first()["inertia"] == pytest.approx(200_000)
    plan = Me.calinski_harabasz(df, FEATS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastExchange") <= 1  # the one row of overall means
    between = 2 * sum((i - 49_999.5) ** 2 for i in range(100_000))
    assert Me.calinski_harabasz(df, FEATS).first()[0] == pytest.approx(between * 100_000 / (200_000 * 99_999))


def _greedy_ward(sizes, cents):
    """Merge the cheapest of all pairs, again and again."""
    act = {i: (float(n), np.array(c, dtype=float)) for i, (n, c) in enumerate(zip(sizes, cents))}
    out = []
    while len(act) > 1:
        ids = sorted(act)
        cost, a, b = min((act[i][0] * act[j][0] / (act[i][0] + act[j][0]) * ((act[i][1] - act[j][1]) ** 2).sum(), i, j)
                         for x, i in enumerate(ids) for j in ids[x + 1:])
        (na, ca), (nb, cb) = act.pop(a), act.pop(b)
        act[len(sizes) + len(out)] = (na + nb, (na * ca + nb * cb) / (na + nb))
        out.append((a, b, np.sqrt(2 * cost), int(na + nb)))
    return out


def test_ward_chain_gives_the_merges_of_the_greedy_order():
    from mercato.operators.cluster.ward import ward_merges
    for seed in range(5):
        rng = np.random.default_rng(seed)
        sizes, cents = rng.integers(1, 50, 70), rng.normal(size=(70, 3))
        got, want = ward_merges(sizes, cents), _greedy_ward(sizes, cents)
        assert [(g[0], g[1], g[3]) for g in got] == [(w[0], w[1], w[3]) for w in want]
        assert np.allclose([g[2] for g in got], [w[2] for w in want])


def test_ward_chain_with_ties_few_items_and_thousands():
    import time
    from mercato.operators.cluster.ward import cut_tree, ward_merges
    assert ward_merges(np.array([3]), np.array([[1.0, 2.0]])) == []
    assert ward_merges(np.array([1, 2]), np.array([[0.0], [0.0]])) == [(0, 1, 0.0, 3)]
    grid = np.array([[i, j] for i in range(6) for j in range(6)], dtype=float)  # many equal costs, copies
    merges = ward_merges(np.ones(72), np.vstack([grid, grid]))
    heights = [x[2] for x in merges]
    assert len(merges) == 71 and heights == sorted(heights) and heights[35] == 0.0 < heights[36]
    assert merges[-1][3] == 72 and len(set(cut_tree(72, merges, 4))) == 4
    rng = np.random.default_rng(0)
    centres = rng.normal(0, 100, size=(4, 5))
    t0 = time.time()
    merges = ward_merges(np.ones(5000), np.repeat(centres, 1250, axis=0) + rng.normal(size=(5000, 5)))
    assert time.time() - t0 < 60
    labels = cut_tree(5000, merges, 4).reshape(4, 1250)
    assert (labels == labels[:, :1]).all() and len(set(labels[:, 0])) == 4
