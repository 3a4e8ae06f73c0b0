"""Catalog: scalers, clustering, metrics and model comparison (C11-C13, A14, G*, J1).

SQL checks of the metrics use a deterministic labelling (customers cut into
four equal groups by spend), since the label numbers of a fitted clusterer
depend on the optimiser. Fitted models are checked by invariants in tests.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import scale as Sc
from ..operators.cluster import compare as Cmp
from ..operators.cluster import metrics as Me
from ..operators.cluster import models as M
from ..operators.cluster.profile import cluster_stats, rank_labels
from . import views as V
from .flagship import segments
from .registry import register

FEATS = list(V.FEATURES)
R = 6  # decimals kept for computed doubles on both sides


def _round(df, cols, digits=R):
    return df.select(*[F.round(c, digits).alias(c) if c in cols else F.col(c) for c in df.columns])


def _scaled_sql(method: str) -> str:
    cols = ", ".join(f"round({f}, {R}) AS {f}" for f in FEATS)
    return V.sql(f"SELECT customer_id, {cols} FROM z_customers", V.CUSTOMERS_SQL, V.scaled_sql(method))


@register("c11_scale_standard", "C11, C14", _scaled_sql("standard"))
def c11_scale_standard(spark, sf_dir):
    return _round(V.scaled_customers(spark, sf_dir, "standard").select("customer_id", *FEATS), FEATS)


@register("c12_scale_robust", "C12, C14", _scaled_sql("robust"))
def c12_scale_robust(spark, sf_dir):
    return _round(V.scaled_customers(spark, sf_dir, "robust").select("customer_id", *FEATS), FEATS)


@register("c13_scale_minmax", "C13, C14", _scaled_sql("minmax"))
def c13_scale_minmax(spark, sf_dir):
    return _round(V.scaled_customers(spark, sf_dir, "minmax").select("customer_id", *FEATS), FEATS)


@register("c13_minmax_inverse", "C13", V.sql(
    "SELECT customer_id, round(total_spent, 2) AS total_spent, recency_days FROM customers", V.CUSTOMERS_SQL))
def c13_minmax_inverse(spark, sf_dir):
    raw = V.customers(spark, sf_dir)
    cols = ["total_spent", "recency_days"]
    params = Sc.fit_scaler(raw, cols, "minmax")
    back = Sc.apply_scaler(Sc.apply_scaler(raw, params, cols), params, cols, inverse=True)
    return back.select("customer_id", F.round("total_spent", 2).alias("total_spent"),
                       F.round("recency_days").cast("int").alias("recency_days"))


# -- deterministic labelling for SQL checks -----------------------------------
LABELLED_SQL = (V.CUSTOMERS_SQL, V.scaled_sql("standard"),
                V.rank_label_sql("z_customers", "total_spent, customer_id"))


def labelled(spark, sf_dir):
    return rank_labels(V.scaled_customers(spark, sf_dir), 4, ["total_spent", "customer_id"])


def _sq(a: str, b: str) -> str:
    return " + ".join(f"({a}{f} - {b}{f}) * ({a}{f} - {b}{f})" for f in FEATS)


CENT_SQL = ("cent AS (SELECT cluster, count(*) AS n, "
            + ", ".join(f"avg({f}) AS c_{f}" for f in FEATS) + " FROM labelled GROUP BY cluster)")
DIST_SQL = (f"dist AS (SELECT l.*, " + ", ".join(f"c.c_{f}" for f in FEATS)
            + f", {_sq('l.', 'c.c_')} AS sq FROM labelled l JOIN cent c USING (cluster))")


@register("a14_cluster_stats", "A14", V.sql("""
, raw AS (SELECT c.*, l.cluster FROM customers c JOIN labelled l USING (customer_id)),
long AS (UNPIVOT (SELECT cluster, """ + ", ".join(f"CAST({f} AS DOUBLE) AS {f}" for f in FEATS) + """ FROM raw)
         ON """ + ", ".join(FEATS) + """ INTO NAME feature VALUE value)
SELECT cluster, feature, count(value) AS n, round(avg(value), 6) AS mean,
       round(quantile_cont(value, 0.5), 6) AS median, round(stddev_samp(value), 6) AS std
FROM long GROUP BY cluster, feature
""", *LABELLED_SQL))
def a14_cluster_stats(spark, sf_dir):
    both = Sc.scale(V.customers(spark, sf_dir), FEATS, suffix="_z")  # the customers are made once, raw and scaled side by side
    raw = rank_labels(both, 4, ["total_spent_z", "customer_id"]).select("cluster", *FEATS).checkpoint(eager=True)
    return _round(cluster_stats(raw, FEATS), ["mean", "median", "std"])


@register("g9_inertia", "G9", V.sql(f", {CENT_SQL}, {DIST_SQL} SELECT round(sum(sq), {R}) AS inertia FROM dist",
                                    *LABELLED_SQL))
def g9_inertia(spark, sf_dir):
    return _round(Me.inertia(labelled(spark, sf_dir), FEATS), ["inertia"])


@register("g7_calinski_harabasz", "G7, G11", V.sql(f"""
, {CENT_SQL}, {DIST_SQL},
overall AS (SELECT count(*) AS big_n, {", ".join(f"avg({f}) AS m_{f}" for f in FEATS)} FROM labelled),
b AS (SELECT sum(n * ({" + ".join(f"(c_{f} - m_{f}) * (c_{f} - m_{f})" for f in FEATS)})) AS bb,
             count(*) AS k, any_value(big_n) AS big_n FROM cent, overall),
w AS (SELECT sum(sq) AS ww FROM dist)
SELECT round(CASE WHEN k < 2 THEN NULL WHEN ww = 0 THEN 1.0
                  ELSE bb * (big_n - k) / (ww * (k - 1)) END, {R}) AS calinski_harabasz FROM b, w
""", *LABELLED_SQL))
def g7_calinski_harabasz(spark, sf_dir):
    return _round(Me.calinski_harabasz(labelled(spark, sf_dir), FEATS), ["calinski_harabasz"])


DB_SQL = f"""
, {CENT_SQL}, {DIST_SQL},
spread AS (SELECT cluster, avg(sqrt(sq)) AS s, {", ".join(f"any_value(c_{f}) AS c_{f}" for f in FEATS)}
           FROM dist GROUP BY cluster),
pairs AS (SELECT a.cluster, a.s AS sa, b.s AS sb, sqrt({_sq('a.c_', 'b.c_')}) AS d
          FROM spread a JOIN spread b ON a.cluster <> b.cluster),
worst AS (SELECT cluster, max(CASE WHEN d > 0 THEN (sa + sb) / d ELSE 0 END) AS r FROM pairs GROUP BY cluster)
SELECT round(avg(r), {R}) AS davies_bouldin FROM worst
"""


@register("g8_davies_bouldin", "G8, G11", V.sql(DB_SQL, *LABELLED_SQL))
def g8_davies_bouldin(spark, sf_dir):
    return _round(Me.davies_bouldin(labelled(spark, sf_dir), FEATS), ["davies_bouldin"])


# From the definition: the mean squared distance to all other members of each cluster, pair by pair.
SIL_SQL = f"""
, pairs AS (SELECT a.customer_id AS id, a.cluster AS la, b.cluster AS lb, {_sq('a.', 'b.')} AS d
          FROM labelled a JOIN labelled b ON a.customer_id <> b.customer_id),
per AS (SELECT id, la, lb, avg(d) AS md FROM pairs GROUP BY id, la, lb),
ab AS (SELECT id, any_value(la) AS la, max(CASE WHEN la = lb THEN md END) AS a,
              min(CASE WHEN la <> lb THEN md END) AS b FROM per GROUP BY id),
sil AS (SELECT id AS customer_id, la AS cluster,
               CASE WHEN a IS NULL THEN 0.0 ELSE (b - a) / greatest(a, b) END AS silhouette FROM ab)
"""


@register("g6_silhouette_samples", "G6", V.sql(
    SIL_SQL + f"SELECT customer_id, cluster, round(silhouette, {R}) AS silhouette FROM sil", *LABELLED_SQL))
def g6_silhouette_samples(spark, sf_dir):
    return _round(Me.silhouette_samples(labelled(spark, sf_dir), FEATS), ["silhouette"])


@register("g5_silhouette", "G5, G11", V.sql(
    SIL_SQL + f"SELECT round(avg(silhouette), {R}) AS silhouette FROM sil", *LABELLED_SQL))
def g5_silhouette(spark, sf_dir):
    return _round(Me.silhouette(labelled(spark, sf_dir), FEATS), ["silhouette"])


# -- fitted models (invariant checks) ----------------------------------------
@register("g1_kmeans_segments", "G1, J1, S5")
def g1_kmeans_segments(spark, sf_dir):
    return segments(spark, sf_dir).select("customer_id", "cluster", *FEATS)


@register("g4_gmm_segments", "G4, J1")
def g4_gmm_segments(spark, sf_dir):
    z = V.scaled_customers(spark, sf_dir, materialise=True)
    lab, _ = M.gmm(z, FEATS, k=4, seed=42)
    return M.relabel(lab, "cluster", "total_spent").select("customer_id", "cluster")


@register("g12_pca_projection", "G12, G20")
def g12_pca_projection(spark, sf_dir):
    seg = segments(spark, sf_dir)
    z = Sc.scale(seg, FEATS, suffix="_z")
    pcs = M.pca(z, [f"{f}_z" for f in FEATS], k=3)
    return pcs.select("customer_id", "pc1", "pc2", "pc3", "cluster", "total_spent", "avg_ticket")


@register("g10_elbow", "G10")
def g10_elbow(spark, sf_dir):
    z = V.scaled_customers(spark, sf_dir).select(*FEATS).persist()  # from the written customers, scaled once
    try:
        total = Me.inertia(z.withColumn("cluster", F.lit(0)), FEATS).first()["inertia"]
        costs = {1: float(total), **M.kmeans_costs(z, FEATS, range(2, 11), seed=42)}
    finally:
        z.unpersist()
    return spark.createDataFrame(sorted(costs.items()), "k int, inertia double")


# -- metric tables over several labellings (SQL-checkable) --------------------
LABELLINGS = {"by_spend": "total_spent, customer_id", "by_recency": "recency_days, customer_id",
              "by_lines": "n_lines, customer_id"}


def _metric_long(spark, sf_dir):
    z = V.scaled_customers(spark, sf_dir, materialise=True)
    out = None
    for name, order in LABELLINGS.items():
        lab = rank_labels(z, 4, [c.strip() for c in order.split(",")], stable=False).select("cluster", *FEATS).checkpoint(eager=True)
        table = Me.label_table(lab, FEATS)
        row = Me.calinski_harabasz(lab, FEATS, table=table).crossJoin(Me.davies_bouldin(lab, FEATS, table=table)) \
            .crossJoin(Me.inertia(lab, FEATS, table=table)).withColumn("model", F.lit(name))
        out = row if out is None else out.unionByName(row)
    return out


def _metric_sql() -> str:
    parts = []
    for name, order in LABELLINGS.items():
        lab = V.rank_label_sql("z_customers", order, out=f"lab_{name}")
        cent = (f"cent_{name} AS (SELECT cluster, count(*) AS n, "
                + ", ".join(f"avg({f}) AS c_{f}" for f in FEATS) + f" FROM lab_{name} GROUP BY cluster)")
        dist = (f"dist_{name} AS (SELECT l.*, " + ", ".join(f"c.c_{f}" for f in FEATS)
                + f", {_sq('l.', 'c.c_')} AS sq FROM lab_{name} l JOIN cent_{name} c USING (cluster))")
        ov = f"ov_{name} AS (SELECT count(*) AS big_n, " + ", ".join(f"avg({f}) AS m_{f}" for f in FEATS) + f" FROM lab_{name})"
        spread = (f"spread_{name} AS (SELECT cluster, avg(sqrt(sq)) AS s, "
                  + ", ".join(f"any_value(c_{f}) AS c_{f}" for f in FEATS) + f" FROM dist_{name} GROUP BY cluster)")
        m = f"""m_{name} AS (
  SELECT '{name}' AS model,
    (SELECT bb * (big_n - k) / (ww * (k - 1)) FROM
       (SELECT sum(n * ({" + ".join(f"(c_{f} - m_{f}) * (c_{f} - m_{f})" for f in FEATS)})) AS bb, count(*) AS k,
               any_value(big_n) AS big_n FROM cent_{name}, ov_{name}),
       (SELECT sum(sq) AS ww FROM dist_{name})) AS calinski_harabasz,
    (SELECT avg(r) FROM (SELECT a.cluster, max((a.s + b.s) / sqrt({_sq('a.c_', 'b.c_')})) AS r
        FROM spread_{name} a JOIN spread_{name} b ON a.cluster <> b.cluster GROUP BY a.cluster)) AS davies_bouldin,
    (SELECT sum(sq) FROM dist_{name}) AS inertia)"""
        parts += [lab, cent, dist, ov, spread, m]
    union = " UNION ALL ".join(f"SELECT * FROM m_{n}" for n in LABELLINGS)
    return ", ".join(parts) + f", metrics AS ({union})"


METRICS_SQL = (V.CUSTOMERS_SQL, V.scaled_sql("standard"), _metric_sql())


@register("g15_metrics_table", "G15, G13", V.sql(f"""
SELECT model, round(calinski_harabasz, {R}) AS calinski_harabasz, round(davies_bouldin, {R}) AS davies_bouldin,
       round(inertia, {R - 2}) AS inertia,
       round(CASE WHEN davies_bouldin IS NULL OR davies_bouldin = 0 THEN 0 ELSE 1 / davies_bouldin END, {R})
         AS inverse_davies_bouldin
FROM metrics""", *METRICS_SQL))
def g15_metrics_table(spark, sf_dir):
    t = Cmp.metrics_table(_metric_long(spark, sf_dir))
    t = _round(t, ["calinski_harabasz", "davies_bouldin", "inverse_davies_bouldin"])
    return t.withColumn("inertia", F.round("inertia", R - 2)) \
        .select("model", "calinski_harabasz", "davies_bouldin", "inertia", "inverse_davies_bouldin")


@register("g14_best_clusterer", "G14", V.sql("""
SELECT model FROM metrics ORDER BY calinski_harabasz DESC NULLS LAST, model LIMIT 1""", *METRICS_SQL))
def g14_best_clusterer(spark, sf_dir):
    best = Cmp.best_clusterer(_metric_long(spark, sf_dir), by="calinski_harabasz",
                              model_order=sorted(LABELLINGS))
    return best.select("model")


@register("g16_metric_radar", "G16", V.sql(f"""
SELECT model,
  round(CASE WHEN max(calinski_harabasz) OVER () = min(calinski_harabasz) OVER () THEN 0.5
        ELSE (calinski_harabasz - min(calinski_harabasz) OVER ())
             / (max(calinski_harabasz) OVER () - min(calinski_harabasz) OVER ()) END, {R}) AS calinski_harabasz_norm,
  round(CASE WHEN max(davies_bouldin) OVER () = min(davies_bouldin) OVER () THEN 0.5
        ELSE (davies_bouldin - min(davies_bouldin) OVER ())
             / (max(davies_bouldin) OVER () - min(davies_bouldin) OVER ()) END, {R}) AS davies_bouldin_norm
FROM metrics""", *METRICS_SQL))
def g16_metric_radar(spark, sf_dir):
    r = Cmp.metric_radar(_metric_long(spark, sf_dir), ["calinski_harabasz", "davies_bouldin"])
    return _round(r, ["calinski_harabasz_norm", "davies_bouldin_norm"])


# -- density, hierarchical, comparison (invariant checks) ----------------------
# From the definition: every pair of customers, labels spread over core pairs until they settle (80 rounds are far
# beyond the longest chain of core customers in the test tables), clusters numbered by their smallest core customer.
DBSCAN_SQL = f"""
, near AS MATERIALIZED (SELECT a.customer_id AS a, b.customer_id AS b FROM z_customers a, z_customers b
                        WHERE {_sq('a.', 'b.')} <= 0.7 * 0.7),
core AS MATERIALIZED (SELECT a AS id FROM near GROUP BY a HAVING count(*) >= 10),
edge AS MATERIALIZED (SELECT a, b FROM near WHERE a IN (SELECT id FROM core) AND b IN (SELECT id FROM core)),
spread AS (
  SELECT 0 AS round, id, id AS root FROM core
  UNION ALL
  SELECT round + 1, a, min(root) FROM spread JOIN edge ON b = id WHERE round < 80 GROUP BY round, a
),
settled AS (SELECT id, root FROM spread WHERE round = 80),
numbered AS (SELECT id, CAST(dense_rank() OVER (ORDER BY root) - 1 AS INTEGER) AS num FROM settled),
reached AS (SELECT a AS id, min(num) AS num FROM near JOIN numbered ON b = numbered.id GROUP BY a)
SELECT customer_id, coalesce(n.num, r.num, -1) AS cluster
FROM z_customers LEFT JOIN numbered n ON n.id = customer_id LEFT JOIN reached r ON r.id = customer_id
"""


@register("g2_dbscan_segments", "G2", "WITH RECURSIVE" + V.sql(DBSCAN_SQL, V.CUSTOMERS_SQL, V.scaled_sql("standard"))[4:])
def g2_dbscan_segments(spark, sf_dir):
    from ..operators.cluster.dbscan import dbscan
    return dbscan(V.scaled_customers(spark, sf_dir, materialise=True), FEATS, "customer_id", eps=0.7, min_samples=10)


@register("g3_ward_segments", "G3")
def g3_ward_segments(spark, sf_dir):
    from ..operators.cluster.ward import ward
    lab, _ = ward(V.scaled_customers(spark, sf_dir, materialise=True), FEATS, "customer_id", k=4)
    return lab


@register("g18_dendrogram_merges", "G18")
def g18_dendrogram_merges(spark, sf_dir):
    from ..operators.cluster.ward import ward
    _, log = ward(V.scaled_customers(spark, sf_dir, materialise=True), FEATS, "customer_id", k=4)
    return log


@register("g13_compare_clusterers", "G13, G5, G7, G8, G9, G11, W11")
def g13_compare_clusterers(spark, sf_dir):
    from ..operators.cluster.segment import compare_clusterers
    return compare_clusterers(V.scaled_customers(spark, sf_dir, materialise=True), FEATS, "customer_id", k=4)


@register("g19_segment_view", "G19, G12")
def g19_segment_view(spark, sf_dir):
    from ..operators.cluster.segment import segment
    return segment(V.scaled_customers(spark, sf_dir, materialise=True), FEATS, "customer_id", "gmm", k=4)


@register("h9_cluster_scatter", "H9, G1")
def h9_cluster_scatter(spark, sf_dir):
    from ..operators.dist import cluster_scatter
    z = V.scaled_customers(spark, sf_dir, materialise=True)
    lab, model = M.kmeans(z, FEATS, k=4, seed=42)
    cents = spark.createDataFrame(M.centers(model, FEATS), ", ".join(["cluster int"] + [f"{f} double" for f in FEATS]))
    return cluster_scatter(lab, cents, FEATS[0], FEATS[1], "customer_id")


_G17 = ["calinski_harabasz", "davies_bouldin", "inertia"]


@register("g17_metric_correlation", "G17, E6", V.sql(", mc AS (SELECT " + ", ".join(
    f"NULLIF({m}, 0) AS {m}" for m in _G17) + " FROM metrics), pairs AS (" + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS corr FROM mc" for a in _G17 for b in _G17) + f""")
SELECT a, b, round(COALESCE(corr, 0), {R}) AS corr FROM pairs""", *METRICS_SQL))
def g17_metric_correlation(spark, sf_dir):
    c = Cmp.metric_correlation(_metric_long(spark, sf_dir), _G17)
    return c.select("a", "b", F.round("corr", R).alias("corr"))


_SQ = " + ".join(f"{f} * {f}" for f in FEATS)


@register("g5_silhouette_sq_full", "G5, G11", V.sql(f"""
, pts AS (SELECT *, {_SQ} AS nx FROM labelled),
cs AS (SELECT cluster AS c, count(*) AS n, avg(nx) AS ny, {", ".join(f"avg({f}) AS m_{f}" for f in FEATS)}
       FROM pts GROUP BY cluster),
d AS (SELECT p.customer_id, p.cluster, cs.c, cs.n,
             p.nx - 2 * ({" + ".join(f"p.{f} * cs.m_{f}" for f in FEATS)}) + cs.ny AS dd
      FROM pts p, cs),
ab AS (SELECT customer_id,
              max(CASE WHEN c = cluster THEN n END) AS n_own,
              max(CASE WHEN c = cluster THEN dd * n / (n - 1) END) AS a,
              min(CASE WHEN c <> cluster THEN dd END) AS b
       FROM d GROUP BY customer_id),
s AS (SELECT CASE WHEN n_own <= 1 THEN 0 WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1 ELSE 0 END AS s FROM ab)
SELECT round(avg(s), {R}) AS silhouette_sq_full FROM s""", *LABELLED_SQL))
def g5_silhouette_sq_full(spark, sf_dir):
    score = Me.silhouette(labelled(spark, sf_dir), FEATS).withColumnRenamed("silhouette", "silhouette_sq_full")
    return _round(score, ["silhouette_sq_full"])
