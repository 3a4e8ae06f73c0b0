"""How often the queries of customers and the profile read their input, beside their results; all rows are built here."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from mercato.plans import catalog_segments as CS
from mercato.plans import views as V


def _lines(spark, seen=None, n=600):
    """Invoice lines of 30 customers; ``seen`` is an accumulator that counts each time a line is made."""
    def made(i):
        if seen is not None:
            seen.add(1)
        return i
    number = F.udf(made, "long").asNondeterministic()("id")  # so that it is not copied into filters
    return spark.range(n, numPartitions=3).withColumn("i", number).selectExpr(
        "i % 30 AS customer_id", "i % 7 AS stock_code", "CAST((i * 37) % 101 AS DECIMAL(18,2)) AS sales",
        "timestampadd(DAY, CAST(i % 50 AS INT), TIMESTAMP '2020-01-01 00:00:00') AS invoice_date")


def _one_pass(spark, monkeypatch, query):
    seen = spark.sparkContext.accumulator(0)
    monkeypatch.setattr(V, "clean_customers", lambda s, d: _lines(s, seen))
    out = query(spark, "nowhere").toPandas()
    assert seen.value == 600
    return out


def test_dbscan_query_makes_the_lines_once(spark, monkeypatch):
    out = _one_pass(spark, monkeypatch, CS.g2_dbscan_segments)
    assert sorted(out["customer_id"]) == list(range(30))


def test_customer_features_of_the_latest_line(spark):
    from mercato.operators.customers import customer_features
    got = customer_features(_lines(spark)).toPandas().set_index("customer_id")
    lines = _lines(spark).toPandas()
    last = lines.groupby("customer_id")["invoice_date"].max()
    assert got["recency_days"].to_dict() == (lines["invoice_date"].max() - last).dt.days.to_dict()
    assert got["n_products"].to_dict() == lines.groupby("customer_id")["stock_code"].nunique().to_dict()
    assert (got["n_lines"] == 20).all()


def test_metrics_query_makes_one_label_table_per_labelling(spark, monkeypatch):
    from mercato.operators.cluster import metrics as Me
    from mercato.operators.cluster.profile import rank_labels
    tables, real = [], Me.label_table
    monkeypatch.setattr(Me, "label_table", lambda *a, **k: tables.append(1) or real(*a, **k))
    out = _one_pass(spark, monkeypatch, CS.g15_metrics_table).set_index("model")
    assert len(tables) == 3
    for name, order in CS.LABELLINGS.items():
        lab = rank_labels(V.scaled_customers(spark, "nowhere", materialise=True), 4, order.split(", "))
        assert out.loc[name, "inertia"] == pytest.approx(Me.inertia(lab, CS.FEATS).first()[0], abs=1e-3)
        assert out.loc[name, "davies_bouldin"] == pytest.approx(Me.davies_bouldin(lab, CS.FEATS).first()[0], abs=1e-5)
        assert out.loc[name, "calinski_harabasz"] == pytest.approx(Me.calinski_harabasz(lab, CS.FEATS).first()[0], abs=1e-5)


def test_cluster_stats_query_makes_the_customers_once(spark, monkeypatch):
    out = _one_pass(spark, monkeypatch, CS.a14_cluster_stats)
    raw = V.customers(spark, "nowhere").toPandas().sort_values(["total_spent", "customer_id"])
    raw["cluster"] = np.arange(30) * 4 // 30
    for r in out.itertuples():
        x = raw.loc[raw["cluster"] == r.cluster, r.feature].astype(float)
        assert (r.n, r.mean, r.median, r.std) == pytest.approx((len(x), x.mean(), x.median(), x.std()), abs=1e-5)
    assert len(out) == 20


def test_elbow_query_makes_the_lines_once(spark, monkeypatch):
    out = _one_pass(spark, monkeypatch, CS.g10_elbow)
    assert out["k"].tolist() == list(range(1, 11)) and out["inertia"].iloc[0] > out["inertia"].iloc[-1]


def test_elbow_query_assembles_the_vectors_once(spark, monkeypatch):
    """Nine fits share one set of vectors; side by side they find what each finds alone, and nothing stays in memory."""
    from mercato.operators.cluster import models as M
    calls, real = [], M.assemble
    monkeypatch.setattr(M, "assemble", lambda *a, **k: calls.append(1) or real(*a, **k))
    kept = spark.sparkContext._jsc.getPersistentRDDs().size()
    out = _one_pass(spark, monkeypatch, CS.g10_elbow).set_index("k")["inertia"]
    assert len(calls) == 1 and spark.sparkContext._jsc.getPersistentRDDs().size() == kept
    z = V.scaled_customers(spark, "nowhere", materialise=True)
    assert out[1] == pytest.approx(30 * sum(z.toPandas()[f].var(ddof=0) for f in CS.FEATS))
    for k in (2, 5, 10):
        assert out[k] == pytest.approx(M.kmeans(z, CS.FEATS, k=k, seed=42)[1].summary.trainingCost)


def test_profile_reads_each_row_three_times(spark):
    """One pass for counts, moments and brackets, one for the quantiles, one for the distinct values."""
    from mercato.operators import explore as E
    seen = spark.sparkContext.accumulator(0)
    made = F.udf(lambda i: seen.add(1) or i, "long")
    df = spark.range(500, numPartitions=2).select(made("id").alias("n")).selectExpr("n", "n % 3 AS m", "string(n % 4) AS s")
    got = {r["column"]: r for r in E.profile(df).drop("top_values").collect()}
    assert seen.value == 1500
    assert [got[c]["distinct"] for c in "nms"] == [500, 3, 4] and got["n"]["p50"] == 249.5


def test_profile_of_odd_values(spark):
    """Values are told apart as text: -0.0 is not 0.0; empty columns and tables keep their form."""
    from mercato.operators import explore as E
    rows = [(0.0, 1, None, True, "a"), (-0.0, 1, None, None, "1"), (2.5, None, None, False, "1.0"), (2.5, 0, None, True, None),
            (1.0, -3, None, True, "a"), (None, 1, None, True, "A")]
    df = spark.createDataFrame(rows, "d double, l int, e double, b boolean, s string")
    got = {r["column"]: r for r in E.profile(df).collect()}
    assert {c: got[c]["distinct"] for c in got} == {"d": 4, "l": 3, "e": 0, "b": 2, "s": 4}
    assert {c: (got[c]["n_rows"], got[c]["count"], got[c]["missing"]) for c in got} \
        == {"d": (6, 5, 1), "l": (6, 5, 1), "e": (6, 0, 6), "b": (6, 5, 1), "s": (6, 5, 1)}
    assert (got["d"]["zeros"], got["l"]["zeros"], got["l"]["negatives"], got["e"]["zeros"], got["s"]["zeros"]) == (2, 1, 1, None, None)
    assert got["l"]["mean"] == 0.0 and got["l"]["p50"] == 1.0 and got["e"]["p50"] is None and got["d"]["mean"] == 1.2
    assert got["s"]["top_values"][0] == "a" and got["e"]["top_values"] is None
    assert E.profile(df.limit(0)).count() == 0
    nans = spark.createDataFrame([(float("nan"),), (float("nan"),), (float("-inf"),), (None,)], "x float")
    assert E.distinct_values(nans).first()["distinct"] == 2
    plain = {r["column"]: r["distinct"] for r in E.profile(df.select("s", "b")).collect()}
    assert plain == {"s": 4, "b": 2}
