"""Edge cases of cleaning, scaling, series and distribution operators."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from mercato.operators import clean as C
from mercato.operators import dist as D
from mercato.operators import scale as Sc
from mercato.operators import series as W


def test_impute_median_interpolates(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (None,)], "x double")
    out = sorted(r["x"] for r in C.impute_median(df, ["x"]).collect())
    assert out == [1.0, 2.0, 2.5, 3.0, 10.0]


def test_impute_skips_columns_without_nulls(spark):
    df = spark.createDataFrame([(1, 2.0), (3, None)], "a int, b double")
    out = C.impute_median(df, ["a", "b"])
    assert dict(out.dtypes)["a"] == "int"  # untouched
    assert out.where("b is null").count() == 0


def test_parse_time_bad_text_is_null(spark):
    df = spark.createDataFrame([("2011-01-02 10:00:00",), ("garbage",)], "invoice_date string")
    out = C.to_timestamp_column(df).collect()
    assert out[0][0] == dt.datetime(2011, 1, 2, 10, 0) and out[1][0] is None


def test_calendar_monday_is_zero(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 13, 0),)], "invoice_date timestamp")
    r = C.add_calendar(df).first()
    assert (r["day_of_week"], r["hour"], r["quarter"]) == (0, 13, 1)


def test_standard_scaler_population_std_and_zero_scale(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "a double, c double")
    out = Sc.scale(df, ["a", "c"]).orderBy("a").toPandas()
    assert out["a"].tolist() == pytest.approx([-1.2247448714, 0.0, 1.2247448714])
    assert out["c"].tolist() == [0.0, 0.0, 0.0]


def test_robust_and_minmax(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    rob = sorted(r["x"] for r in Sc.scale(df, ["x"], "robust").collect())
    q1, med, q3 = np.quantile([1, 2, 3, 10], [0.25, 0.5, 0.75])
    assert rob == pytest.approx(sorted((v - med) / (q3 - q1) for v in [1, 2, 3, 10]))
    mm = sorted(r["x"] for r in Sc.scale(df, ["x"], "minmax").collect())
    assert mm == pytest.approx([0.0, 1 / 9, 2 / 9, 1.0])


def test_gap_fill_and_ffill(spark):
    d = dt.date
    df = spark.createDataFrame([("a", d(2024, 1, 1), 1.0), ("a", d(2024, 1, 4), 4.0), ("b", d(2024, 1, 2), 2.0)],
                               "k string, day date, sales double")
    filled = W.gap_fill(df, ["k"]).orderBy("k", "day").collect()
    assert [(r.k, r.day.day, r.sales) for r in filled] == [("a", 1, 1.0), ("a", 2, 0.0), ("a", 3, 0.0),
                                                          ("a", 4, 4.0), ("b", 2, 2.0)]
    ff = W.fill_forward_back(W.gap_fill(df, ["k"], fill=None), ["k"]).orderBy("k", "day").collect()
    assert [r.sales for r in ff] == [1.0, 1.0, 1.0, 4.0, 2.0]


def test_split_and_time_index(spark):
    days = [(dt.date(2024, 1, 1) + dt.timedelta(days=i), float(i)) for i in range(100)]
    df = spark.createDataFrame(days, "day date, sales double")
    out = W.time_index(W.split_by_date(df), ()).toPandas().sort_values("day")
    assert out["t"].tolist() == list(range(100))
    assert (out["split"] == "test").sum() == 31 and (out["split"] == "validation").sum() == 31


def test_histogram_max_in_last_bin_and_constant(spark):
    df = spark.createDataFrame([(float(v),) for v in range(11)], "x double")
    h = {r["bin"]: r["count"] for r in D.histogram(df, "x", 10).collect()}
    assert h[9] == 2 and sum(h.values()) == 11
    const = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert D.histogram(const, "x", 5).collect()[0]["count"] == 2


def test_box_stats_whiskers(spark):
    vals = [1, 2, 3, 4, 5, 6, 7, 8, 100]
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    b = D.box_stats(df, "x").first()
    q1, q3 = np.quantile(vals, [0.25, 0.75])
    assert b["q1"] == q1 and b["q3"] == q3
    assert b["whisker_high"] == 8 and b["n_outliers"] == 1


def test_kde_integrates_to_one(spark):
    rng = np.random.default_rng(0)
    df = spark.createDataFrame([(float(v),) for v in rng.normal(0, 1, 2000)], "x double")
    k = D.kde(df, "x", grid=200).orderBy("point").toPandas()
    area = np.trapezoid(k["density"], k["x"])
    assert 0.95 < area < 1.01


def test_kde_equals_the_sum_over_all_rows(spark):
    """Groups of very different range and bandwidth, far outliers, missing values; a group without spread has none."""
    rng = np.random.default_rng(7)
    groups = {"wide": np.concatenate([rng.normal(0, 1, 900), [4000.0, -250.0]]), "two": np.array([1.0, 2.0]),
              "steps": rng.integers(0, 9, 500).astype(float), "flat": np.full(20, 3.0), "one": np.array([5.0])}
    rows = [(g, float(v)) for g, x in groups.items() for v in x] + [("steps", None), ("none", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    for cut in (0.0, 3.0):
        got = D.kde(df, "x", 50, ["g"], cut).toPandas()
        assert set(got["g"]) == {"wide", "two", "steps"}
        for g, k in got.groupby("g"):
            k, v = k.sort_values("point"), groups[g]
            h = v.std(ddof=1) * len(v) ** -0.2
            x = np.linspace(v.min() - cut * h, v.max() + cut * h, 50)
            want = np.exp(-0.5 * ((x[:, None] - v[None, :]) / h) ** 2).sum(axis=1) / (len(v) * h * np.sqrt(2 * np.pi))
            assert np.allclose(k["x"], x) and np.abs(k["density"] - want).max() * h < 1e-13
    assert D.kde(df.where("x > 1e9"), "x").count() == 0


def test_ecdf_conventions(spark):
    df = spark.createDataFrame([(3.0,), (1.0,), (2.0,), (2.0,)], "x double")
    zero = sorted((r["value"], r["ecdf"]) for r in D.ecdf(df, "x", 0).collect())
    one = sorted((r["value"], r["ecdf"]) for r in D.ecdf(df, "x", 1).collect())
    assert zero == [(1.0, 0.0), (2.0, 0.25), (2.0, 0.5), (3.0, 0.75)]
    assert one == [(1.0, 0.25), (2.0, 0.5), (2.0, 0.75), (3.0, 1.0)]


def test_null_free_metadata_skips_the_check(spark):
    from mercato.sources import sales_lines
    from mercato.sources.tables import NULL_FREE
    from tests.conftest import SF_SMALL
    lines = sales_lines(spark, SF_SMALL)
    assert lines.schema["quantity"].metadata.get(NULL_FREE) is True
    assert C.columns_with_nulls(lines, ["quantity", "unit_price"]) == []
    assert C.columns_with_nulls(lines, ["customer_id"]) == ["customer_id"]


def test_colour_histogram_falls_back_to_the_measured_column(spark):
    df = spark.createDataFrame([(1.0, "a"), (2.0, "b"), (3.0, "a")], "total_spent double, g string")
    by_g = {(r["colour"], r["bin"]): r["count"] for r in D.colour_histogram(df, "total_spent", "g", 3).collect()}
    assert sum(by_g.values()) == 3 and {k[0] for k in by_g} == {"a", "b"}
    fallback = D.colour_histogram(df, "total_spent", "no_such_column", 3).collect()
    assert sorted(float(r["colour"]) for r in fallback) == [1.0, 2.0, 3.0]


def test_stratified_sample_keeps_null_labels_and_rare_ones(spark):
    from mercato.operators.sample import stratified_sample
    rows = [(i, "a") for i in range(70)] + [(i, None) for i in range(70, 99)] + [(99, "rare")]
    df = spark.createDataFrame(rows, "id long, label string")
    got = stratified_sample(df, "label", 10, "id").collect()
    sizes = {lab: sum(r["label"] == lab for r in got) for lab in ("a", None, "rare")}
    assert sizes == {"a": 7, None: 2, "rare": 1}
    assert got[0].asDict().keys() == {"id", "label"}
    assert stratified_sample(df.limit(0), "label", 10, "id").count() == 0


def test_stratified_sample_plan_does_not_grow_with_labels(spark):
    from mercato.operators.sample import stratified_sample
    plans = [stratified_sample(spark.range(500).withColumn("label", F.col("id") % k), "label", 50, "id")
             ._jdf.queryExecution().optimizedPlan().toString() for k in (2, 400)]
    assert abs(len(plans[0]) - len(plans[1])) < 50 and "CASE WHEN" not in plans[1]
