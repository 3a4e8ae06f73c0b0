"""Exact quantiles and running totals against numpy on small fixtures."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from mercato.operators.rank import exact_quantiles, row_positions, running_total


def _q(spark, values, probs, by=None):
    rows = [(None if v is None else float(v), (by[i] if by else 0)) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "x double, g int")
    out = exact_quantiles(df, ["x"], probs, by=["g"]).collect()
    return {(r["g"], r["prob"]): r["value"] for r in out}


@pytest.mark.parametrize("values", [[1, 2, 3, 10], [5.0], [2, 2, 2, 2, 9], list(range(100)), [3, 1, 2, None]])
def test_matches_numpy_linear(spark, values):
    probs = [0.0, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = _q(spark, values, probs)
    clean = np.array([v for v in values if v is not None], dtype=float)
    for p in probs:
        assert got[(0, p)] == pytest.approx(np.quantile(clean, p))


def test_grouped_with_hot_value(spark):
    # one value holds a third of the rows of group 0
    vals = [7.0] * 300 + list(np.linspace(0, 100, 600)) + list(range(50))
    grp = [0] * 900 + [1] * 50
    got = _q(spark, vals, [0.5, 0.9], by=grp)
    g0 = np.array(vals[:900])
    g1 = np.array(vals[900:], dtype=float)
    assert got[(0, 0.5)] == pytest.approx(np.quantile(g0, 0.5))
    assert got[(0, 0.9)] == pytest.approx(np.quantile(g0, 0.9))
    assert got[(1, 0.5)] == pytest.approx(np.quantile(g1, 0.5))


def test_all_null_column_gives_no_row(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert exact_quantiles(df, ["x"], [0.5]).count() == 0


def test_positions_are_a_permutation(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).cast("double").alias("v"))
    pos = row_positions(df, ["v"]).select("pos", "n").toPandas()
    assert sorted(pos["pos"]) == list(range(5000))
    assert set(pos["n"]) == {5000}


def test_running_total_by_group(spark):
    rows = [(g, float(v), 1) for g in range(3) for v in range(200)]
    df = spark.createDataFrame(rows, "g int, v double, w int")
    out = running_total(df, "w", ["v"], by=["g"]).toPandas()
    for g in range(3):
        part = out[out.g == g].sort_values("v")
        assert list(part.cum_before) == list(range(200))


def test_approx_option_is_close(spark):
    vals = list(np.linspace(0, 1000, 5001))
    df = spark.createDataFrame([(float(v), 0) for v in vals], "x double, g int")
    out = {r["prob"]: r["value"] for r in exact_quantiles(df, ["x"], [0.1, 0.5, 0.9], approx=True).collect()}
    for p in (0.1, 0.5, 0.9):
        assert abs(out[p] - np.quantile(vals, p)) <= 1000 / 1000


def test_brackets_of_large_groups_hold_their_quantiles(spark, monkeypatch):
    """Far more rows than the sketch holds, ties, skew, a NULL group, several columns; also without the one-window path."""
    from mercato.operators import rank
    rng = np.random.default_rng(4)
    n = 60_000
    cols = {"even": rng.uniform(size=n), "skew": rng.pareto(1.1, n), "ties": rng.integers(0, 6, n).astype(float),
            "hot": np.where(rng.uniform(size=n) < 0.4, 3.0, rng.normal(size=n))}
    group = [None if i % 3 == 0 else i % 3 for i in range(n)]
    df = spark.createDataFrame([(*map(float, r), g) for r, g in zip(zip(*cols.values()), group)],
                               ", ".join(f"{c} double" for c in cols) + ", g int")
    probs = [0.0, 0.01, 0.25, 0.5, 0.99, 1.0]
    for window_rows in (1_000_000, 10):
        monkeypatch.setattr(rank, "WINDOW_ROWS", window_rows)
        got = {(r["g"], r["column"], r["prob"]): r["value"] for r in
               exact_quantiles(df, list(cols), probs, by=["g"]).collect()}
        assert len(got) == 3 * 4 * 6
        for (g, c, p), v in got.items():
            own = cols[c][[i for i in range(n) if group[i] == g]]
            assert v == pytest.approx(np.quantile(own, p), rel=1e-12, abs=1e-12)


def test_only_the_bracket_is_shuffled(spark):
    df = spark.range(200_000).select((F.col("id") * 7919 % 200_000).cast("double").alias("v"))
    counts = exact_quantiles(df, ["v"], [0.5])
    assert counts.first()["value"] == 99_999.5


def test_ecdf_deals_a_hot_value_over_many_tasks(spark):
    """A value that all rows hold is written by many tasks, none of which has more than its share of the chunks."""
    from mercato.operators.dist import ecdf
    df = spark.range(20_000).select(F.lit(5.0).alias("v"))
    out = ecdf(df, "v", base=1, chunk=100)
    per_task = out.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in per_task) == 20_000
    got = sorted(r["ecdf"] for r in out.collect())
    assert got == pytest.approx([(i + 1) / 20_000 for i in range(20_000)])
    rows = spark.createDataFrame([(3.0,), (None,), (1.0,), (3.0,)], "v double")
    assert sorted(map(tuple, ecdf(rows, "v").collect())) == [(1.0, 0.0), (3.0, 1 / 3), (3.0, 2 / 3)]
