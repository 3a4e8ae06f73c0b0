"""Forecasters recover planted structure and keep the prediction contract."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from mercato.operators import series as W
from mercato.operators.forecast import evaluate as Ev
from mercato.operators.forecast.arima import forecast_arima
from mercato.operators.forecast.arima import roll_forward
from mercato.operators.forecast.forest import bootstrap, forecast_forest, grow, predict
from mercato.operators.forecast.lagwindow import forecast_lag_window
from mercato.operators.forecast.least_squares import solve_stack
from mercato.operators.forecast.panel import in_log_space
from mercato.operators.forecast.seasonal import forecast_seasonal
from mercato.operators.forecast.trend import forecast_trend, trend_coefficients


def panel_from(spark, series: dict):
    start = dt.date(2020, 1, 1)
    rows = [(k, start + dt.timedelta(days=i), float(v)) for k, vals in series.items() for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "k string, day date, sales double")
    return W.time_index(W.split_by_date(W.gap_fill(df, ["k"])), ["k"])


def test_trend_exact_line_and_horizon(spark):
    n = 200
    p = panel_from(spark, {"a": [3 + 2 * i for i in range(n)], "b": [100 - i for i in range(n)]})
    pred = forecast_trend(p, ["k"]).toPandas()
    assert len(pred) == 2 * 62
    assert np.allclose(pred["actual"], pred["predicted"])
    m = Ev.mae_rmse(forecast_trend(p, ["k"]), ["k"]).toPandas()
    assert (m["mae"] < 1e-6).all()


def test_trend_residuals_sum_to_zero_on_train(spark):
    rng = np.random.default_rng(0)
    p = panel_from(spark, {"a": list(rng.normal(10, 3, 150))})
    c = trend_coefficients(p, ["k"]).first()
    tr = p.where("split = 'train'").toPandas()
    resid = tr["sales"] - (c["intercept"] + c["slope"] * tr["t"])
    assert abs(resid.sum()) < 1e-6


def test_arima_recovers_ar_dynamics(spark):
    rng = np.random.default_rng(5)
    n = 600
    z = np.zeros(n)
    e = rng.normal(0, 1, n)
    for t in range(2, n):
        z[t] = 0.6 * z[t - 1] - 0.3 * z[t - 2] + e[t]
    y = 50 + np.cumsum(z)  # integrated AR(2): ARIMA(p, 1, q) territory
    p = panel_from(spark, {"x": y})
    pred = forecast_arima(p, ["k"]).toPandas()
    assert len(pred) == 62 and pred["predicted"].notna().all()
    # one-step-ahead of the fitted model beats the naive last-value forecast
    first = pred.sort_values("day").iloc[0]
    train_last = y[n - 63]
    assert abs(first["predicted"] - first["actual"]) < 4 * abs(y[n - 62] - train_last) + 5


def test_arima_of_a_drifting_walk_has_no_constant(spark):
    rng = np.random.default_rng(11)
    y = np.cumsum(0.5 + rng.normal(0, 1, 300))
    pred = forecast_arima(panel_from(spark, {"x": y}), ["k"]).toPandas().sort_values("day")["predicted"].to_numpy()
    # without a constant the differences fade to zero, so the path levels off
    assert abs(pred[-1] - pred[-10]) < 0.5 and np.isfinite(pred).all()


def test_arima_refuses_short_series(spark):
    p = panel_from(spark, {"short": list(range(70)), "long": list(np.sin(np.arange(300) / 5))})
    keys = {r["k"] for r in forecast_arima(p, ["k"]).select("k").distinct().collect()}
    assert keys == {"long"}


def test_seasonal_recovers_weekly_cycle(spark):
    n = 400
    t = np.arange(n)
    y = 100 + 0.05 * t + 10 * np.sin(2 * np.pi * t / 7)
    p = panel_from(spark, {"w": y})
    pred = forecast_seasonal(p, ["k"]).toPandas()
    err = np.abs(pred["predicted"] - pred["actual"]).mean()
    assert err < 1.5


def test_best_model_and_improvement(spark):
    wide = spark.createDataFrame([("arima", 1.0, 2.0, 3.0, 5.0), ("linear_regression", 1.0, 2.0, 3.0, 5.0),
                                  ("seasonal", 1.0, 2.0, 3.0, 6.0)],
                                 "model string, mae_validation double, rmse_validation double, mae_test double, rmse_test double")
    assert Ev.best_model(wide).first()["model"] == "arima"
    j = spark.createDataFrame([("m", 1.0, 10.0), ("z", 2.0, 0.0)], "model string, s double, u double")
    r = j.select("model", Ev.improvement_pct(F.col("u"), F.col("s")).alias("pct")).orderBy("model").collect()
    assert r[0]["pct"] == pytest.approx(90.0) and r[1]["pct"] == 0.0


# -- forest ------------------------------------------------------------------
def brute_tree(days, y, w, max_depth, depth=0):
    """Leaves (first day, last day, mean) of one tree by trying every cut."""
    mean = np.average(y, weights=w)
    if len(set(y)) == 1 or depth == max_depth:
        return [(days[0], days[-1], mean)]
    def error(a):
        return np.sum(w[a] * (y[a] - np.average(y[a], weights=w[a])) ** 2)
    errors = [error(slice(0, i)) + error(slice(i, None)) for i in range(1, len(y))]
    i = 1 + int(np.flatnonzero(np.isclose(errors, min(errors), rtol=1e-12, atol=1e-12))[0])
    return brute_tree(days[:i], y[:i], w[:i], max_depth, depth + 1) \
        + brute_tree(days[i:], y[i:], w[i:], max_depth, depth + 1)


@pytest.mark.parametrize("max_depth", [0, 1, 3, None])
def test_forest_grows_the_trees_of_an_exhaustive_search(max_depth):
    rng = np.random.default_rng(3)
    y = np.round(rng.normal(0, 10, 60)) + np.repeat([0, 40, -20], 20)
    counts = bootstrap(len(y), 8, 42, ("a",))
    assert (counts.sum(axis=1) == len(y)).all()
    tree, first, last, mean = grow(y, counts, max_depth)
    for b in range(8):
        days = np.flatnonzero(counts[b])
        want = brute_tree(days, y[days], counts[b][days].astype(float), max_depth)
        got = [(f, l, m) for k, f, l, m in zip(tree, first, last, mean) if k == b]
        assert [g[:2] for g in got] == [x[:2] for x in want]
        assert np.allclose([g[2] for g in got], [x[2] for x in want])


def test_full_depth_forest_is_the_nearest_drawn_day():
    rng = np.random.default_rng(4)
    y, t = rng.normal(size=200), np.arange(200.0)
    counts = bootstrap(200, 20, 1, ())
    at = np.arange(0, 220.0)
    got = predict(grow(y, counts), t, at, 20)
    want = np.zeros(len(at))
    for c in counts:
        days = np.flatnonzero(c)
        want += y[days[np.argmin(np.abs(at[:, None] - days[None, :]), axis=1)]] / 20  # ties to the earlier day
    assert np.allclose(got, want)


def test_forest_of_constant_and_single_day_series():
    for y in (np.full(30, 7.0), np.array([7.0])):
        leaves = grow(y, bootstrap(len(y), 5, 42, ("k",)))
        assert len(leaves[0]) == 5 and np.allclose(predict(leaves, np.arange(float(len(y))), np.array([0.0, 99.0]), 5), 7)


def test_forest_per_key_does_not_depend_on_other_keys(spark):
    rng = np.random.default_rng(8)
    a, b = list(rng.normal(100, 5, 150)), list(rng.normal(-3, 1, 130))
    both = forecast_forest(panel_from(spark, {"a": a, "b": b}), ["k"]).where("k = 'a'").toPandas().sort_values("day")
    # the split follows the latest day of all keys, which is that of a
    alone = forecast_forest(panel_from(spark, {"a": a}), ["k"]).toPandas().sort_values("day")
    assert len(alone) == 62 and list(both["predicted"]) == list(alone["predicted"])
    assert alone["predicted"].nunique() == 1  # no cut lies beyond the train days


# -- least squares in stacks --------------------------------------------------
def test_stacked_solutions_equal_single_ones_singular_included():
    rng = np.random.default_rng(2)
    xs = [rng.normal(size=(40, 5)) for _ in range(30)]
    xs[7][:, 3] = xs[7][:, 2]  # two equal columns: the shortest solution
    ys = [rng.normal(size=40) for _ in xs]
    i, j = np.triu_indices(5)
    got = solve_stack(np.stack([(x.T @ x)[i, j] for x in xs]), np.stack([x.T @ y for x, y in zip(xs, ys)]))
    assert np.allclose(got, [np.linalg.lstsq(x, y, rcond=None)[0] for x, y in zip(xs, ys)], atol=1e-8)


@pytest.mark.parametrize("p,q,d", [(3, 1, 1), (2, 0, 0), (0, 2, 1), (1, 2, 0)])
def test_paths_rolled_forward_together_equal_a_loop(p, q, d):
    rng = np.random.default_rng(9)
    n, steps = 6, 12
    coef, z, e = rng.normal(size=(n, (0 if d else 1) + p + q)) / 4, rng.normal(size=(n, 3)), rng.normal(size=(n, 2))
    level = rng.normal(size=n)
    got = roll_forward(coef, z, e, level, steps, p, q, d)
    for k in range(n):
        c = coef[k] if not d else np.concatenate([[0.0], coef[k]])
        zs, es, lv = list(z[k]), list(e[k]), level[k]
        for h in range(steps):
            v = c[0] + sum(c[1 + i] * zs[i] for i in range(p)) + sum(c[1 + p + i] * es[i] for i in range(q))
            zs.insert(0, v)
            es.insert(0, 0.0)
            lv = lv + v if d else v
            assert got[k, h] == pytest.approx(lv)


def test_lag_window_fits_every_key_by_itself(spark):
    rng = np.random.default_rng(6)
    n, series, rules = 260, {}, {"up": 0.9, "down": -0.7, "weak": 0.2}
    for k, phi in rules.items():
        v = np.zeros(n)
        for i in range(1, n):
            v[i] = phi * v[i - 1] + rng.normal()
        series[k] = v
    pred = forecast_lag_window(panel_from(spark, series), ["k"]).toPandas()
    for k, v in series.items():
        mine = pred[pred["k"] == k].sort_values("day")
        tr = v[:n - 62]
        x = np.column_stack([np.ones(len(tr) - 7), *[tr[7 - i:len(tr) - i] for i in range(1, 8)]])
        beta = np.linalg.lstsq(x, tr[7:], rcond=None)[0]
        assert abs(beta[1] - rules[k]) < 0.2  # the planted slope
        want = [np.concatenate([[1.0], v[i - 1:i - 8:-1]]) @ beta
                for s in (n - 62, n - 31) for i in range(s + 7, s + 31)]
        assert np.allclose(mine["predicted"], want)


def test_panel_of_500_keys(spark):
    """Every model forecasts all keys; two keys with equal series agree in the models without draws."""
    rng = np.random.default_rng(1)
    base = rng.normal(50, 9, 120)
    p = panel_from(spark, {f"k{i:03d}": base if i < 2 else np.roll(base, i) for i in range(500)}).cache()
    for f in (forecast_arima, forecast_trend, forecast_forest, forecast_lag_window):
        got = f(p, ["k"]).toPandas()
        assert got["k"].nunique() == 500 and got["predicted"].notna().all(), f.__name__
        if f is not forecast_forest:
            one, two = (got[got["k"] == k].sort_values("day")["predicted"].to_numpy() for k in ("k000", "k001"))
            assert np.allclose(one, two), f.__name__
    p.unpersist()


def test_log_target_recovers_growth_and_skips_days_without_a_logarithm(spark):
    n = 200
    y = np.expm1(1 + 0.02 * np.arange(n))
    p = panel_from(spark, {"g": y})
    got = in_log_space(forecast_trend, p, ["k"]).toPandas()
    assert np.allclose(got["predicted"], got["actual"]) and np.allclose(sorted(got["actual"]), y[n - 62:])
    y = y.copy()
    y[[20, 40, n - 40, n - 3]] = [-5.0, -1.0, -2.0, -700.0]
    q = panel_from(spark, {"g": y})
    for f in (forecast_trend, forecast_arima, forecast_forest, forecast_seasonal):
        got = in_log_space(f, q, ["k"]).toPandas()
        assert len(got) == 62 and got["actual"].isna().sum() == 2 and got["predicted"].notna().all(), f.__name__
        assert Ev.mae_rmse(in_log_space(f, q, ["k"])).where("mae IS NULL OR isnan(mae)").count() == 0
    lagged = in_log_space(forecast_lag_window, q, ["k"]).toPandas()
    assert lagged["predicted"].notna().all() and 0 < len(lagged) < 48
