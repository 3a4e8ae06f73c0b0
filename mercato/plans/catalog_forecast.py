"""Catalog: forecasting.

The trend model is ordinary least squares, so its predictions, scores and
the comparison tables built on them have SQL twins. The other models are
optimiser-dependent and are checked by invariants and recovery tests.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import scale as Sc
from ..operators.forecast import evaluate as Ev
from ..operators.forecast.arima import forecast_arima
from ..operators.forecast.forest import forecast_forest
from ..operators.forecast.lagwindow import forecast_lag_window
from ..operators.forecast.panel import build_panel, in_log_space
from ..operators.forecast.seasonal import forecast_seasonal
from ..operators.forecast.trend import forecast_trend
from ..sources import SALES_LINES_SQL
from . import views as V
from .registry import register

K = ["country"]


def _panel(spark, sf_dir, keys=K):
    return build_panel(V.lines(spark, sf_dir), keys)


TREND_SQL = """,
coef AS (SELECT {k}regr_slope(sales, t) AS slope, regr_intercept(sales, t) AS intercept
         FROM {p} WHERE split = 'train' {g}),
pred_{p} AS (SELECT 'linear_regression' AS model, {pk}p.day, p.split, p.sales AS actual,
               c.intercept + c.slope * p.t AS predicted
        FROM {p} p {j} WHERE p.split <> 'train')"""


def trend_sql(keys=K, p="panel"):
    k = ", ".join(keys)
    return TREND_SQL.format(k=(k + ", ") if keys else "", g=f"GROUP BY {k}" if keys else "",
                            pk="".join(f"p.{c}, " for c in keys), p=p,
                            j=f"JOIN coef c USING ({k})" if keys else ", coef c")


@register("f1_trend_predictions", "F1, F8, W4, W7", V.sql(trend_sql() + """
SELECT model, country, day, split, actual, round(predicted, 2) AS predicted FROM pred_panel""",
                                                        SALES_LINES_SQL, V.panel_sql(K)))
def f1_trend_predictions(spark, sf_dir):
    p = forecast_trend(_panel(spark, sf_dir), K)
    return p.withColumn("predicted", F.round("predicted", 2))


@register("f7_trend_metrics", "F7", V.sql(trend_sql() + """
SELECT model, country, split, round(avg(abs(actual - predicted)), 4) AS mae,
       round(sqrt(avg((actual - predicted) * (actual - predicted))), 4) AS rmse, count(*) AS n
FROM pred_panel GROUP BY 1, 2, 3""", SALES_LINES_SQL, V.panel_sql(K)))
def f7_trend_metrics(spark, sf_dir):
    m = Ev.mae_rmse(forecast_trend(_panel(spark, sf_dir), K), K)
    return m.select("model", "country", "split", F.round("mae", 4).alias("mae"), F.round("rmse", 4).alias("rmse"), "n")


@register("f13_predicted_vs_actual", "F13", V.sql(trend_sql() + """
SELECT model, split, round(regr_slope(predicted, actual), 6) AS slope,
       round(regr_intercept(predicted, actual), 2) AS intercept, round(regr_r2(predicted, actual), 6) AS r2,
       count(*) AS n
FROM pred_panel GROUP BY 1, 2""", SALES_LINES_SQL, V.panel_sql(K)))
def f13_predicted_vs_actual(spark, sf_dir):
    r = Ev.predicted_vs_actual(forecast_trend(_panel(spark, sf_dir), K))
    return r.select("model", "split", F.round("slope", 6).alias("slope"), F.round("intercept", 2).alias("intercept"),
                    F.round("r2", 6).alias("r2"), "n")


# -- scaled against unscaled input (F15, J2, F11, F12) ---------------------------
def _scaled_lines(spark, sf_dir):
    lines = V.lines(spark, sf_dir).withColumn("sales", F.col("sales").cast("double"))
    return Sc.scale(lines, ["quantity", "unit_price", "sales"], "standard")


SCALED_LINES_SQL = """
scaled_lines AS (SELECT invoice_date, (CAST(sales AS DOUBLE) - avg(CAST(sales AS DOUBLE)) OVER ())
                   / COALESCE(NULLIF(stddev_pop(CAST(sales AS DOUBLE)) OVER (), 0), 1) AS sales FROM sales_lines)"""


@register("f15_scaled_series", "F15, C11, A1, W1", V.sql(
    "SELECT day, round(sales, 6) AS sales, split FROM zpanel",
    SALES_LINES_SQL, SCALED_LINES_SQL, V.panel_sql((), src="scaled_lines", value="sum(sales)", out="zpanel")))
def f15_scaled_series(spark, sf_dir):
    p = build_panel(_scaled_lines(spark, sf_dir), ())
    return p.select("day", F.round("sales", 6).alias("sales"), "split")


def _wide_trend(panel_df):
    return Ev.metrics_wide(Ev.mae_rmse(forecast_trend(panel_df, ())))


_COMPARE_SQL = (SALES_LINES_SQL, SCALED_LINES_SQL, V.panel_sql(()),
                V.panel_sql((), src="scaled_lines", value="sum(sales)", out="zpanel"))
_WIDE = """
{p}_w AS (SELECT model,
  avg(abs(actual - predicted)) FILTER (WHERE split = 'test') AS mae_test,
  sqrt(avg((actual - predicted) * (actual - predicted)) FILTER (WHERE split = 'test')) AS rmse_test
  FROM pred_{p} GROUP BY model)"""


def _compare_body():
    a = trend_sql((), "panel").replace("coef", "coef_u")
    b = trend_sql((), "zpanel").replace("coef", "coef_s")
    return a + b + "," + _WIDE.format(p="panel") + "," + _WIDE.format(p="zpanel") + """,
j AS (SELECT COALESCE(s.model, u.model) AS model, s.mae_test AS mae_test_scaled, s.rmse_test AS rmse_test_scaled,
             u.mae_test AS mae_test_unscaled, u.rmse_test AS rmse_test_unscaled
      FROM zpanel_w s FULL OUTER JOIN panel_w u ON s.model = u.model)"""


@register("f11_scaled_vs_unscaled", "F11, J2", V.sql(_compare_body() + """
SELECT model, round(mae_test_scaled, 6) AS mae_test_scaled, round(rmse_test_scaled, 6) AS rmse_test_scaled,
       round(mae_test_unscaled, 2) AS mae_test_unscaled, round(rmse_test_unscaled, 2) AS rmse_test_unscaled FROM j""",
                                                      *_COMPARE_SQL))
def f11_scaled_vs_unscaled(spark, sf_dir):
    j = _f11_join(spark, sf_dir)
    return j.select("model", F.round("mae_test_scaled", 6).alias("mae_test_scaled"),
                    F.round("rmse_test_scaled", 6).alias("rmse_test_scaled"),
                    F.round("mae_test_unscaled", 2).alias("mae_test_unscaled"),
                    F.round("rmse_test_unscaled", 2).alias("rmse_test_unscaled"))


def _f11_join(spark, sf_dir):
    cols = ["model", "mae_test", "rmse_test"]
    scaled = _wide_trend(build_panel(_scaled_lines(spark, sf_dir), ())).select(*cols)
    unscaled = _wide_trend(_panel(spark, sf_dir, ())).select(*cols)
    return Ev.scaled_vs_unscaled(scaled, unscaled)


@register("f12_improvement_pct", "F12", V.sql(_compare_body() + """
SELECT model,
  round(CASE WHEN mae_test_unscaled IS NULL OR mae_test_scaled IS NULL THEN NULL WHEN mae_test_unscaled = 0 THEN 0
        ELSE (mae_test_unscaled - mae_test_scaled) / mae_test_unscaled * 100 END, 6) AS mae_test_improvement_pct,
  round(CASE WHEN rmse_test_unscaled IS NULL OR rmse_test_scaled IS NULL THEN NULL WHEN rmse_test_unscaled = 0 THEN 0
        ELSE (rmse_test_unscaled - rmse_test_scaled) / rmse_test_unscaled * 100 END, 6) AS rmse_test_improvement_pct
FROM j""", *_COMPARE_SQL))
def f12_improvement_pct(spark, sf_dir):
    t = Ev.improvement_table(_f11_join(spark, sf_dir))
    return t.select("model", *[F.round(c, 6).alias(c) for c in t.columns if c != "model"])


# -- optimiser-dependent models (invariant checks) --------------------------------
@register("f3_arima_predictions", "F3, W2")
def f3_arima_predictions(spark, sf_dir):
    return forecast_arima(_panel(spark, sf_dir), K)


@register("f2_forest_predictions", "F2")
def f2_forest_predictions(spark, sf_dir):
    return forecast_forest(_panel(spark, sf_dir), K)


@register("f4_seasonal_predictions", "F4, F6")
def f4_seasonal_predictions(spark, sf_dir):
    return forecast_seasonal(_panel(spark, sf_dir), K)


@register("f5_lag_window_predictions", "F5, W5, C13")
def f5_lag_window_predictions(spark, sf_dir):
    return forecast_lag_window(_panel(spark, sf_dir), K)


#: The five models in the order in which the reference fits and lists them (``evaluate.MODEL_ORDER``).
FORECASTERS = (forecast_arima, forecast_trend, forecast_forest, forecast_seasonal, forecast_lag_window)


def fit_all(panel_df, keys=K, use_log=False):
    """All five models on one panel (F10), which ``build_panel`` has written already: their predictions, stacked (F8).
    ``use_log`` fits them to log1p of the target and maps the predictions back (C9, C10)."""
    parts = [in_log_space(f, panel_df, keys) if use_log else f(panel_df, keys) for f in FORECASTERS]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("f10_model_metrics", "F10, F7, F8")
def f10_model_metrics(spark, sf_dir):
    """Every model is scored on all of its own days, as in f9 and f14."""
    return Ev.metrics_wide(Ev.mae_rmse(fit_all(_panel(spark, sf_dir, ()), ())))


@register("f9_best_model", "F9, F14")
def f9_best_model(spark, sf_dir):
    wide = Ev.metrics_wide(Ev.mae_rmse(fit_all(_panel(spark, sf_dir, ()), ())))
    return Ev.best_model(wide).select("model", "mae_test", "rmse_test")


@register("f14_model_radar", "F14")
def f14_model_radar(spark, sf_dir):
    return Ev.model_radar(Ev.metrics_wide(Ev.mae_rmse(fit_all(_panel(spark, sf_dir, ()), ()))))


# -- all five models -------------------------------------------------------------
@register("f8_predictions", "F8, F10")
def f8_predictions(spark, sf_dir):
    """The stacked predictions of all models, every country by itself."""
    return fit_all(_panel(spark, sf_dir), K)


def _five_models(spark, sf_dir):
    """Scores of the five models on the scaled and on the unscaled series, side by side."""
    def wide(panel_df):
        return Ev.metrics_wide(Ev.mae_rmse(fit_all(panel_df, ())))
    return Ev.scaled_vs_unscaled(wide(build_panel(_scaled_lines(spark, sf_dir), ())), wide(_panel(spark, sf_dir, ())))


@register("f11_models_scaled_vs_unscaled", "F11, J2, F15")
def f11_models_scaled_vs_unscaled(spark, sf_dir):
    return _five_models(spark, sf_dir)


@register("f12_models_improvement_pct", "F12")
def f12_models_improvement_pct(spark, sf_dir):
    return Ev.improvement_table(_five_models(spark, sf_dir),
                                ("mae_validation", "rmse_validation", "mae_test", "rmse_test"))


@register("f13_models_predicted_vs_actual", "F13")
def f13_models_predicted_vs_actual(spark, sf_dir):
    return Ev.predicted_vs_actual(fit_all(_panel(spark, sf_dir), K))


# -- models of the logarithm (C9, C10) ---------------------------------------------
_LOG_PANEL = """
log_panel AS (SELECT country, day, split, t, CASE WHEN sales > -1 THEN ln(1 + sales) END AS sales FROM panel)"""


@register("f1_trend_log_predictions", "F1, C9, C10", V.sql(trend_sql(p="log_panel") + """
SELECT model, country, day, split, round(exp(actual) - 1, 2) AS actual, round(exp(predicted) - 1, 2) AS predicted
FROM pred_log_panel""", SALES_LINES_SQL, V.panel_sql(K), _LOG_PANEL))
def f1_trend_log_predictions(spark, sf_dir):
    p = in_log_space(forecast_trend, _panel(spark, sf_dir), K)
    return p.withColumns({c: F.round(c, 2) for c in ("actual", "predicted")})


@register("f10_model_metrics_log", "F10, C9, C10, F7")
def f10_model_metrics_log(spark, sf_dir):
    """Scores of the five models when fitted to the logarithm, in sales units."""
    return Ev.metrics_wide(Ev.mae_rmse(fit_all(_panel(spark, sf_dir), K, use_log=True)))
