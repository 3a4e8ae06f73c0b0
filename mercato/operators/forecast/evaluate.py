"""Scoring and comparison of forecasts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: order in which models are fitted and listed; it also breaks
# ties when choosing the best model.
MODEL_ORDER = ("arima", "linear_regression", "random_forest", "seasonal", "lag_window")


def mae_rmse(preds: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """MAE and RMSE per model and split."""
    e = F.col("actual") - F.col("predicted")
    return preds.groupBy("model", *keys, "split").agg(
        F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"), F.count(F.lit(1)).alias("n"))


def metrics_wide(metrics: DataFrame) -> DataFrame:
    """One row per model: mae/rmse for validation and test."""
    return metrics.groupBy("model").agg(
        F.max(F.when(F.col("split") == "validation", F.col("mae"))).alias("mae_validation"),
        F.max(F.when(F.col("split") == "validation", F.col("rmse"))).alias("rmse_validation"),
        F.max(F.when(F.col("split") == "test", F.col("mae"))).alias("mae_test"),
        F.max(F.when(F.col("split") == "test", F.col("rmse"))).alias("rmse_test"))


def _order(c: str = "model"):
    return F.coalesce(F.array_position(F.array(*[F.lit(m) for m in MODEL_ORDER]), F.col(c)), F.lit(999))


def best_model(wide: DataFrame) -> DataFrame:
    """Lowest test RMSE; ties go to the earlier model in ``MODEL_ORDER``."""
    return wide.where(F.col("rmse_test").isNotNull()).orderBy(F.asc("rmse_test"), _order()).limit(1)


def scaled_vs_unscaled(scaled: DataFrame, unscaled: DataFrame) -> DataFrame:
    """Full outer join of two wide metric tables by model."""
    cols = [c for c in scaled.columns if c != "model"]
    a = scaled.select("model", *[F.col(c).alias(f"{c}_scaled") for c in cols])
    b = unscaled.select("model", *[F.col(c).alias(f"{c}_unscaled") for c in cols])
    return a.join(b, on="model", how="full_outer")


def improvement_pct(base, new):
    """(base − new) / base × 100; 0 when the base is 0; NULL when either is
    missing (F12)."""
    return F.when(base.isNull() | new.isNull(), F.lit(None).cast("double")) \
        .when(base == 0, F.lit(0.0)).otherwise(F.try_divide(base - new, base) * 100)


def improvement_table(joined: DataFrame, metrics: Sequence[str] = ("mae_test", "rmse_test")) -> DataFrame:
    return joined.select("model", *[improvement_pct(F.col(f"{m}_unscaled"), F.col(f"{m}_scaled"))
                                    .alias(f"{m}_improvement_pct") for m in metrics])


def predicted_vs_actual(preds: DataFrame) -> DataFrame:
    """OLS line of predicted on actual, and R², per model and split."""
    return preds.groupBy("model", "split").agg(
        F.regr_slope("predicted", "actual").alias("slope"), F.regr_intercept("predicted", "actual").alias("intercept"),
        F.regr_r2("predicted", "actual").alias("r2"), F.count(F.lit(1)).alias("n"))


def model_radar(wide: DataFrame, expected: Sequence[str] = MODEL_ORDER) -> DataFrame:
    """Test MAE and RMSE per model, only when every expected model is
    present (F14)."""
    present = wide.where(F.col("mae_test").isNotNull() & F.col("rmse_test").isNotNull())
    n = present.agg(F.countDistinct("model").alias("_n"))
    return present.crossJoin(F.broadcast(n)).where(F.col("_n") == len(expected)) \
        .select("model", "mae_test", "rmse_test")
