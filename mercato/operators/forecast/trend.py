"""Linear trend on the time index (F1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .panel import holdout, prediction_frame, train

MODEL = "linear_regression"


def trend_coefficients(panel: DataFrame, keys: Sequence[str] = (), y: str = "sales", t: str = "t") -> DataFrame:
    """OLS slope and intercept per key on the train split: one aggregation.
    Standard-scaling the index first would not change the predictions."""
    return train(panel).groupBy(*keys).agg(F.regr_slope(y, t).alias("slope"),
                                           F.regr_intercept(y, t).alias("intercept"))


def forecast_trend(panel: DataFrame, keys: Sequence[str] = (), y: str = "sales", t: str = "t") -> DataFrame:
    keys = list(keys)
    coef = trend_coefficients(panel, keys, y, t)
    ho = holdout(panel)
    joined = ho.join(coef, on=keys) if keys else ho.crossJoin(F.broadcast(coef))
    out = joined.withColumn("predicted", F.col("intercept") + F.col("slope") * F.col(t))
    return prediction_frame(out, MODEL, keys)
