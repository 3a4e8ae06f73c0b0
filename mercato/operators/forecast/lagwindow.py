"""One-step forecast from the previous w days, one model per key.

Re-aims the reference's two-layer LSTM: series min-max scaled with train
statistics (C13), windows of the w previous values built inside each split
(W5), a linear model on the lags fitted on each key's train windows, and the
prediction mapped back to sales units. The network itself is not rebuilt.

The fit is the key's normal equations, (w + 1)² sums from one aggregation over
the windows; the systems of all keys of a batch are solved together and the
prediction is a column expression.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import series as W
from .least_squares import dot, gram_aggs, join_keys, solve
from .panel import prediction_frame

MODEL = "lag_window"


def forecast_lag_window(panel: DataFrame, keys: Sequence[str] = (), y: str = "sales", w: int = 7,
                        reg: float = 0.0) -> DataFrame:
    """Forecast of every validation and test day with a full window before it
    in its own split. ``reg`` is a ridge per train window. Windows with a missing value are left out; a
    key without train windows gets no forecast, one whose windows do not fix
    the coefficients gets the shortest ones."""
    keys = list(keys)
    params = panel.where(F.col("split") == "train").groupBy(*keys).agg(
        F.min(y).cast("double").alias("_lo"), F.max(y).cast("double").alias("_hi"))
    rng = F.when(F.col("_hi") - F.col("_lo") == 0, F.lit(1.0)).otherwise(F.col("_hi") - F.col("_lo"))
    scaled = join_keys(panel, params, keys).withColumn("_range", rng) \
        .withColumn("_s", (F.col(y).cast("double") - F.col("_lo")) / F.col("_range"))
    lags = [f"_lag{i}" for i in range(1, w + 1)]
    data = W.lag_windows(scaled, keys, "day", "_s", w, within=("split",), prefix="_lag") \
        .withColumn("_one", F.lit(1.0)).dropna(subset=lags)
    feats = ["_one", *lags]
    fit = data.where((F.col("split") == "train") & F.col("_s").isNotNull())
    # sums per window, so that a ridge means the same for long and short series
    g = fit.groupBy(*keys).agg(*gram_aggs(feats, "_s"), F.count(F.lit(1)).cast("double").alias("_n")) \
        .where(F.col("_n") > 0)

    def mean(c):
        return F.transform(F.col(c), lambda v: v / F.col("_n"))
    beta = g.select(*keys, solve(reg)(mean("_xtx"), mean("_xty")).alias("_beta"))
    out = join_keys(data.where(F.col("split") != "train"), beta, keys)
    out = out.withColumn("predicted", dot("_beta", feats) * F.col("_range") + F.col("_lo"))
    return prediction_frame(out, MODEL, keys, actual=y)
