"""ARIMA(p, d, q) per series key by the Hannan-Rissanen two-stage method.

1. difference the train series d times and take its lags (one window per key),
2. fit a long AR(m) by least squares; its residuals estimate the shocks,
3. regress the differenced value on p own lags and q lagged shocks.

Both least-squares fits are one ``groupBy(keys)`` of sums of products each, whose small systems are solved a batch of
keys at a time. The aggregation of stage 3 also picks the state that the forecast starts from, which is the key's last
row; the paths of a batch of keys are rolled forward together, one array step per day.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from ..series import fill_forward_back
from .least_squares import dot, gram_aggs, join_keys, solve
from .panel import holdout, prediction_frame, train

MODEL = "arima"


def roll_forward(coef: np.ndarray, z: np.ndarray, e: np.ndarray, level: np.ndarray, steps: int, p: int, q: int,
                 d: int) -> np.ndarray:
    """Paths, keys x steps. ``coef`` holds the constant (``d = 0`` only), p
    weights of the values and q of the shocks; ``z`` and ``e`` hold the last
    values and shocks, most recent first. Coming shocks are zero."""
    const = np.zeros(len(coef)) if d else coef[:, 0]
    ar = coef[:, 0 if d else 1:][:, :p]
    ma = coef[:, (0 if d else 1) + p:]
    z, e, out = z[:, :p].copy(), e[:, :q].copy(), np.empty((len(coef), steps))
    for h in range(steps):
        nxt = const + (ar * z).sum(axis=1) + (ma * e).sum(axis=1)
        z = np.column_stack([nxt, z[:, :-1]]) if p else z
        e = np.column_stack([np.zeros(len(e)), e[:, :-1]]) if q else e
        level = level + nxt if d else nxt
        out[:, h] = level
    return out


def forecast_arima(panel: DataFrame, keys: Sequence[str] = (), p: int = 3, d: int = 1, q: int = 1,
                   long_ar: int = 10, min_points: int = 30, y: str = "sales", t: str = "t") -> DataFrame:
    """Forecast every validation and test day of each key from the end of its
    train split (one multi-step path, so the test month is scored at its true
    horizon). Keys with fewer than ``min_points`` train days get no forecast.

    The train series is forward/backward filled before fitting, as the
    reference does for daily frequency gaps."""
    if d not in (0, 1):
        raise ValueError("d must be 0 or 1")
    if max(p, q) > long_ar:
        raise ValueError("long_ar must not be smaller than p and q")
    keys = list(keys)
    spec = Window.partitionBy(*keys).orderBy(t)
    is_train = F.col("split") == "train"
    spans = panel.groupBy(*keys).agg(F.count(F.when(is_train, 1)).alias("_len"),
                                     F.max(F.when(is_train, F.col(t))).alias("_t_end"), F.max(t).alias("_t_max"))
    spans = spans.where(F.col("_len") >= min_points).select(
        *keys, "_t_end", (F.col("_t_max") - F.col("_t_end")).cast("int").alias("_steps"))
    # forward then backward fill of the train series (W2); a no-op on a
    # zero-filled panel, it matters for panels built without gap filling
    x = fill_forward_back(train(panel).select(*keys, "day", t, y), keys, "day", y) \
        .select(*keys, t, F.col(y).cast("double").alias("_y"))
    x = x.withColumn("_z", F.col("_y") - F.lag("_y", 1).over(spec) if d else F.col("_y"))
    x = x.withColumns({f"_l{i}": F.lag("_z", i).over(spec) for i in range(1, long_ar + 1)}) \
        .withColumn("_one", F.lit(1.0))

    # Stage 1: long AR → shock estimates.
    const = [] if d else ["_one"]  # a constant in the differences would be a drift of the levels
    long_lags = [*const, *[f"_l{i}" for i in range(1, long_ar + 1)]]
    s1 = x.where(F.col(f"_l{long_ar}").isNotNull())
    b1 = s1.groupBy(*keys).agg(*gram_aggs(long_lags, "_z"), F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 0)
    b1 = join_keys(b1.select(*keys, solve()("_xtx", "_xty").alias("_beta")), spans, keys)
    e = join_keys(s1, b1, keys).withColumn("_e", F.col("_z") - dot("_beta", long_lags)).drop("_beta")
    e = e.withColumns({f"_e{j}": F.lag("_e", j).over(spec) for j in range(1, q + 1)})

    # Stage 2: ARMA regression, and the last row's values, shocks and level.
    feats = [*const, *[f"_l{i}" for i in range(1, p + 1)], *[f"_e{j}" for j in range(1, q + 1)]]
    s2 = e.where(F.col(f"_e{q}").isNotNull()) if q else e
    recent = F.struct(F.array("_z", *[f"_l{i}" for i in range(1, max(p, 1))]).alias("z"),
                      F.array("_e", *[f"_e{j}" for j in range(1, max(q, 1))]).alias("e"), F.col("_y").alias("level"))
    state = s2.groupBy(*keys).agg(*gram_aggs(feats, "_z"), F.max_by(recent, F.col(t)).alias("_last"),
                                  F.max("_t_end").alias("_t_end"), F.max("_steps").alias("_steps"))
    state = state.where(F.col("_steps") > 0).withColumn("_coef", solve()("_xtx", "_xty"))

    @F.pandas_udf(ArrayType(DoubleType()))
    def path(coef: pd.Series, z: pd.Series, shocks: pd.Series, level: pd.Series, steps: pd.Series) -> pd.Series:
        if len(coef) == 0:
            return pd.Series([], dtype=object)
        paths = roll_forward(np.stack(coef.to_numpy()), np.stack(z.to_numpy()), np.stack(shocks.to_numpy()),
                             level.to_numpy(dtype=float), int(steps.max()), p, q, d)
        return pd.Series([row[:n] for row, n in zip(paths, steps)])

    fc = state.select(*keys, "_t_end", F.posexplode(path("_coef", "_last.z", "_last.e", "_last.level", "_steps"))
                      .alias("_h", "predicted"))
    fc = fc.withColumn(t, F.col("_t_end") + F.col("_h") + 1).drop("_t_end", "_h")
    return prediction_frame(holdout(panel).join(fc, on=[*keys, t]), MODEL, keys)
