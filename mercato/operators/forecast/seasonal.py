"""Piecewise-linear trend with weekly and yearly seasonality.

Re-aims the reference's additive Prophet model: hinge changepoints on the
first 80 % of the train range, Fourier terms for the week (order 3) and the
year (order 10), fitted by ridge least squares per series key. Each key's
daily train series is a group of at most the calendar span (it does not
grow with the number of lines), solved in numpy inside ``applyInPandas``.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .panel import per_key, prediction_frame

MODEL = "seasonal"


def _design(t: np.ndarray, t_max: float, changepoints: np.ndarray, weekly: int, yearly: int) -> np.ndarray:
    scale = max(t_max, 1.0)
    cols = [np.ones_like(t), t / scale]
    cols += [np.maximum(0.0, t - c) / scale for c in changepoints]
    for k in range(1, weekly + 1):
        cols += [np.sin(2 * np.pi * k * t / 7.0), np.cos(2 * np.pi * k * t / 7.0)]
    for k in range(1, yearly + 1):
        cols += [np.sin(2 * np.pi * k * t / 365.25), np.cos(2 * np.pi * k * t / 365.25)]
    return np.column_stack(cols)


def forecast_seasonal(panel: DataFrame, keys: Sequence[str] = (), y: str = "sales", t: str = "t",
                      n_changepoints: int = 25, changepoint_range: float = 0.8, weekly: int = 3,
                      yearly: int = 10, ridge: float = 1.0, yearly_mode: str = "auto") -> DataFrame:
    """``yearly_mode='auto'`` fits the yearly terms only when a key's train
    span covers two years (shorter spans cannot pin a yearly cycle and its
    extrapolation runs away); ``'on'`` always fits them."""
    keys = list(keys)
    rows = panel.select(*keys, "day", "split", t, F.col(y).cast("double").alias("_y"))

    def fit(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(t)
        tr = pdf[(pdf["split"] == "train") & pdf["_y"].notna()]
        out = pdf[pdf["split"] != "train"].copy()
        if len(tr) < 2 or len(out) == 0:
            return out.assign(predicted=np.nan).iloc[0:0]
        tt = tr[t].to_numpy(dtype=float)
        t_max = float(tt.max())
        n_cp = min(n_changepoints, max(len(tt) - 2, 0))
        cps = np.quantile(tt[: max(int(len(tt) * changepoint_range), 1)], np.linspace(0, 1, n_cp + 2)[1:-1]) \
            if n_cp > 0 else np.array([])
        yr = yearly if (yearly_mode == "on" or t_max - tt.min() >= 730) else 0
        wk = weekly if t_max - tt.min() >= 14 else 0
        x = _design(tt, t_max, cps, wk, yr)
        yy = tr["_y"].to_numpy(dtype=float)
        mu, sd = yy.mean(), yy.std() or 1.0
        pen = ridge * np.eye(x.shape[1])
        pen[0, 0] = 0.0
        beta = np.linalg.solve(x.T @ x + pen, x.T @ ((yy - mu) / sd))
        xo = _design(out[t].to_numpy(dtype=float), t_max, cps, wk, yr)
        out["predicted"] = xo @ beta * sd + mu
        return out

    return prediction_frame(per_key(rows, keys, fit).withColumnRenamed("_y", y), MODEL, keys, actual=y)
