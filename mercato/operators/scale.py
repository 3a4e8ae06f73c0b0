"""Column scalers (C11-C14), scikit-learn conventions.

A fitted scaler is a one-row DataFrame of parameters (a centre and a scale
per column): its size depends on the number of columns only, so it is
broadcast and cross-joined onto the rows. Fitting on one subset (the train
split) and applying to all rows is the same join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rank import exact_quantiles

METHODS = ("standard", "robust", "minmax")
ALIASES = {"StandardScaler": "standard", "RobustScaler": "robust", "MinMaxScaler": "minmax"}


def _nonzero(c):
    return F.when((c.isNull()) | (c == 0), F.lit(1.0)).otherwise(c)


def fit_scaler(df: DataFrame, cols: Sequence[str], method: str = "standard") -> DataFrame:
    """Parameters ``_c_<col>`` (centre) and ``_s_<col>`` (scale), one row.

    standard: mean and population std; robust: median and IQR (exact,
    interpolated); minmax: min and range. A zero scale becomes 1.
    """
    method = ALIASES.get(method, method)
    cols = list(cols)
    if method == "standard":
        aggs = []
        for c in cols:
            aggs += [F.avg(F.col(c).cast("double")).alias(f"_c_{c}"),
                     _nonzero(F.stddev_pop(F.col(c).cast("double"))).alias(f"_s_{c}")]
        return df.agg(*aggs)
    if method == "minmax":
        aggs = []
        for c in cols:
            lo, hi = F.min(F.col(c).cast("double")), F.max(F.col(c).cast("double"))
            aggs += [lo.alias(f"_c_{c}"), _nonzero(hi - lo).alias(f"_s_{c}")]
        return df.agg(*aggs)
    if method == "robust":
        q = exact_quantiles(df, cols, [0.25, 0.5, 0.75])
        aggs = []
        for c in cols:
            pick = lambda p: F.max(F.when((F.col("column") == c) & (F.col("prob") == p), F.col("value")))
            aggs += [pick(0.5).alias(f"_c_{c}"), _nonzero(pick(0.75) - pick(0.25)).alias(f"_s_{c}")]
        return q.agg(*aggs)
    raise ValueError(f"unknown scaler {method!r}; expected one of {METHODS}")


def apply_scaler(df: DataFrame, params: DataFrame, cols: Sequence[str], inverse: bool = False,
                 suffix: str = "") -> DataFrame:
    """(x - centre) / scale, or the inverse x * scale + centre."""
    out = df.crossJoin(F.broadcast(params))
    for c in cols:
        x = F.col(c).cast("double")
        val = x * F.col(f"_s_{c}") + F.col(f"_c_{c}") if inverse else (x - F.col(f"_c_{c}")) / F.col(f"_s_{c}")
        out = out.withColumn(c + suffix, val)
    return out.drop(*params.columns)


def scale(df: DataFrame, cols: Sequence[str], method: str = "standard", fit_on: DataFrame | None = None,
          suffix: str = "") -> DataFrame:
    """Fit on ``fit_on`` (default: ``df`` itself) and apply to ``df``.

    An unknown method falls back to standard, as the line scaler does."""
    m = ALIASES.get(method, method)
    if m not in METHODS:
        m = "standard"
    params = fit_scaler(fit_on if fit_on is not None else df, cols, m)
    return apply_scaler(df, params, cols, suffix=suffix)


def scale_by_split(df: DataFrame, cols: Sequence[str], method: str | None = "standard",
                   split_col: str = "split", train: str = "train") -> DataFrame:
    """Fit on the train split, apply to every split (C14). ``None`` or an
    unknown method leaves the features unscaled, as the feature scaler does."""
    m = ALIASES.get(method, method) if method else None
    if m not in METHODS:
        return df
    return scale(df, cols, m, fit_on=df.where(F.col(split_col) == train))
