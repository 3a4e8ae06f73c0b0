"""The model-ready panel and the common prediction shape.

A panel row: ``(keys…, day, sales, split, t)``, gap-free per key.
Every model returns ``(model, keys…, day, split, actual, predicted)`` for the
validation and test days.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import aggregates as A
from .. import series as W
from ..clean import add_log, inverse_log


def build_panel(lines: DataFrame, keys: Sequence[str] = (), value: str = "sales", test_days: int = 31,
                val_days: int = 31, fill_missing: bool = True, materialise: bool = True, **split_kw) -> DataFrame:
    """lines → daily sums per key (A1) → gap fill with 0 (W1) → split
    → time index (W4).

    The panel has one row per key and day, whatever the number of lines,
    and every model reads it several times (train rows, holdout rows, tails,
    horizons), so it is written once with a reliable checkpoint."""
    keys = list(keys)
    daily = A.daily_sales(lines, keys, amount=value)
    if materialise:  # the one pass over the lines; the calendar steps below read it several times
        from ...session import checkpoint_dir
        checkpoint_dir(lines.sparkSession)
        daily = daily.checkpoint(eager=True)
    filled = W.gap_fill(daily, keys, "day", "sales", 0.0 if fill_missing else None)
    split = W.split_by_date(filled, "day", test_days=test_days, val_days=val_days, **split_kw)
    panel = W.time_index(split, keys)
    if materialise:
        panel = panel.checkpoint(eager=True)
    return panel


def prediction_frame(df: DataFrame, model: str, keys: Sequence[str], pred: str = "predicted",
                     actual: str = "sales") -> DataFrame:
    return df.select(F.lit(model).alias("model"), *keys, "day", "split",
                     F.col(actual).cast("double").alias("actual"), F.col(pred).cast("double").alias("predicted"))


def holdout(panel: DataFrame) -> DataFrame:
    return panel.where(F.col("split") != "train")


def train(panel: DataFrame) -> DataFrame:
    return panel.where(F.col("split") == "train")


def per_key(rows: DataFrame, keys: Sequence[str], fit: Callable[[tuple, pd.DataFrame], pd.DataFrame]) -> DataFrame:
    """``fit(key values, one key's days)`` for every key, next to a ``predicted``
    column. A group is one key's daily series, which is bounded by the calendar
    span; without keys it is the single series."""
    keys = list(keys)
    schema = rows.withColumn("predicted", F.lit(0.0)).schema
    if keys:
        return rows.groupBy(*keys).applyInPandas(fit, schema)

    def single(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        return fit((), pdf.drop(columns=["_all"]))
    return rows.withColumn("_all", F.lit(0)).groupBy("_all").applyInPandas(single, schema)


def in_log_space(forecast: Callable[..., DataFrame], panel: DataFrame, keys: Sequence[str] = (), y: str = "sales",
                 **kw) -> DataFrame:
    """The forecast of a model fitted to log1p of the target (C9), with its
    actual and predicted values mapped back by expm1 (C10). A day whose sum is
    −1 or less (returns) has no logarithm: it is a missing day to the model
    and has no actual value, so that scores leave it out."""
    logged = add_log(panel, y, y)
    return inverse_log(forecast(logged, keys, y=y, **kw), ["actual", "predicted"])
