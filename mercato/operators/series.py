"""Daily series shaping for any number of keys.

A panel is ``(keys…, day, value)``. Every window below is partitioned by the
series keys: a series is one key's days, so its length is bounded by the
calendar span, not by the data volume, and the panel spreads over tasks by
key. ``keys=[]`` is the single national series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _w(keys: Sequence[str]):
    return Window.partitionBy(*keys)


def gap_fill(df: DataFrame, keys: Sequence[str] = (), day: str = "day", value: str = "sales",
             fill: float | None = 0.0) -> DataFrame:
    """One row per day between each key's first and last day.

    Missing days get ``fill`` (0 by default; ``None`` leaves NULL for W2).
    The calendar is generated per key with ``sequence`` + ``explode`` and
    left-joined to the observed days on ``(keys…, day)``."""
    keys = list(keys)
    bounds = df.groupBy(*keys).agg(F.min(day).alias("_lo"), F.max(day).alias("_hi"))
    cal = bounds.select(*keys, F.explode(F.sequence("_lo", "_hi", F.expr("INTERVAL 1 DAY"))).alias(day))
    out = cal.join(df, on=[*keys, day], how="left")
    if fill is not None:
        out = out.withColumn(value, F.coalesce(F.col(value), F.lit(fill).cast(df.schema[value].dataType)))
    return out


def fill_forward_back(df: DataFrame, keys: Sequence[str] = (), day: str = "day", value: str = "sales") -> DataFrame:
    """Forward fill, then backward fill for a leading gap."""
    keys = list(keys)
    past = _w(keys).orderBy(day).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    future = _w(keys).orderBy(day).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    ff = F.last(value, ignorenulls=True).over(past)
    bf = F.first(value, ignorenulls=True).over(future)
    return df.withColumn(value, F.coalesce(ff, bf))


def asfreq_zero(df: DataFrame, keys: Sequence[str] = (), day: str = "day", value: str = "sales") -> DataFrame:
    """Daily frequency with 0 in gaps, renamed to ``(ds, y)``."""
    return gap_fill(df, keys, day, value, 0.0).withColumnRenamed(day, "ds").withColumnRenamed(value, "y")


def time_index(df: DataFrame, keys: Sequence[str] = (), day: str = "day", out: str = "t") -> DataFrame:
    """0…n-1 along each gap-free series, continuing across splits (W4):
    days since the key's first day, so no sort of the whole series."""
    keys = list(keys)
    start = df.groupBy(*keys).agg(F.min(day).alias("_start"))
    joined = df.join(start, on=keys) if keys else df.crossJoin(F.broadcast(start))
    return joined.withColumn(out, F.datediff(F.col(day), F.col("_start"))).drop("_start")


def lag_windows(df: DataFrame, keys: Sequence[str] = (), day: str = "day", value: str = "sales", w: int = 7,
                within: Sequence[str] = ("split",), prefix: str = "lag") -> DataFrame:
    """The ``w`` previous values (``lag1`` = yesterday) next to the value to
    predict, built inside each split; only full windows are kept (W5)."""
    part = [*keys, *[c for c in within if c in df.columns]]
    spec = _w(part).orderBy(day)
    out = df
    for i in range(1, w + 1):
        out = out.withColumn(f"{prefix}{i}", F.lag(value, i).over(spec))
    return out.where(F.col(f"{prefix}{w}").isNotNull())


def split_bounds(df: DataFrame, day: str = "day", test_days: int = 31, val_days: int = 31) -> DataFrame:
    """One row: last train day and last validation day, counted back from the
    latest day (defaults: last 31 days test, 31 before validation)."""
    return df.agg(F.max(day).alias("_max")).select(
        F.date_sub("_max", test_days + val_days).alias("_train_end"),
        F.date_sub("_max", test_days).alias("_val_end"))


def split_by_date(df: DataFrame, day: str = "day", train_end=None, val_end=None, test_end=None,
                  test_days: int = 31, val_days: int = 31) -> DataFrame:
    """Label each day train / validation / test by inclusive date ranges.

    Explicit bounds (dates or ``yyyy-MM-dd`` text) follow the reference's
    fixed calendar; without them the bounds count back from the last day.
    Days after ``test_end`` are dropped."""
    if train_end is not None:
        te, ve = F.to_date(F.lit(str(train_end))), F.to_date(F.lit(str(val_end)))
        out = df.withColumn("split", F.when(F.col(day) <= te, "train").when(F.col(day) <= ve, "validation")
                            .otherwise("test"))
        return out.where(F.col(day) <= F.to_date(F.lit(str(test_end)))) if test_end is not None else out
    b = split_bounds(df, day, test_days, val_days)
    out = df.crossJoin(F.broadcast(b))
    out = out.withColumn("split", F.when(F.col(day) <= F.col("_train_end"), "train")
                         .when(F.col(day) <= F.col("_val_end"), "validation").otherwise("test"))
    return out.drop("_train_end", "_val_end")


def split_sizes(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Rows per split."""
    return df.groupBy(*keys, "split").agg(F.count(F.lit(1)).alias("rows"))


def split_trend(df: DataFrame, keys: Sequence[str] = (), day: str = "day", value: str = "sales") -> DataFrame:
    """(keys…, day, value, split) for the split chart."""
    return df.select(*keys, day, value, "split")


def align_tail(df: DataFrame, group: str = "model", day: str = "day", keys: Sequence[str] = ()) -> DataFrame:
    """Cut every group's series to the common last n days, n = the shortest
    series (W6)."""
    keys = list(keys)
    counts = df.groupBy(*keys, group).agg(F.count(F.lit(1)).alias("_c"))
    nmin = counts.groupBy(*keys).agg(F.min("_c").alias("_nmin"))
    ranked = df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys, group).orderBy(F.desc(day))))
    joined = ranked.join(nmin, on=keys) if keys else ranked.crossJoin(F.broadcast(nmin))
    return joined.where(F.col("_r") <= F.col("_nmin")).drop("_r", "_nmin")


def future_frame(df: DataFrame, horizon: int, keys: Sequence[str] = (), day: str = "day") -> DataFrame:
    """The ``horizon`` days after each key's last day."""
    keys = list(keys)
    last = df.groupBy(*keys).agg(F.max(day).alias("_last"))
    return last.select(*keys, F.explode(F.sequence(F.date_add("_last", 1), F.date_add("_last", horizon)))
                       .alias(day))


def before_after(before: DataFrame, after: DataFrame, cols: Sequence[str], label: str = "state") -> DataFrame:
    """Two versions of a table stacked with a state label."""
    a = before.select(*cols).withColumn(label, F.lit("before"))
    b = after.select(*cols).withColumn(label, F.lit("after"))
    return a.unionByName(b)
