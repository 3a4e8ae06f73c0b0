"""Distribution operators: the data under each chart.

Everything is reduced before it is shaped: histograms work on bin counts,
densities on the moments of narrow bins, box statistics on exact quantiles, and per-row views (scatter,
pairs, parallel coordinates) on a capped deterministic sample.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from numpy.polynomial.hermite_e import herme2poly
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from .rank import exact_quantiles, running_total
from .sample import sample_cap


def _join_small(df: DataFrame, small: DataFrame, by: Sequence[str]) -> DataFrame:
    """Attach a per-group statistics table (one row per group). It is
    broadcast after a bounded count, so the rows are not shuffled by group
    (a group holding a third of the rows would otherwise land in one task);
    with very many groups it falls back to a shuffled hash join."""
    by = list(by)
    if not by:
        return df.crossJoin(F.broadcast(small))
    from .joins import broadcast_if_small
    return df.join(broadcast_if_small(small), on=by)


def histogram(df: DataFrame, col: str, bins: int = 30, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width bin counts over the column's range (H1), shared by all
    groups in ``by``; the maximum falls in the last bin (``width_bucket``
    would give it a bin of its own). Returns ``(by…, bin, lo, hi, count)``."""
    by = list(by)
    x = F.col(col).cast("double")
    rng = df.agg(F.min(x).alias("_lo"), F.max(x).alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / F.lit(bins)
    b = F.when(width == 0, F.lit(0)).otherwise(F.least(F.floor((x - F.col("_lo")) / width), F.lit(bins - 1)))
    rows = df.where(x.isNotNull()).crossJoin(F.broadcast(rng)).withColumn("bin", b.cast("int"))
    counts = rows.groupBy(*by, "bin").agg(F.count(F.lit(1)).alias("count"),
                                          F.first("_lo").alias("_lo"), F.first("_hi").alias("_hi"))
    w = (F.col("_hi") - F.col("_lo")) / F.lit(bins)
    return counts.select(*by, "bin", (F.col("_lo") + F.col("bin") * w).alias("lo"),
                         (F.col("_lo") + (F.col("bin") + 1) * w).alias("hi"), "count")


def colour_histogram(df: DataFrame, col: str = "total_spent", colour: str | None = None, bins: int = 30) -> DataFrame:
    """Histogram of ``col`` split by a colour column (H1, dashboard variant);
    a colour column the table does not have falls back to ``col`` itself."""
    c = colour if colour in df.columns else col
    out = histogram(df.withColumn("_colour", F.col(c)), col, bins, by=["_colour"])
    return out.withColumnRenamed("_colour", "colour")


#: Bins a bandwidth, moments a bin and reach in bandwidths of the density sums. A bin's values lie within an eighth of a
#: bandwidth of its middle, so leaving out the moments from 11 on changes no kernel by more than 1/8^11 / sqrt(11!) of
#: its peak, and a value further than ``KDE_REACH`` bandwidths from a point gives it less than e^-32 of a peak: the
#: density is within 1e-13 / bandwidth of the sum over all rows.
KDE_BINS, KDE_MOMENTS, KDE_REACH = 4, 10, 8.0


def _kernel_sum(moments: Sequence[str], u) -> Column:
    """Sum of exp(-(u - r)^2 / 2) over a bin's offsets r from the sums of r^k: e^(-u^2/2) times the series of
    He_k(u) r^k / k! (Hermite polynomials), written as one polynomial in u."""
    n = len(moments)
    weight = np.zeros((n, n))  # power of u, moment
    for k in range(n):
        weight[:k + 1, k] = herme2poly([0.0] * k + [1.0]) / math.factorial(k)
    out = F.lit(0.0)
    for power in reversed(range(n)):
        coef = F.lit(0.0)
        for k in np.flatnonzero(weight[power]):
            coef = coef + F.lit(float(weight[power, k])) * F.col(moments[k])
        out = out * u + coef
    return out * F.exp(-0.5 * u * u)


def kde(df: DataFrame, col: str, grid: int = 100, by: Sequence[str] = (), cut: float = 3.0) -> DataFrame:
    """Gaussian kernel density of every row on a grid of each group's own
    range, extended by ``cut`` bandwidths on both sides (H2).

    Scott's bandwidth ``std · n^(-1/5)`` per group (scipy's default, as
    seaborn uses). The rows are reduced to sums of powers in bins a quarter of
    a bandwidth wide (one map-side combined aggregation, whatever the values);
    a bin meets the grid points within reach only. See ``KDE_BINS`` for the
    error. A group with fewer than two different values has no density and
    returns no rows. Returns ``(by…, point, x, density)``."""
    by = list(by)
    rows = df.select(*by, F.col(col).cast("double").alias("_x")).where(F.col("_x").isNotNull())
    stats = rows.groupBy(*by).agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"),
                                  F.count(F.lit(1)).alias("_n"), F.stddev_samp("_x").alias("_sd")) \
        .withColumn("_h", F.col("_sd") * F.pow(F.col("_n").cast("double"), F.lit(-0.2))).where(F.col("_h") > 0) \
        .withColumn("_start", F.col("_lo") - cut * F.col("_h")) \
        .withColumn("_step", (F.col("_hi") - F.col("_lo") + 2 * cut * F.col("_h")) / F.lit(grid - 1)) \
        .select(*by, "_lo", "_n", "_h", "_start", "_step")
    checkpoint_dir(df.sparkSession)
    stats = stats.checkpoint(eager=True)  # one row a group, joined three times
    pos = (F.col("_x") - F.col("_lo")) / F.col("_h") * KDE_BINS
    rows = _join_small(rows, stats.select(*by, "_lo", "_h"), by).withColumn("_b", F.floor(pos)) \
        .withColumn("_r", (pos - F.col("_b") - 0.5) / KDE_BINS)
    moments = [f"_m{k}" for k in range(KDE_MOMENTS + 1)]
    powers = [F.lit(1.0)]
    for _ in range(KDE_MOMENTS):
        powers.append(powers[-1] * F.col("_r"))
    bins = rows.groupBy(*by, "_b").agg(*[F.sum(p).alias(m) for p, m in zip(powers, moments)])
    bins = _join_small(bins, stats, by).withColumn("_c", F.col("_lo") + (F.col("_b") + 0.5) * F.col("_h") / KDE_BINS)

    reach = (KDE_REACH + 0.5 / KDE_BINS) * F.col("_h")
    first = F.greatest(F.lit(0), F.ceil((F.col("_c") - reach - F.col("_start")) / F.col("_step")))
    last = F.least(F.lit(grid - 1), F.floor((F.col("_c") + reach - F.col("_start")) / F.col("_step")))
    near = bins.withColumn("_first", first).withColumn("_last", last).where(F.col("_first") <= F.col("_last")) \
        .withColumn("point", F.explode(F.sequence(F.col("_first").cast("int"), F.col("_last").cast("int"))))
    u = (F.col("_start") + F.col("point") * F.col("_step") - F.col("_c")) / F.col("_h")
    near = near.withColumn("_u", u).select(*by, "point", _kernel_sum(moments, F.col("_u")).alias("_k"))
    # points out of reach of every value have density 0
    points = stats.select(*by, F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("point"), F.lit(0.0).alias("_k"))
    sums = near.unionByName(points).groupBy(*by, "point").agg(F.sum("_k").alias("_k"))
    return _join_small(sums, stats, by).select(
        *by, "point", (F.col("_start") + F.col("point") * F.col("_step")).alias("x"),
        (F.col("_k") / (F.col("_n") * F.col("_h") * F.lit(math.sqrt(2 * math.pi)))).alias("density"))


def hue_densities(df: DataFrame, feats: Sequence[str], hue: str, grid: int = 100, cut: float = 3.0) -> DataFrame:
    """Density of every feature in every group of ``hue``, each on its own
    range: the diagonal of a pair plot (H6). The features are unpivoted, so
    all curves come from one pass. Returns ``(feature, hue, point, x,
    density)``."""
    long = df.select(hue, *[F.col(f).cast("double").alias(f) for f in feats]) \
        .unpivot([hue], list(feats), "feature", "_value")
    return kde(long, "_value", grid, ["feature", hue], cut)


def box_stats(df: DataFrame, col: str, by: Sequence[str] = (), whisker: float = 1.5) -> DataFrame:
    """Quartiles, 1.5 IQR fences, whisker ends and outlier count (H3).
    Returns ``(by…, n, q1, median, q3, iqr, lower_fence, upper_fence,
    whisker_low, whisker_high, n_outliers)``."""
    by = list(by)
    q = exact_quantiles(df, [col], [0.25, 0.5, 0.75], by)
    quart = q.groupBy(*by).agg(*[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n)
                                 for p, n in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))])
    quart = quart.withColumn("iqr", F.col("q3") - F.col("q1")) \
        .withColumn("lower_fence", F.col("q1") - whisker * F.col("iqr")) \
        .withColumn("upper_fence", F.col("q3") + whisker * F.col("iqr"))
    x = F.col(col).cast("double")
    rows = _join_small(df.where(x.isNotNull()).select(*by, x.alias("_x")), quart, by)
    inside = (F.col("_x") >= F.col("lower_fence")) & (F.col("_x") <= F.col("upper_fence"))
    tails = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.when(inside, F.col("_x"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("_x"))).alias("whisker_high"),
        F.sum((~inside).cast("long")).alias("n_outliers"))
    return _join_small(quart, tails, by).select(*by, "n", "q1", "median", "q3", "iqr", "lower_fence", "upper_fence",
                                                "whisker_low", "whisker_high", "n_outliers")


def violin_stats(df: DataFrame, col: str, by: Sequence[str] = (), grid: int = 100, cut: float = 2.0) -> DataFrame:
    """Density curve with the group's quartiles next to it (H4); the curve of
    a violin ends ``cut`` bandwidths outside the values."""
    by = list(by)
    b = box_stats(df, col, by).select(*by, "q1", "median", "q3")
    return _join_small(kde(df, col, grid, by, cut), b, by)


def outlier_points(df: DataFrame, col: str, key: Sequence[str] | str, by: Sequence[str] = ()) -> DataFrame:
    """Every row outside its group's 1.5 IQR fences (H5)."""
    by = list(by)
    keys = [key] if isinstance(key, str) else list(key)
    f = box_stats(df, col, by).select(*by, "lower_fence", "upper_fence")
    x = F.col(col).cast("double")
    rows = _join_small(df.select(*keys, *by, x.alias(col)), f, by)
    return rows.where((F.col(col) < F.col("lower_fence")) | (F.col(col) > F.col("upper_fence"))) \
        .select(*keys, *by, col)


def pair_sample(df: DataFrame, cols: Sequence[str], key: Sequence[str] | str, hue: str | None = None,
                n: int = 1000, seed: int = 42) -> DataFrame:
    """Capped deterministic sample of the pair-plot columns (H6)."""
    keys = [key] if isinstance(key, str) else list(key)
    return sample_cap(df.select(*keys, *cols, *([hue] if hue else [])), n, keys, seed)


def sales_line(df: DataFrame, country: str | None = None, ts: str = "invoice_date", amount: str = "sales") -> DataFrame:
    """Daily sales of one country, or of all (H8)."""
    rows = df if country is None else df.where(F.col("country") == F.lit(country))
    return rows.groupBy(F.to_date(ts).alias("day")).agg(F.sum(amount).cast("double").alias("sales"))


def parallel_profile(df: DataFrame, feats: Sequence[str], key: str, label: str = "cluster") -> DataFrame:
    """Long (key, cluster, feature, value) rows of every row."""
    s = df.select(key, label, *[F.col(f).cast("double").alias(f) for f in feats])
    return s.unpivot([key, label], list(feats), "feature", "value")


#: Rows of a value that one task of the ECDF writes at a time.
ECDF_CHUNK = 50_000


def ecdf(df: DataFrame, col: str, base: int = 0, chunk: int = ECDF_CHUNK) -> DataFrame:
    """Sorted values with their cumulative share ``(i + base) / n`` (W9):
    ``base=0`` starts at 0 (EDA convention), ``base=1`` at 1/n (clustering
    convention).

    Equal values are counted first (map-side combined), so a value repeated by
    a third of the rows is one row there, and ``running_total`` gives each
    value its first position, never a window over the whole table. A value
    expands back into its rows in two steps: into chunks of ``chunk``
    positions, which are dealt out anew, and each chunk into its positions. No
    task holds a value whole."""
    from ..session import checkpoint_dir
    checkpoint_dir(df.sparkSession)
    x = F.col(col).cast("double")
    counts = df.where(x.isNotNull()).groupBy(x.alias("value")).agg(F.count(F.lit(1)).alias("_cnt")).checkpoint(eager=True)
    ranked = running_total(counts, "_cnt", ["value"])
    end = F.col("cum_before") + F.col("_cnt")
    chunks = ranked.select("value", "group_total", end.alias("_end"),
                           F.explode(F.sequence(F.col("cum_before"), end - 1, F.lit(chunk).cast("long"))).alias("_from"))
    dealt = chunks.repartition("value", "_from")
    pos = dealt.select("value", "group_total", F.explode(F.sequence(
        "_from", F.least(F.col("_from") + chunk, F.col("_end")) - 1)).alias("pos"))
    return pos.select("value", ((F.col("pos") + base) / F.col("group_total")).alias("ecdf"))


def cluster_scatter(labelled: DataFrame, centres: DataFrame, x: str, y: str, key: str, label: str = "cluster") -> DataFrame:
    """Rows (first two features + cluster) and the centres as extra marked
    rows (H9)."""
    pts = labelled.select(F.col(key).cast("string").alias("id"), F.col(x).alias("x"), F.col(y).alias("y"),
                          F.col(label).alias("cluster"), F.lit(False).alias("is_centre"))
    cs = centres.select(F.lit(None).cast("string").alias("id"), F.col(x).alias("x"), F.col(y).alias("y"),
                        F.col(label).alias("cluster"), F.lit(True).alias("is_centre"))
    return pts.unionByName(cs)
