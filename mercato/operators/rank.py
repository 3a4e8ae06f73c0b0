"""Order statistics without a single-partition window.

A window ``OVER (ORDER BY x)`` with no partition key moves every row into one
task. These helpers compute running totals over a global (or per-group) sort
order in a distributed way:

1. cut the order into value-range slices whose boundaries come from one
   approximate-quantile pass (deterministic once computed),
2. a window partitioned by ``(by…, slice)`` gives the running total inside
   each slice,
3. the per-slice totals (one row per slice and group, small) are summed in
   slice order to give each slice its offset, which is joined back.

Exact quantiles bracket each quantile with a sketch, count what lies outside the
brackets and shuffle only the distinct values inside them.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.ml.feature import Bucketizer
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType


def _n_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _numeric_key(df: DataFrame, c: str) -> Column:
    t = df.schema[c].dataType
    if isinstance(t, (TimestampType, TimestampNTZType)):
        return F.unix_micros(F.col(c).cast("timestamp")).cast("double")
    if isinstance(t, DateType):
        return F.unix_date(F.col(c)).cast("double")
    return F.col(c).cast("double")


def slice_splits(df: DataFrame, key: Column, n: int) -> list[float]:
    """``n`` slice boundaries of ``key`` from one approximate-quantile pass.

    The list has at most ``n + 1`` values whatever the data size; it is the
    only thing that reaches the driver."""
    probe = df.select(key.alias("_k")).where(F.col("_k").isNotNull())
    qs = probe.stat.approxQuantile("_k", [i / n for i in range(1, n)], 1.0 / (4 * n)) if n > 1 else []
    inner = sorted({q for q in qs if q is not None and math.isfinite(q)})
    return [-math.inf, *inner, math.inf]


def running_total(df: DataFrame, weight: str | Column, order: Sequence[str], by: Sequence[str] = (),
                  num_partitions: int | None = None, stable: bool = False,
                  groups_bound: int | None = None) -> DataFrame:
    """Add ``cum_before`` (sum of ``weight`` over earlier rows of the same
    ``by`` group in ``order``) and ``group_total``.

    Rows are cut into slices by value range of the first order column (the
    boundaries come from ``slice_splits``, so the slice of a row is a pure
    function of its value and stays the same if a stage is recomputed). A
    window per ``(by…, slice)`` gives the running total inside each slice;
    the per-slice totals, one row per slice and group, are summed in slice
    order to give offsets that are joined back. A group that holds a third of
    all rows is still spread over many slices. Ties in ``order`` are broken
    arbitrarily but consistently.

    The input is read more than once (slice boundaries, rows, slice
    totals). When its order column is not a deterministic function of the
    source (e.g. doubles produced by an aggregate, whose last bits depend on
    merge order), pass ``stable=True``: the input is then written once with a
    reliable ``checkpoint`` into ``spark.checkpoint.dir`` and every read sees
    the same values.
    """
    by, order = list(by), list(order)
    if stable:
        from ..session import checkpoint_dir
        checkpoint_dir(df.sparkSession)
        df = df.checkpoint(eager=True)
    w = F.col(weight) if isinstance(weight, str) else weight
    n = num_partitions or _n_partitions(df)
    keyed = df.withColumn("_w", w).withColumn("_key", _numeric_key(df, order[0]))
    splits = slice_splits(keyed, F.col("_key"), n)
    if len(splits) < 3:  # empty or single-valued order column: one slice
        sliced = keyed.withColumn("_slice", F.lit(0))
    else:
        sliced = Bucketizer(splits=splits, inputCol="_key", outputCol="_slice", handleInvalid="keep") \
            .transform(keyed.withColumn("_key", F.coalesce(F.col("_key"), F.lit(-math.inf)))) \
            .withColumn("_slice", F.col("_slice").cast("int"))
    in_slice = Window.partitionBy(*by, "_slice")
    local = sliced.withColumn("_local_incl", F.sum("_w").over(
        in_slice.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    # One row per (group, slice), combined map-side; the offsets table is as
    # small as groups × slices and is broadcast after a bounded count, so the
    # windowed rows are joined in place without another shuffle.
    slices = sliced.groupBy(*by, "_slice").agg(F.sum("_w").alias("_slice_total"))
    before = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    offsets = slices.select(
        *by, "_slice",
        F.coalesce(F.sum("_slice_total").over(before), F.lit(0)).alias("_offset"),
        F.sum("_slice_total").over(whole).alias("group_total"),
    )
    from .joins import broadcast_if_small
    # offsets rows <= groups × slices: with a known bound on the groups (one
    # group, or one per column) it is proven small; otherwise count first
    groups = 1 if not by else groups_bound
    offsets = offsets.withColumnsRenamed({c: f"_by_{c}" for c in [*by, "_slice"]})
    small = F.broadcast(offsets) if groups is not None and groups * len(splits) <= 200_000 \
        else broadcast_if_small(offsets, 200_000)
    same = F.col("_slice") == F.col("_by__slice")
    for c in by:  # NULL is a group like any other
        same = same & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    return local.join(small, same).drop(*[f"_by_{c}" for c in [*by, "_slice"]]) \
        .withColumn("cum_before", F.col("_offset") + F.col("_local_incl") - F.col("_w")) \
        .drop("_slice", "_local_incl", "_offset", "_w", "_key")


def unpivot_numeric(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (),
                    name: str = "column", value: str = "value") -> DataFrame:
    """Long form ``(by…, column, value)`` of numeric columns, values as double."""
    cols = list(cols)
    casted = df.select(*by, *[F.col(c).cast("double").alias(c) for c in cols])
    return casted.unpivot(list(by), cols, name, value)


#: Accuracy of the sketch that brackets a quantile (rank error 1 / SKETCH), and how many such errors wide a bracket is.
SKETCH, SLACK = 2_000, 2.0
#: Distinct values inside brackets that one window may sort; beyond it running totals are made slice by slice.
WINDOW_ROWS = 1_000_000


def _attach(df: DataFrame, small: DataFrame, by: Sequence[str], how: str = "inner", rows: int | None = None) -> DataFrame:
    """``small`` (one row per group; ``rows`` at most, if that is known) next to each row; NULL is a group like any other."""
    if not by:
        return df.crossJoin(F.broadcast(small))
    from .joins import broadcast_if_small
    side = small.withColumnsRenamed({c: f"_by_{c}" for c in by})
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    return df.join(broadcast_if_small(side, 200_000, rows), same, how).drop(*[f"_by_{c}" for c in by])


def quantile_sketch(df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = (),
                    extra: Sequence[Column] = ()) -> DataFrame:
    """One row per group, written: for column number i its non-NULL count ``_n{i}`` and, for quantile number j, sketched
    values ``_lo{i}_{j}`` and ``_hi{i}_{j}`` just below and above it, with any ``extra`` aggregates of the same pass."""
    from ..session import checkpoint_dir
    checkpoint_dir(df.sparkSession)
    probs = sorted(probs)
    around = [min(1.0, max(0.0, p + s * SLACK / SKETCH)) for p in probs for s in (-1, 1)]
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"_n{i}"), F.percentile_approx(x, around, SKETCH).alias(f"_q{i}")]
    # A rank may be one off besides the sketch's error; in a small group, where that counts, the bracket is everything.
    ends = {f"_{end}{i}_{j}": F.when(F.col(f"_n{i}") > 4 * SKETCH, F.col(f"_q{i}")[2 * j + k]).otherwise(F.lit(every))
            for i in range(len(cols)) for j in range(len(probs)) for k, (end, every) in
            enumerate((("lo", -math.inf), ("hi", math.inf)))}
    return df.groupBy(*by).agg(*aggs, *extra).withColumns(ends).drop(*[f"_q{i}" for i in range(len(cols))]) \
        .checkpoint(eager=True)


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = (),
                    approx: bool = False, accuracy: int = 10_000, sketch: DataFrame | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation between order statistics
    (pandas ``quantile``, DuckDB ``quantile_cont``), NULLs ignored.

    Returns ``(by…, column, prob, value)``, no row for a column without values.

    1. One pass sketches every column and brackets each quantile between two
       values some thousandths of the rows apart (``quantile_sketch``, which
       may be passed in).
    2. One pass counts, per column, the distinct values inside the brackets and
       how many values lie in each gap between them. Only these few rows are
       shuffled, and a value held by a third of all rows is one of them.

    The order statistics are then picked by running totals over the values in
    the brackets. A bracket that should miss its order statistic, which the
    sketch's error bound rules out, raises an error. ``approx=True`` trades
    exactness for one pass with sketches (rank error about 1/``accuracy``).
    """
    by, cols, probs = list(by), list(cols), sorted(float(p) for p in probs)
    if approx:
        long = unpivot_numeric(df, cols, by).where(F.col("value").isNotNull())
        arr = long.groupBy(*by, "column").agg(F.percentile_approx("value", probs, accuracy).alias("_qs"))
        return arr.select(*by, "column", F.posexplode("_qs").alias("_i", "value")) \
            .withColumn("prob", F.element_at(F.array(*[F.lit(p) for p in probs]), F.col("_i") + 1)) \
            .select(*by, "column", "prob", "value")
    if sketch is None:
        sketch = quantile_sketch(df, cols, probs, by)
    js = range(len(probs))
    brackets = sketch.select(*by, F.inline(F.array(*[F.struct(
        F.lit(i).alias("_i"), F.col(f"_n{i}").alias("_n"),
        *[F.col(f"_{end}{i}_{j}").alias(f"_{end}{j}") for j in js for end in ("lo", "hi")]) for i in range(len(cols))])))
    names = [str(i) for i in range(len(cols))]
    long = df.select(*by, *[F.col(c).cast("double").alias(k) for k, c in zip(names, cols, strict=True)]) \
        .unpivot(by, names, "_i", "value").where(F.col("value").isNotNull()).withColumn("_i", F.col("_i").cast("int"))
    x, inside, gap = F.col("value"), F.lit(False), F.lit(0)
    for j in js:  # a value inside a bracket stays, any other is only counted in its gap
        inside = inside | x.between(F.col(f"_lo{j}"), F.col(f"_hi{j}"))
        gap = gap + (x > F.col(f"_hi{j}")).cast("int")
    counts = _attach(long, brackets, [*by, "_i"], rows=None if by else len(cols)) \
        .select(*by, "_i", F.when(inside, x).alias("value"), F.when(inside, -1).otherwise(gap).alias("_gap")) \
        .groupBy(*by, "_i", "_gap", "value").agg(F.count(F.lit(1)).alias("_cnt")).checkpoint(eager=True)
    each = _attach(counts, brackets, [*by, "_i"], rows=None if by else len(cols)).select(
        *by, "_i", "_n", "_gap", "value", "_cnt", F.inline(F.array(*[F.struct(
            F.lit(j).alias("_j"), F.col(f"_lo{j}").alias("_lo"), F.col(f"_hi{j}").alias("_hi")) for j in js])))
    under = each.where("value < _lo OR (_gap >= 0 AND _gap <= _j)").groupBy(*by, "_i", "_j").agg(F.sum("_cnt").alias("_below"))
    counts = each.where(F.col("value").between(F.col("_lo"), F.col("_hi"))).drop("_gap", "_lo", "_hi")
    from .joins import fits
    group = [*by, "_i", "_j"]
    if fits(counts, WINDOW_ROWS):
        before = Window.partitionBy(*group).orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
        ranked = counts.withColumn("cum_before", F.coalesce(F.sum("_cnt").over(before), F.lit(0)))
    else:
        ranked = running_total(counts, "_cnt", ["value"], by=group).drop("group_total")
    ranked = _attach(ranked, under, group, "left", rows=None if by else len(cols) * len(probs)).withColumn("_below", F.coalesce("_below", F.lit(0)))
    h = (F.col("_n") - 1) * F.element_at(F.array(*[F.lit(p) for p in probs]), F.col("_j") + 1)
    first = F.col("_below") + F.col("cum_before")
    within = lambda r: (first <= r) & (r < first + F.col("_cnt"))
    low, high = F.floor(h), F.least(F.floor(h) + 1, F.col("_n") - 1)
    picked = ranked.groupBy(*group).agg(
        F.max(F.when(within(low), F.col("value"))).alias("_low"), F.max(F.when(within(high), F.col("value"))).alias("_high"),
        F.max(h - low).alias("_part"))
    value = F.when(F.col("_low").isNotNull() & F.col("_high").isNotNull(),
                   F.col("_low") + F.col("_part") * (F.col("_high") - F.col("_low"))) \
        .otherwise(F.raise_error(F.lit("a sketched bracket missed its quantile")))
    return picked.select(*by, F.element_at(F.array(*[F.lit(c) for c in cols]), F.col("_i") + 1).alias("column"),
                         F.element_at(F.array(*[F.lit(p) for p in probs]), F.col("_j") + 1).alias("prob"), value.alias("value"))


def quantile_table(df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = (),
                   names: Sequence[str] | None = None, sketch: DataFrame | None = None) -> DataFrame:
    """Wide form: one row per ``(by…, column)``, one column per probability."""
    names = list(names or [f"q{int(round(p * 100)):02d}" for p in probs])
    long = exact_quantiles(df, cols, probs, by, sketch=sketch)
    aggs = [F.max(F.when(F.col("prob") == float(p), F.col("value"))).alias(nm) for p, nm in zip(probs, names)]
    return long.groupBy(*by, "column").agg(*aggs)


def row_positions(df: DataFrame, order: Sequence[str], by: Sequence[str] = (), stable: bool = False) -> DataFrame:
    """Add ``pos`` (0-based position in ``order`` within ``by``) and ``n``."""
    out = running_total(df, F.lit(1), order, by, stable=stable)
    return out.withColumnRenamed("cum_before", "pos").withColumnRenamed("group_total", "n")


def number_rows(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add ``pos``, the 0-based position in ``order``, for keys of any type.

    The sorted rows are written once with the partition they fell into; the
    positions inside a partition are shifted by the sizes of those before it
    (one row per partition)."""
    from ..session import checkpoint_dir
    checkpoint_dir(df.sparkSession)
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = df.orderBy(*order).withColumns({"_part": F.spark_partition_id(), "_at": within}).checkpoint(eager=True)
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_shift"))
    return placed.join(F.broadcast(shift), "_part").withColumn("pos", F.col("_at") + F.col("_shift")) \
        .drop("_part", "_at", "_shift")
