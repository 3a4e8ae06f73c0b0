"""Exploration and profiling.

Each profile is one or two aggregation passes over the table, whatever the
number of columns: wide ``agg`` lists, then ``unpivot`` to a long result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, IntegralType, NumericType

from .rank import quantile_sketch, quantile_table


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Numeric column names, optionally excluding some."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in exclude]


def column_info(df: DataFrame) -> DataFrame:
    """column, non-null count, type (E1): one pass."""
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
    long = counts.unpivot([], df.columns, "column", "non_null")
    types = df.sparkSession.createDataFrame([(f.name, f.dataType.simpleString(), i) for i, f in
                                             enumerate(df.schema.fields)], "column string, type string, position int")
    return long.join(F.broadcast(types), "column").select("position", "column", "non_null", "type")


def head(df: DataFrame, n: int = 5, order: Sequence[str] | None = None) -> DataFrame:
    """First n rows in an explicit order."""
    return df.orderBy(*(order or df.columns[:1])).limit(n)


def describe(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """count, mean, std, min, 25 %, 50 %, 75 %, max per numeric column (E3),
    exact quantiles (``DataFrame.summary`` would give approximate ones).

    Two passes whatever the number of columns: moments and quantile brackets in
    one wide aggregate, then the values inside the brackets and counts outside."""
    cols = list(cols or numeric_columns(df))
    probs = [0.25, 0.5, 0.75]
    stats = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    sketch = quantile_sketch(df, cols, probs, extra=[f(F.col(c).cast("double")).alias(f"_{k}{i}") for i, c in
                                                     enumerate(cols) for k, f in stats.items()])
    moments = sketch.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), *[F.col(f"_{k}{i}").alias(k) for k in stats])
                                               for i, c in enumerate(cols)])))
    qs = quantile_table(df, cols, probs, names=["p25", "p50", "p75"], sketch=sketch)
    return moments.join(F.broadcast(qs), "column", "left") \
        .select("column", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def numeric_to_double(df: DataFrame) -> DataFrame:
    """Numeric columns cast to double before profiling (E5)."""
    num = set(numeric_columns(df))
    return df.select(*[F.col(c).cast("double").alias(c) if c in num else F.col(c) for c in df.columns])


def distinct_values(df: DataFrame) -> DataFrame:
    """``(column, distinct)``: how many different values, told apart as text, each column holds; no row for one without values.

    One pass and one shuffle of the different values. Numbers are compared as numbers, which are as many as
    their texts but for -0.0, which is set apart; all other types are compared as text."""
    long, double, text = (F.lit(None).cast(t) for t in ("long", "double", "string"))
    cells = []
    for i, f in enumerate(df.schema.fields):
        c = F.col(f.name)
        if isinstance(f.dataType, IntegralType):
            cells += [F.lit(i), c.cast("long"), double, text]
        elif isinstance(f.dataType, (DoubleType, FloatType)):
            v = c.cast("double")
            minus = (v == 0) & (v.cast("string") == "-0.0")
            cells += [F.lit(i), long, F.when(~minus, v), F.when(minus, F.lit("-0.0"))]
        else:
            cells += [F.lit(i), long, double, c.cast("string")]
    each = df.select(F.stack(F.lit(len(df.columns)), *cells).alias("_i", "_l", "_d", "_s")) \
        .where("_l IS NOT NULL OR _d IS NOT NULL OR _s IS NOT NULL").distinct()
    return each.groupBy("_i").agg(F.count(F.lit(1)).alias("distinct")) \
        .select(F.element_at(F.array(*[F.lit(c) for c in df.columns]), F.col("_i") + 1).alias("column"), "distinct")


def profile(df: DataFrame, top: int = 3) -> DataFrame:
    """Per column: count, missing, distinct, zeros, negatives, mean, std, min,
    max, quartiles (numeric), and the ``top`` most frequent values (E4).

    Three passes: counts, moments and quantile brackets in one wide aggregate,
    the values inside the brackets, and the distinct values. No rows, no columns:
    an empty table gives an empty profile.

    Duplicate-row count is a separate one-row result: ``duplicate_rows``.
    """
    num, probs = numeric_columns(df), [0.25, 0.5, 0.75]
    x = {c: F.col(c).cast("double") for c in num}
    stats = {"zeros": lambda v: F.sum((v == 0).cast("long")), "negatives": lambda v: F.sum((v < 0).cast("long")),
             "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    aggs = [F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(f"_count{i}") for i, c in enumerate(df.columns)],
            *[f(x[c]).alias(f"_{k}{i}") for i, c in enumerate(df.columns) if c in num for k, f in stats.items()]]
    wide = quantile_sketch(df, num, probs, extra=aggs) if num else df.agg(*aggs)
    none = {k: F.lit(None).cast("long" if k in ("zeros", "negatives") else "double") for k in stats}
    out = wide.where("_rows > 0").select(F.inline(F.array(*[F.struct(
        F.lit(c).alias("column"), F.col("_rows").alias("n_rows"), F.col(f"_count{i}").alias("count"),
        (F.col("_rows") - F.col(f"_count{i}")).alias("missing"),
        *[(F.col(f"_{k}{i}") if c in num else none[k]).alias(k) for k in stats if num]) for i, c in enumerate(df.columns)])))
    out = out.join(distinct_values(df), "column", "left").select(
        "column", "n_rows", "count", "missing", F.coalesce("distinct", F.lit(0)).alias("distinct"), *[k for k in stats if num])
    if num:
        out = out.join(quantile_table(df, num, probs, names=["p25", "p50", "p75"], sketch=wide), "column", "left")
    strs = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    long = strs.unpivot([], df.columns, "column", "value")
    freq = long.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("_f"))
    w = Window.partitionBy("column").orderBy(F.desc("_f"), F.asc("value"))
    tops = freq.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= top) \
        .groupBy("column").agg(F.sort_array(F.collect_list(F.struct(F.col("_r"), F.col("value")))).alias("_t")) \
        .select("column", F.transform("_t", lambda s: s["value"]).alias("top_values"))
    return out.join(tops, "column", "left")


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Number of rows that repeat an earlier identical row."""
    g = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return g.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("duplicate_rows"))


def correlation(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson matrix in long form ``(a, b, corr)`` (E6): one aggregation
    with ``corr`` for every pair; ``corr`` skips rows where either is NULL."""
    cols = list(cols)
    aggs, names = [], []
    for i, a in enumerate(cols):
        for b in cols[i:]:
            nm = f"{i}__{cols.index(b)}"
            names.append((nm, a, b))
            aggs.append(F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(nm))
    wide = df.agg(*aggs)
    long = wide.unpivot([], [n for n, _, _ in names], "_pair", "corr")
    pairs = df.sparkSession.createDataFrame([(n, a, b) for n, a, b in names] + [(n, b, a) for n, a, b in names if a != b],
                                            "_pair string, a string, b string")
    return long.join(F.broadcast(pairs), "_pair").select("a", "b", "corr")


def shape(df: DataFrame) -> DataFrame:
    """rows, columns."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))
