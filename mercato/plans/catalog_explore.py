"""Catalog: exploration and profiling."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import explore as E
from ..sources import SALES_LINES_SQL
from . import views as V
from .registry import register

NUMERIC = ["invoice_no", "line_no", "stock_code", "quantity", "unit_price", "sales", "customer_id"]
ALL = ["invoice_no", "line_no", "row_key", "stock_code", "description", "quantity", "unit_price", "sales",
       "invoice_date", "customer_id", "country"]
R = 6


def _lines_double_sales(spark, sf_dir):
    return V.lines(spark, sf_dir).withColumn("sales", F.col("sales").cast("double"))


@register("e1_column_info", "E1", V.sql(f"""
, counts AS (UNPIVOT (SELECT {", ".join(f"count({c}) AS {c}" for c in ALL)} FROM sales_lines)
             ON {", ".join(ALL)} INTO NAME column_name VALUE non_null),
pos AS (SELECT * FROM (VALUES {", ".join(f"({i}, '{c}')" for i, c in enumerate(ALL))}) AS t(position, column_name))
SELECT CAST(position AS INTEGER) AS position, column_name AS "column", non_null FROM counts JOIN pos USING (column_name)
""", SALES_LINES_SQL))
def e1_column_info(spark, sf_dir):
    return E.column_info(V.lines(spark, sf_dir)).select("position", "column", "non_null")


@register("e2_head", "E2", V.sql("""
SELECT invoice_no, line_no, row_key, stock_code, description, quantity, unit_price, CAST(sales AS DOUBLE) AS sales,
       invoice_date, customer_id, country
FROM sales_lines ORDER BY row_key LIMIT 5""", SALES_LINES_SQL))
def e2_head(spark, sf_dir):
    return E.head(_lines_double_sales(spark, sf_dir), 5, ["row_key"])


_DESCRIBE_SQL = V.sql(f"""
, long AS (UNPIVOT (SELECT {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in NUMERIC)} FROM sales_lines)
           ON {", ".join(NUMERIC)} INTO NAME column_name VALUE value)
SELECT column_name AS "column", count(value) AS count, round(avg(value), {R}) AS mean,
       round(stddev_samp(value), {R}) AS std, min(value) AS min,
       round(quantile_cont(value, 0.25), {R}) AS p25, round(quantile_cont(value, 0.5), {R}) AS p50,
       round(quantile_cont(value, 0.75), {R}) AS p75, max(value) AS max
FROM long GROUP BY 1""", SALES_LINES_SQL)


@register("e3_describe", "E3, E8", _DESCRIBE_SQL)
def e3_describe(spark, sf_dir):
    df = _lines_double_sales(spark, sf_dir)
    d = E.describe(df, E.numeric_columns(df))
    return d.select("column", "count", *[F.round(c, R).alias(c) for c in ("mean", "std")], "min",
                    *[F.round(c, R).alias(c) for c in ("p25", "p50", "p75")], "max")


@register("e4_profile", "E4", V.sql(f"""
, s0 AS (SELECT {", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in ALL)} FROM sales_lines),
s AS (SELECT * FROM s0 UNPIVOT INCLUDE NULLS (value FOR column_name IN ({", ".join(ALL)}))),
base AS (SELECT column_name, count(*) AS n_rows, count(value) AS count,
                CAST(sum(CASE WHEN value IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing,
                count(DISTINCT value) AS distinct_values FROM s GROUP BY 1),
n AS (UNPIVOT (SELECT {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in NUMERIC)} FROM sales_lines)
      ON {", ".join(NUMERIC)} INTO NAME column_name VALUE x),
st AS (SELECT column_name, CAST(sum(CASE WHEN x = 0 THEN 1 ELSE 0 END) AS BIGINT) AS zeros,
              CAST(sum(CASE WHEN x < 0 THEN 1 ELSE 0 END) AS BIGINT) AS negatives,
              round(avg(x), {R}) AS mean, round(stddev_samp(x), {R}) AS std, min(x) AS min, max(x) AS max,
              round(quantile_cont(x, 0.5), {R}) AS p50 FROM n GROUP BY 1)
SELECT base.column_name AS "column", n_rows, count, missing, distinct_values, zeros, negatives, mean, std, min, max, p50
FROM base LEFT JOIN st USING (column_name)""", SALES_LINES_SQL))
def e4_profile(spark, sf_dir):
    df = _lines_double_sales(spark, sf_dir)
    p = E.profile(df)
    return p.select("column", "n_rows", "count", "missing", F.col("distinct").alias("distinct_values"), "zeros",
                    "negatives", F.round("mean", R).alias("mean"), F.round("std", R).alias("std"), "min", "max",
                    F.round("p50", R).alias("p50"))


@register("e4_top_values", "E4", V.sql("""
, s AS (UNPIVOT (SELECT country, description FROM sales_lines) ON country, description
        INTO NAME column_name VALUE value),
f AS (SELECT column_name, value, count(*) AS freq FROM s GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY freq DESC, value) AS rank FROM f)
SELECT column_name AS "column", rank, value, freq FROM r WHERE rank <= 3""", SALES_LINES_SQL))
def e4_top_values(spark, sf_dir):
    df = V.lines(spark, sf_dir).select("country", "description")
    long = df.unpivot([], ["country", "description"], "column", "value").where(F.col("value").isNotNull())
    freq = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("freq"))
    w = Window.partitionBy("column").orderBy(F.desc("freq"), F.asc("value"))
    return freq.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= 3) \
        .select("column", "rank", "value", "freq")


@register("e4_duplicate_rows", "E4", V.sql("""
SELECT CAST(COALESCE(sum(n - 1), 0) AS BIGINT) AS duplicate_rows
FROM (SELECT count(*) AS n FROM sales_lines GROUP BY ALL_COLS)""".replace(
    "GROUP BY ALL_COLS", "GROUP BY " + ", ".join(ALL)), SALES_LINES_SQL))
def e4_duplicate_rows(spark, sf_dir):
    return E.duplicate_rows(V.lines(spark, sf_dir))


@register("e5_numeric_to_double", "E5", V.sql(f"""
SELECT row_key, {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in NUMERIC)} FROM sales_lines""", SALES_LINES_SQL))
def e5_numeric_to_double(spark, sf_dir):
    return E.numeric_to_double(V.lines(spark, sf_dir)).select("row_key", *NUMERIC)


_CORR = ["quantity", "unit_price", "sales"]


@register("e6_correlation", "E6", V.sql(f"""
, pairs AS ({" UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS corr FROM sales_lines" for a in _CORR for b in _CORR)})
SELECT a, b, round(corr, {R}) AS corr FROM pairs""", SALES_LINES_SQL))
def e6_correlation(spark, sf_dir):
    c = E.correlation(_lines_double_sales(spark, sf_dir), _CORR)
    return c.select("a", "b", F.round("corr", R).alias("corr"))


@register("e7_shape", "E7", V.sql(f"SELECT count(*) AS rows, {len(ALL)} AS columns FROM sales_lines", SALES_LINES_SQL))
def e7_shape(spark, sf_dir):
    return E.shape(V.lines(spark, sf_dir))
