"""Catalog: series shaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import series as W
from ..operators.forecast.panel import build_panel
from ..sources import SALES_LINES_SQL
from . import views as V
from .registry import register

K = ["country"]


def panel(spark, sf_dir, keys=K):
    return build_panel(V.lines(spark, sf_dir), keys)


@register("w1_gap_fill", "W1, W3, A1", V.sql("SELECT country, day, sales FROM panel_filled",
                                             SALES_LINES_SQL, V.panel_sql(K)))
def w1_gap_fill(spark, sf_dir):
    return W.gap_fill(A.daily_sales(V.lines(spark, sf_dir), K), K)


@register("w2_fill_forward_back", "W2", V.sql("""
, g AS (SELECT c.day, d.sales FROM panel_cal c LEFT JOIN panel_daily d USING (day))
SELECT day, COALESCE(last_value(sales IGNORE NULLS) OVER (ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                     first_value(sales IGNORE NULLS) OVER (ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
       AS sales
FROM g""", SALES_LINES_SQL, V.panel_sql(())))
def w2_fill_forward_back(spark, sf_dir):
    daily = A.daily_sales(V.lines(spark, sf_dir))
    return W.fill_forward_back(W.gap_fill(daily, (), fill=None)).select("day", "sales")


@register("w3_asfreq_zero", "W3", V.sql("SELECT day AS ds, sales AS y FROM panel_filled",
                                        SALES_LINES_SQL, V.panel_sql(())))
def w3_asfreq_zero(spark, sf_dir):
    return W.asfreq_zero(A.daily_sales(V.lines(spark, sf_dir))).select("ds", "y")


@register("w4_w7_panel", "W4, W7, W1, A1", V.sql("SELECT country, day, sales, split, t FROM panel",
                                                 SALES_LINES_SQL, V.panel_sql(K)))
def w4_w7_panel(spark, sf_dir):
    return panel(spark, sf_dir).select("country", "day", "sales", "split", "t")


@register("w5_lag_windows", "W5", V.sql("""
, l AS (SELECT country, day, split, sales, """ + ", ".join(
    f"lag(sales, {i}) OVER (PARTITION BY country, split ORDER BY day) AS lag{i}" for i in range(1, 8)) + """
        FROM panel)
SELECT * FROM l WHERE lag7 IS NOT NULL""", SALES_LINES_SQL, V.panel_sql(K)))
def w5_lag_windows(spark, sf_dir):
    p = panel(spark, sf_dir).select("country", "day", "split", "sales")
    return W.lag_windows(p, K, "day", "sales", 7)


@register("w6_align_tail", "W6", V.sql("""
, d AS (SELECT country, CAST(invoice_date AS DATE) AS day, CAST(sum(sales) AS DOUBLE) AS sales
        FROM sales_lines GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY country ORDER BY day DESC) AS rn,
             count(*) OVER (PARTITION BY country) AS c FROM d)
SELECT country, day, sales FROM r WHERE rn <= (SELECT min(c) FROM r)""", SALES_LINES_SQL))
def w6_align_tail(spark, sf_dir):
    return W.align_tail(A.daily_sales(V.lines(spark, sf_dir), K), group="country").select("country", "day", "sales")


@register("w8_split_sizes", "W8", V.sql("SELECT country, split, count(*) AS rows FROM panel GROUP BY 1, 2",
                                        SALES_LINES_SQL, V.panel_sql(K)))
def w8_split_sizes(spark, sf_dir):
    return W.split_sizes(panel(spark, sf_dir), K)


@register("w8_split_trend", "W8", V.sql("SELECT day, sales, split FROM panel", SALES_LINES_SQL, V.panel_sql(())))
def w8_split_trend(spark, sf_dir):
    return W.split_trend(panel(spark, sf_dir, ()))


@register("w7_split_fixed_dates", "W7", V.sql("""
SELECT day, sales, CASE WHEN day <= DATE '2000-06-30' THEN 'train' WHEN day <= DATE '2000-12-31' THEN 'validation'
                        ELSE 'test' END AS split
FROM panel_filled WHERE day <= DATE '2001-06-30'""", SALES_LINES_SQL, V.panel_sql(())))
def w7_split_fixed_dates(spark, sf_dir):
    filled = W.gap_fill(A.daily_sales(V.lines(spark, sf_dir)))
    return W.split_by_date(filled, train_end="2000-06-30", val_end="2000-12-31", test_end="2001-06-30") \
        .select("day", "sales", "split")


@register("f6_future_frame", "F6", V.sql("""
, last AS (SELECT country, max(day) AS last_day FROM panel GROUP BY 1)
SELECT country, CAST(unnest(generate_series(last_day + 1, last_day + 30, INTERVAL 1 DAY)) AS DATE) AS day FROM last
""", SALES_LINES_SQL, V.panel_sql(K)))
def f6_future_frame(spark, sf_dir):
    return W.future_frame(panel(spark, sf_dir), 30, K)


@register("w13_before_after", "W13, H1", V.sql("""
, u AS (SELECT 'before' AS state, CAST(sales AS DOUBLE) AS sales FROM sales_lines
        UNION ALL SELECT 'after', CAST(sales AS DOUBLE) FROM sales_lines WHERE quantity > 0),
b AS (SELECT min(sales) AS lo, max(sales) AS hi FROM u),
h AS (SELECT state, CAST(least(floor((sales - lo) / ((hi - lo) / 50)), 49) AS INTEGER) AS bin FROM u, b)
SELECT state, bin, count(*) AS count FROM h GROUP BY 1, 2""", SALES_LINES_SQL))
def w13_before_after(spark, sf_dir):
    from ..operators.dist import histogram
    lines = V.lines(spark, sf_dir).withColumn("sales", F.col("sales").cast("double"))
    both = W.before_after(lines, lines.where(F.col("quantity") > 0), ["sales"])
    return histogram(both, "sales", 50, by=["state"]).select("state", "bin", "count")
