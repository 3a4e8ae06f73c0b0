"""Catalog: aggregations."""

from __future__ import annotations

from ..operators import aggregates as A
from ..sources import EVENT_LINES_SQL, SALES_LINES_SQL, event_lines, read_table
from . import views as V
from .registry import register


@register("a1_daily_sales", "A1", V.sql("""
SELECT CAST(invoice_date AS DATE) AS day, CAST(sum(sales) AS DOUBLE) AS sales FROM sales_lines GROUP BY 1
""", SALES_LINES_SQL))
def a1_daily_sales(spark, sf_dir):
    return A.daily_sales(V.lines(spark, sf_dir))


@register("a1_daily_sales_by_country", "A1", V.sql("""
SELECT country, CAST(invoice_date AS DATE) AS day, CAST(sum(sales) AS DOUBLE) AS sales
FROM sales_lines GROUP BY 1, 2
""", SALES_LINES_SQL))
def a1_daily_sales_by_country(spark, sf_dir):
    return A.daily_sales(V.lines(spark, sf_dir), keys=["country"])


@register("a2_monthly_sales", "A2, C8", V.sql("""
SELECT strftime(invoice_date, '%Y-%m') AS year_month, CAST(sum(sales) AS DOUBLE) AS sales FROM sales_lines GROUP BY 1
""", SALES_LINES_SQL))
def a2_monthly_sales(spark, sf_dir):
    return A.monthly_sales(V.lines(spark, sf_dir))


@register("a3_sales_by_country", "A3", V.sql("""
SELECT country, CAST(sum(sales) AS DOUBLE) AS sales FROM sales_lines GROUP BY 1
""", SALES_LINES_SQL))
def a3_sales_by_country(spark, sf_dir):
    return A.sales_by_country(V.lines(spark, sf_dir))


@register("a3_positive_sales_by_country", "A3", V.sql("""
SELECT country, CAST(sum(sales) AS DOUBLE) AS sales FROM sales_lines GROUP BY 1 HAVING sum(sales) > 0
""", SALES_LINES_SQL))
def a3_positive_sales_by_country(spark, sf_dir):
    return A.sales_by_country(V.lines(spark, sf_dir), positive_only=True)


@register("a4_top_countries", "A4, W12", V.sql("""
SELECT country, CAST(sum(sales) AS DOUBLE) AS sales FROM sales_lines GROUP BY 1
ORDER BY sum(sales) DESC, country LIMIT 10
""", SALES_LINES_SQL))
def a4_top_countries(spark, sf_dir):
    return A.top_countries(V.lines(spark, sf_dir), 10)


@register("a5_sales_flow", "A5", V.sql("""
SELECT country AS source, customer_id AS target, CAST(sum(sales) AS DOUBLE) AS value
FROM sales_lines WHERE customer_id IS NOT NULL GROUP BY 1, 2
""", SALES_LINES_SQL))
def a5_sales_flow(spark, sf_dir):
    return A.sales_flow(V.lines(spark, sf_dir))


@register("a6_sales_per_customer", "A6", V.sql("""
SELECT customer_id, CAST(sum(sales) AS DOUBLE) AS sales FROM sales_lines
WHERE customer_id IS NOT NULL GROUP BY 1
""", SALES_LINES_SQL))
def a6_sales_per_customer(spark, sf_dir):
    return A.sales_per_customer(V.lines(spark, sf_dir))


@register("a7_sales_by_weekday", "A7, C7, C8", V.sql("""
SELECT CAST(isodow(invoice_date) - 1 AS INTEGER) AS day_of_week, dayname(invoice_date) AS day_name,
       CAST(sum(sales) AS DOUBLE) AS sales
FROM sales_lines GROUP BY 1, 2
""", SALES_LINES_SQL))
def a7_sales_by_weekday(spark, sf_dir):
    return A.sales_by_weekday(V.lines(spark, sf_dir))


@register("a8_sales_by_month_country", "A8", V.sql("""
SELECT strftime(invoice_date, '%Y-%m') AS year_month, country, CAST(sum(sales) AS DOUBLE) AS sales
FROM sales_lines GROUP BY 1, 2
""", SALES_LINES_SQL))
def a8_sales_by_month_country(spark, sf_dir):
    return A.sales_by_month_country(V.lines(spark, sf_dir))


_HOUR_COLS = ", ".join(f"round(COALESCE(sum(sales) FILTER (WHERE hour(invoice_date) = {h}), 0), 6) AS h{h:02d}"
                       for h in range(24))


@register("a9_hour_day_pivot", "A9, C8", V.sql(f"""
SELECT dayname(invoice_date) AS day_name, {_HOUR_COLS} FROM event_lines GROUP BY 1
""", EVENT_LINES_SQL))
def a9_hour_day_pivot(spark, sf_dir):
    from pyspark.sql import functions as F
    out = A.hour_day_pivot(event_lines(spark, sf_dir))
    return out.select("day_name", *[F.round(f"h{h:02d}", 6).alias(f"h{h:02d}") for h in range(24)])


@register("a13_distinct_countries", "A13", V.sql("""
SELECT DISTINCT country FROM sales_lines WHERE country IS NOT NULL
""", SALES_LINES_SQL))
def a13_distinct_countries(spark, sf_dir):
    return A.distinct_countries(V.lines(spark, sf_dir))


@register("a15_word_counts", "A15", r"""
SELECT word, count(*) AS n
FROM (SELECT unnest(regexp_extract_all(lower(text), '\w[\w'']+', 0)) AS word FROM documents)
GROUP BY word
""")
def a15_word_counts(spark, sf_dir):
    return A.word_counts(read_table(spark, sf_dir, "documents", ["text"]), "text")


@register("a15_top_words", "A15, W12", r"""
SELECT word, count(*) AS n
FROM (SELECT unnest(regexp_extract_all(lower(text), '\w[\w'']+', 0)) AS word FROM documents)
GROUP BY word ORDER BY n DESC, word LIMIT 200
""")
def a15_top_words(spark, sf_dir):
    return A.top_words(read_table(spark, sf_dir, "documents", ["text"]), "text", 200)


@register("a15_description_words", "A15", r"""
WITH sl AS (SELECT p.p_name AS description FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
            JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
            JOIN part p ON l.l_partkey = p.p_partkey)
SELECT word, count(*) AS n
FROM (SELECT unnest(regexp_extract_all(lower(description), '\w[\w'']+', 0)) AS word FROM sl)
GROUP BY word
""")
def a15_description_words(spark, sf_dir):
    return A.word_counts(V.lines(spark, sf_dir), "description")
