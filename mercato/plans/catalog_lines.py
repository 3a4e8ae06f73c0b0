"""Catalog: line view, cleaning and customer roll-up (S1, C*, A10-A12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clean as C
from ..operators import customers as K
from ..sources import EVENT_TEXT_DATES_SQL, SALES_LINES_SQL, event_text_dates
from . import views as V
from .registry import register

CUSTOMER_FEATURES_SQL = V.sql("""
, per AS (
  SELECT customer_id, count(invoice_date) AS n_lines, CAST(sum(sales) AS DOUBLE) AS total,
         max(invoice_date) AS last_ts, count(DISTINCT stock_code) AS n_products
  FROM clean_customers GROUP BY customer_id
), ref AS (SELECT max(last_ts) AS ref_ts FROM per)
SELECT customer_id, n_lines, total AS total_spent,
       CAST(floor((epoch_us(ref_ts) - epoch_us(last_ts)) / 86400000000.0) AS INTEGER) AS recency_days,
       n_products, total / n_lines AS avg_ticket
FROM per, ref
""", V.CLEAN_CUSTOMERS_SQL)


@register("a10_customer_features", "A10, A11, A12, C17, C3", CUSTOMER_FEATURES_SQL)
def a10_customer_features(spark, sf_dir):
    return K.customer_features(V.clean_customers(spark, sf_dir))


@register("s1_sales_lines", "S1", V.sql("SELECT * FROM sales_lines", SALES_LINES_SQL).replace(
    "SELECT * FROM sales_lines",
    "SELECT invoice_no, line_no, row_key, stock_code, description, quantity, unit_price, "
    "CAST(sales AS DOUBLE) AS sales, invoice_date, customer_id, country FROM sales_lines"))
def s1_sales_lines(spark, sf_dir):
    return V.lines(spark, sf_dir).withColumn("sales", F.col("sales").cast("double"))


@register("c1_cleaning_stats", "C1", V.sql("""
SELECT 'before' AS stage, count(*) AS n_rows,
       CAST(sum((invoice_no IS NULL)::INT + (line_no IS NULL)::INT + (row_key IS NULL)::INT
          + (stock_code IS NULL)::INT + (description IS NULL)::INT + (quantity IS NULL)::INT
          + (unit_price IS NULL)::INT + (sales IS NULL)::INT + (invoice_date IS NULL)::INT
          + (customer_id IS NULL)::INT + (country IS NULL)::INT) AS BIGINT) AS null_cells
FROM sales_lines
UNION ALL
SELECT 'after', count(*),
       CAST(sum((invoice_no IS NULL)::INT + (line_no IS NULL)::INT + (row_key IS NULL)::INT
          + (stock_code IS NULL)::INT + (description IS NULL)::INT + (quantity IS NULL)::INT
          + (unit_price IS NULL)::INT + (sales IS NULL)::INT + (invoice_date IS NULL)::INT
          + (customer_id IS NULL)::INT + (country IS NULL)::INT + (year IS NULL)::INT
          + (month IS NULL)::INT + (quarter IS NULL)::INT + (day_of_week IS NULL)::INT
          + (hour IS NULL)::INT) AS BIGINT)
FROM clean_customers
""", V.CLEAN_CUSTOMERS_SQL))
def c1_cleaning_stats(spark, sf_dir):
    before = V.lines(spark, sf_dir)
    return C.cleaning_stats(before, C.clean(before, variant="customers"))


@register("c2_filter_returns", "C2", V.sql("""
SELECT row_key, quantity, CAST(sales AS DOUBLE) AS sales FROM sales_lines WHERE quantity > 0
""", SALES_LINES_SQL))
def c2_filter_returns(spark, sf_dir):
    return C.filter_returns(V.lines(spark, sf_dir), keep=False) \
        .select("row_key", "quantity", F.col("sales").cast("double").alias("sales"))


@register("c3_drop_missing_key", "C3", V.sql("""
SELECT row_key, customer_id FROM sales_lines WHERE customer_id IS NOT NULL
""", SALES_LINES_SQL))
def c3_drop_missing_key(spark, sf_dir):
    return C.drop_missing_key(V.lines(spark, sf_dir)).select("row_key", "customer_id")


@register("c4_impute_median", "C4, C17", V.sql("""
SELECT row_key, customer_id FROM clean_sales
""", V.CLEAN_SALES_SQL))
def c4_impute_median(spark, sf_dir):
    return C.impute_median(V.lines(spark, sf_dir), ["customer_id", "quantity", "unit_price"]) \
        .select("row_key", "customer_id")


@register("c5_line_total", "C5", V.sql("""
SELECT row_key, round(COALESCE(quantity * unit_price, 0), 4) AS line_total FROM sales_lines
""", SALES_LINES_SQL))
def c5_line_total(spark, sf_dir):
    df = V.lines(spark, sf_dir).drop("sales")
    return C.add_line_total(df, out="line_total").select("row_key", F.round("line_total", 4).alias("line_total"))


@register("c6_parse_time", "C6", V.sql("""
SELECT event_id, invoice_date_text,
       try_strptime(invoice_date_text, '%Y-%m-%d %H:%M:%S') AS invoice_date
FROM event_text_dates
""", EVENT_TEXT_DATES_SQL))
def c6_parse_time(spark, sf_dir):
    df = event_text_dates(spark, sf_dir).withColumn("invoice_date", F.col("invoice_date_text"))
    return C.to_timestamp_column(df).withColumn("invoice_date", F.col("invoice_date").cast("timestamp_ntz")) \
        .select("event_id", "invoice_date_text", "invoice_date")


@register("c7_calendar_parts", "C7, C17", V.sql("""
SELECT row_key, year, month, quarter, day_of_week, hour FROM clean_customers
""", V.CLEAN_CUSTOMERS_SQL))
def c7_calendar_parts(spark, sf_dir):
    return V.clean_customers(spark, sf_dir).select("row_key", "year", "month", "quarter", "day_of_week", "hour")


@register("c8_day_month_labels", "C8", V.sql("""
SELECT row_key, dayname(invoice_date) AS day_name, strftime(invoice_date, '%Y-%m') AS year_month
FROM sales_lines
""", SALES_LINES_SQL))
def c8_day_month_labels(spark, sf_dir):
    return C.add_labels(V.lines(spark, sf_dir)).select("row_key", "day_name", "year_month")


@register("c9_c10_log_roundtrip", "C9, C10", V.sql("""
SELECT row_key, round(ln(1 + CAST(sales AS DOUBLE)), 6) AS log_sales,
       round(exp(ln(1 + CAST(sales AS DOUBLE))) - 1, 4) AS sales_back
FROM sales_lines WHERE sales > 0
""", SALES_LINES_SQL))
def c9_c10_log_roundtrip(spark, sf_dir):
    df = V.lines(spark, sf_dir).where(F.col("sales") > 0)
    df = C.add_log(df).withColumn("sales_back", F.col("log_sales"))
    df = C.inverse_log(df, ["sales_back"])
    return df.select("row_key", F.round("log_sales", 6).alias("log_sales"),
                     F.round("sales_back", 4).alias("sales_back"))


@register("c15_trim_extremes", "C15", V.sql("""
, q AS (SELECT quantile_cont(quantity, 0.99) AS q_qty, quantile_cont(unit_price, 0.99) AS q_price,
             quantile_cont(CAST(sales AS DOUBLE), 0.99) AS q_sales FROM sales_lines)
SELECT row_key, quantity, unit_price, CAST(sales AS DOUBLE) AS sales
FROM sales_lines, q WHERE quantity > 0 AND quantity < q_qty AND unit_price > 0 AND unit_price < q_price
  AND sales > 0 AND CAST(sales AS DOUBLE) < q_sales AND country IS NOT NULL
""", SALES_LINES_SQL))
def c15_trim_extremes(spark, sf_dir):
    df = V.lines(spark, sf_dir).withColumn("sales", F.col("sales").cast("double"))
    return C.trim_extremes(df, ["quantity", "unit_price", "sales"]).select("row_key", "quantity", "unit_price", "sales")


@register("c16_filter_country", "C16", V.sql("""
SELECT row_key, country, CAST(sales AS DOUBLE) AS sales FROM sales_lines WHERE country = 'NATION_7'
""", SALES_LINES_SQL))
def c16_filter_country(spark, sf_dir):
    return C.filter_country(V.lines(spark, sf_dir), "NATION_7") \
        .select("row_key", "country", F.col("sales").cast("double").alias("sales"))


@register("c17_clean_sales", "C17, C4, C5, C7", V.sql("""
SELECT row_key, customer_id, CAST(sales AS DOUBLE) AS sales, year, month, quarter, day_of_week, hour
FROM clean_sales
""", V.CLEAN_SALES_SQL))
def c17_clean_sales(spark, sf_dir):
    return V.clean_sales(spark, sf_dir).select("row_key", "customer_id", F.col("sales").cast("double").alias("sales"),
                                               "year", "month", "quarter", "day_of_week", "hour")
