"""Readers for the star-schema test tables and the flat invoice-line view.

The engine works on one *line table*: one row per invoice line with the columns
``invoice_no, line_no, row_key, stock_code, description, quantity, unit_price,
sales, invoice_date, customer_id, country``. ``sales_lines`` derives it from the
normalised tables; ``read_sales`` (csv.py) reads it from a transactions CSV.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Column metadata key: the column is known to hold no NULLs.
NULL_FREE = "mercato.null_free"

LINE_COLUMNS = ("invoice_no", "line_no", "row_key", "stock_code", "description", "quantity",
                "unit_price", "sales", "invoice_date", "customer_id", "country")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


#: By application and path: what is known of a source table (schema, row count, no NULLs in what it is asked for).
_FOOTERS: dict[tuple[str, str], list] = {}


def _footer(spark: SparkSession, path: str) -> list:
    """[schema, row count or None, NULL-free or None] of a source table; source tables do not change while an application runs."""
    key = (spark.sparkContext.applicationId, path)
    if key not in _FOOTERS:
        _FOOTERS[key] = [spark.read.parquet(path).schema, None, None]
    return _FOOTERS[key]


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    path = table_path(sf_dir, name)
    df = spark.read.schema(_footer(spark, path)[0]).parquet(path)
    return df.select(*columns) if columns else df


def table_rows(spark: SparkSession, sf_dir: str, name: str) -> int:
    """Rows of a source table, from file metadata."""
    footer = _footer(spark, table_path(sf_dir, name))
    if footer[1] is None:
        footer[1] = read_table(spark, sf_dir, name).count()
    return footer[1]


def spread(df: DataFrame) -> DataFrame:
    """Give an under-split scan as many tasks as the cluster has cores.

    A file written as a single row group is read by one task, and everything
    up to the first exchange (the broadcast joins and projections of the
    line view) would then run in that task. A scan that already has enough
    splits, as any large table does, is left as it is."""
    target = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(target) if df.rdd.getNumPartitions() < target else df


def row_key(*cols: Column) -> Column:
    """Deterministic hex key of a row, identical in Spark and DuckDB."""
    return F.md5(F.concat_ws("|", *[c.cast("string") for c in cols]))


def sales_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem ⋈ orders ⋈ customer ⋈ nation ⋈ part as invoice lines.

    Join order keeps the big side shuffled as few times as possible: the
    customer dimension is enriched with the nation name first (nation is the
    fixed 25-row TPC-H table, broadcast), orders pick up the country on
    ``custkey``, lineitem meets orders on ``orderkey`` and then part on
    ``partkey``. A dimension is broadcast only when its rows (from file
    metadata) times their width stay in bound (``operators.joins.broadcast_if_small``);
    lineitem never is.
    """
    li = spread(read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                                                        "l_quantity", "l_extendedprice", "l_returnflag"]))
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    cust = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_name"])

    from ..operators.joins import broadcast_if_small
    cust_country = cust.join(F.broadcast(nation), cust.c_nationkey == nation.n_nationkey) \
        .select("c_custkey", "n_name")
    order_country = orders.join(broadcast_if_small(cust_country, rows=table_rows(spark, sf_dir, "customer")),
                                orders.o_custkey == cust_country.c_custkey) \
        .select("o_orderkey", "o_custkey", "o_orderdate", "n_name")
    # lineitem is only ever the streamed side; each dimension is broadcast
    # when its row count (read from the scan's metadata; key joins on the
    # dimension's primary key cannot add rows) is within bound, else it is
    # the per-task hash side of a shuffled join.
    lines = li.join(broadcast_if_small(order_country, rows=table_rows(spark, sf_dir, "orders")), li.l_orderkey == order_country.o_orderkey) \
        .join(broadcast_if_small(part, rows=table_rows(spark, sf_dir, "part")), li.l_partkey == part.p_partkey)

    # Certify quantity and unit price free of NULLs from the source itself, once:
    # the IsNull filter reaches the parquet scan, so row groups whose
    # statistics show no NULLs are skipped and no join is run. The tag rides
    # along as column metadata and lets the cleaner skip its own check.
    footer = _footer(spark, table_path(sf_dir, "lineitem"))
    if footer[2] is None:
        footer[2] = read_table(spark, sf_dir, "lineitem").where(
            "l_quantity IS NULL OR l_extendedprice IS NULL OR l_quantity = 0").isEmpty()
    meta = {NULL_FREE: True} if footer[2] else {}

    is_return = F.col("l_returnflag") == "R"
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    return lines.select(
        F.col("o_orderkey").alias("invoice_no"),
        F.col("l_linenumber").alias("line_no"),
        row_key(F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey"),
                F.col("l_quantity").cast("int")).alias("row_key"),
        F.col("l_partkey").alias("stock_code"),
        F.col("p_name").alias("description"),
        F.when(is_return, -F.col("l_quantity")).otherwise(F.col("l_quantity")).alias("quantity", metadata=meta),
        F.try_divide("l_extendedprice", "l_quantity").alias("unit_price", metadata=meta),
        F.when(is_return, -price).otherwise(price).alias("sales"),
        F.col("o_orderdate").alias("invoice_date"),
        F.when(F.col("o_orderkey") % 4 == 0, F.lit(None).cast("bigint"))
         .otherwise(F.col("o_custkey")).alias("customer_id"),
        F.col("n_name").alias("country"),
    )


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as invoice lines, for the hour-of-day operators."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    return ev.select(
        F.col("event_id").alias("invoice_no"),
        F.col("event_type").alias("stock_code"),
        F.col("value").alias("sales"),
        F.col("ts").alias("invoice_date"),
        F.col("user_id").alias("customer_id"),
    )


def event_text_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timestamps rendered as text with planted unparseable strings (C6 input)."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts"])
    text = F.when(F.col("event_id") % 7 == 0, F.lit("not a date")) \
        .when(F.col("event_id") % 11 == 0, F.lit("2024-13-45 99:00:00")) \
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return ev.select("event_id", text.alias("invoice_date_text"))


# DuckDB text of the same views, used by the SQL oracles. Kept next to the
# Spark definitions so the two stay in step.
SALES_LINES_SQL = """
sales_lines AS (
  SELECT o.o_orderkey AS invoice_no,
         l.l_linenumber AS line_no,
         md5(concat_ws('|', l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey,
                       CAST(l.l_quantity AS INTEGER))) AS row_key,
         l.l_partkey AS stock_code,
         p.p_name AS description,
         CASE WHEN l.l_returnflag = 'R' THEN -l.l_quantity ELSE l.l_quantity END AS quantity,
         l.l_extendedprice / l.l_quantity AS unit_price,
         CASE WHEN l.l_returnflag = 'R' THEN -CAST(l.l_extendedprice AS DECIMAL(18,2))
              ELSE CAST(l.l_extendedprice AS DECIMAL(18,2)) END AS sales,
         o.o_orderdate AS invoice_date,
         CASE WHEN o.o_orderkey % 4 = 0 THEN NULL ELSE o.o_custkey END AS customer_id,
         n.n_name AS country
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN part p ON l.l_partkey = p.p_partkey
)"""

EVENT_LINES_SQL = """
event_lines AS (
  SELECT event_id AS invoice_no, event_type AS stock_code, value AS sales,
         ts AS invoice_date, user_id AS customer_id
  FROM events
)"""

EVENT_TEXT_DATES_SQL = """
event_text_dates AS (
  SELECT event_id,
         CASE WHEN event_id % 7 = 0 THEN 'not a date'
              WHEN event_id % 11 = 0 THEN '2024-13-45 99:00:00'
              ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS invoice_date_text
  FROM events
)"""
