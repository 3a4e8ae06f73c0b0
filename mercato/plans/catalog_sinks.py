"""Catalog: stage sinks and re-reads (S2-S7), written under the session's
checkpoint folder and read back, so what is checked is what was written."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..sources import files as Fs
from ..session import stage_path
from ..sources import SALES_LINES_SQL
from . import views as V
from .registry import register


def _fresh(spark, name):
    return stage_path(spark, f"{name}-{uuid.uuid4().hex[:8]}")


@register("s3_clean_stage_roundtrip", "S3, S2, C17", V.sql("""
SELECT year, month, count(*) AS n_lines, CAST(sum(sales) AS DOUBLE) AS sales FROM clean_customers
WHERE year = 1998 GROUP BY 1, 2""", V.CLEAN_CUSTOMERS_SQL))
def s3_clean_stage_roundtrip(spark, sf_dir):
    path = _fresh(spark, "clean")
    Fs.write_clean(V.clean_customers(spark, sf_dir), path)
    back = Fs.read_stage(spark, path).where(F.col("year") == 1998)  # partition pruning on year=1998
    return back.groupBy("year", "month").agg(F.count(F.lit(1)).alias("n_lines"),
                                             F.sum("sales").cast("double").alias("sales"))


@register("s4_customers_stage_roundtrip", "S4, S2, A10", V.sql("SELECT * FROM customers", V.CUSTOMERS_SQL))
def s4_customers_stage_roundtrip(spark, sf_dir):
    path = _fresh(spark, "customers")
    Fs.write_table(V.customers(spark, sf_dir), path)
    return Fs.read_stage(spark, path)


@register("s6_customers_json", "S6", V.sql("SELECT * FROM customers", V.CUSTOMERS_SQL))
def s6_customers_json(spark, sf_dir):
    cust = V.customers(spark, sf_dir)
    return Fs.from_json_rows(Fs.to_json_rows(cust), cust.schema)


@register("s5_assignments_stage", "S5, G1, J1")
def s5_assignments_stage(spark, sf_dir):
    from .flagship import segments
    path = _fresh(spark, "assignments")
    Fs.write_table(segments(spark, sf_dir), path)
    return Fs.read_stage(spark, path)


@register("s7_report_tables", "S7, E7, W8, A14")
def s7_report_tables(spark, sf_dir):
    from ..operators import explore as E
    from ..operators.forecast.panel import build_panel
    from ..operators.series import split_sizes
    from .flagship import segment_summary
    tables = {"shape": E.shape(V.lines(spark, sf_dir)),
              "split_sizes": split_sizes(build_panel(V.lines(spark, sf_dir))),
              "segment_summary": segment_summary(spark, sf_dir)}
    paths = Fs.write_report_tables(tables, _fresh(spark, "report"))
    out = None
    for name, p in paths.items():
        part = spark.createDataFrame([(name,)], "table string") \
            .crossJoin(Fs.read_stage(spark, p).agg(F.count(F.lit(1)).alias("rows")))
        out = part if out is None else out.unionByName(part)
    return out


@register("s1_csv_roundtrip", "S1, C6", V.sql("""
SELECT CAST(invoice_no AS VARCHAR) AS invoice_no, CAST(stock_code AS VARCHAR) AS stock_code, description, quantity,
       invoice_date, unit_price, customer_id, country FROM sales_lines""", SALES_LINES_SQL))
def s1_csv_roundtrip(spark, sf_dir):
    path = _fresh(spark, "lines") + ".csv"
    Fs.write_sales_csv(V.lines(spark, sf_dir).withColumn("sales", F.col("sales").cast("double")), path)
    return Fs.read_sales(spark, path)
