import os
import tempfile

import pytest
from pyspark.sql import functions as F

from mercato.sources import files as Fs
from mercato.sources import sales_lines
from mercato.streaming.daily import daily_sales_stream, read_line_stream
from tests.conftest import SF_SMALL


def test_csv_roundtrip_and_checks(spark):
    d = tempfile.mkdtemp(prefix="mercato-csv-")
    lines = sales_lines(spark, SF_SMALL).withColumn("sales", F.col("sales").cast("double"))
    path = os.path.join(d, "lines.csv")
    Fs.write_sales_csv(lines, path)
    back = Fs.read_sales(spark, path)
    assert back.count() == lines.count()
    assert back.where("invoice_date is null").count() == 0
    with pytest.raises(ValueError):
        Fs.read_sales(spark, os.path.join(d, "missing.csv"))
    with pytest.raises(ValueError):
        Fs.read_sales(spark, os.path.join(d, "lines.txt"))


def test_csv_quotes_commas_and_accents(spark):
    d = tempfile.mkdtemp(prefix="mercato-csv-")
    path = os.path.join(d, "q.csv")
    rows = [(1, 'BOX, "LARGE" RED'), (2, "café à l'eau"), (3, 'a "b"')]
    lines = sales_lines(spark, SF_SMALL).limit(1).drop("description", "invoice_no") \
        .crossJoin(spark.createDataFrame(rows, "invoice_no long, description string"))
    Fs.write_sales_csv(lines.withColumn("sales", F.col("sales").cast("double")), path)
    back = {int(r["invoice_no"]): r["description"] for r in Fs.read_sales(spark, path).collect()}
    assert back == dict(rows)


def test_json_roundtrip(spark):
    df = spark.createDataFrame([(1, 2.5, "x")], "a long, b double, c string")
    assert Fs.from_json_rows(Fs.to_json_rows(df), df.schema).collect() == df.collect()


def test_stream_daily_sales_matches_batch(spark):
    d = tempfile.mkdtemp(prefix="mercato-stream-")
    lines = sales_lines(spark, SF_SMALL).select("invoice_date", "country", F.col("sales").cast("double"))
    lines.write.mode("overwrite").parquet(os.path.join(d, "in"))
    stream = read_line_stream(spark, os.path.join(d, "in"), lines.schema, max_files_per_trigger=100)
    q = daily_sales_stream(stream).writeStream.outputMode("update").format("memory") \
        .queryName("daily_stream_test").start()
    q.processAllAvailable()
    q.stop()
    got = spark.sql("select day, max(sales) as sales from daily_stream_test group by day")
    batch = lines.groupBy(F.to_date("invoice_date").alias("day")).agg(F.sum("sales").alias("sales"))
    diff = got.join(batch, "day").where(F.abs(got.sales - batch.sales) > 1e-6)
    assert got.count() == batch.count() and diff.count() == 0
