"""Transaction CSV input and stage-table sinks.

The CSV reader uses an explicit schema (no inference pass over the data) and
maps the reference's column names onto the engine's line columns. Stage
tables are parquet; the cleaned lines are partitioned by year and month so a
date filter reads only the matching folders.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from ..functions.scalar import parse_time

# The transactions file's header (input names) and the line
# columns they become.
CSV_COLUMNS = {
    "InvoiceNo": "invoice_no",
    "StockCode": "stock_code",
    "Description": "description",
    "Quantity": "quantity",
    "InvoiceDate": "invoice_date",
    "UnitPrice": "unit_price",
    "CustomerID": "customer_id",
    "Country": "country",
}

CSV_SCHEMA = StructType([
    StructField("InvoiceNo", StringType()),
    StructField("StockCode", StringType()),
    StructField("Description", StringType()),
    StructField("Quantity", DoubleType()),
    StructField("InvoiceDate", StringType()),
    StructField("UnitPrice", DoubleType()),
    StructField("CustomerID", DoubleType()),
    StructField("Country", StringType()),
])

DATE_FORMATS = ("M/d/yyyy H:mm", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd H:mm")


def read_sales(spark: SparkSession, path: str, encoding: str = "ISO-8859-1",
               date_formats=DATE_FORMATS, schema: StructType = CSV_SCHEMA) -> DataFrame:
    """Transactions CSV → line table (S1). The path must exist and end in
    ``.csv`` (a folder of part files named ``*.csv`` is accepted); otherwise
    a ``ValueError`` names the problem. A quote inside a quoted field is
    doubled. Unparseable dates become NULL."""
    if not path.lower().rstrip("/").endswith(".csv"):
        raise ValueError(f"{path!r} is not a .csv path")
    try:
        raw = spark.read.csv(path, header=True, schema=schema, encoding=encoding, mode="PERMISSIVE",
                             quote='"', escape='"')
    except AnalysisException as e:
        raise ValueError(f"{path!r} does not exist or cannot be read") from e
    out = raw.select(*[F.col(src).alias(dst) for src, dst in CSV_COLUMNS.items()])
    when = F.coalesce(*[parse_time("invoice_date", f) for f in date_formats])
    return out.withColumn("invoice_date", when) \
        .withColumn("customer_id", F.col("customer_id").cast("long"))


def write_sales_csv(df: DataFrame, path: str, encoding: str = "ISO-8859-1") -> None:
    """Line table → transactions CSV with the header and encoding that ``read_sales`` expects."""
    back = {v: k for k, v in CSV_COLUMNS.items()}
    out = df.select(*[F.col(c).alias(back[c]) for c in CSV_COLUMNS.values()]) \
        .withColumn("InvoiceDate", F.date_format("InvoiceDate", "yyyy-MM-dd HH:mm:ss"))
    out.write.mode("overwrite").csv(path, header=True, encoding=encoding, quote='"', escape='"')


def write_clean(df: DataFrame, path: str, partition_by=("year", "month")) -> None:
    """Cleaned lines as parquet partitioned by year and month (S3)."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Customers (S4), assignments with their key (S5), report tables."""
    df.write.mode("overwrite").format(fmt).save(path)


def read_stage(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Re-read a stage table written earlier."""
    return spark.read.format(fmt).load(path)


def to_json_rows(df: DataFrame) -> DataFrame:
    """Rows as JSON text, one document per row."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("json"))


def from_json_rows(df: DataFrame, schema, col: str = "json") -> DataFrame:
    """JSON text back to columns with a known schema."""
    return df.select(F.from_json(col, schema).alias("_r")).select("_r.*")


def write_report_tables(tables: Mapping[str, DataFrame], folder: str, fmt: str = "parquet") -> dict[str, str]:
    """Each named report table to ``folder/name``."""
    paths = {}
    for name, df in tables.items():
        p = f"{folder.rstrip('/')}/{name}"
        write_table(df, p, fmt)
        paths[name] = p
    return paths
