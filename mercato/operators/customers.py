"""One row per customer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..session import checkpoint_dir

FEATURES = ("avg_ticket", "n_lines", "total_spent", "recency_days", "n_products")


def product_column(df: DataFrame) -> str:
    """``stock_code`` when present, else ``description``."""
    return "stock_code" if "stock_code" in df.columns else "description"


def customer_features(df: DataFrame, key: str = "customer_id", ts: str = "invoice_date",
                      amount: str = "sales", written: bool = False) -> DataFrame:
    """n_lines, total_spent, recency_days, n_products, avg_ticket per customer (A10).

    One aggregation keyed on the customer; ``countDistinct`` makes Catalyst
    aggregate on (customer, product) first, so a customer with a third of all
    lines is still spread over many tasks in the first stage and arrives
    pre-combined in the second. Recency is measured against the latest line
    of the whole table, which equals the latest of the per-customer maxima:
    that one-row frame is taken from the aggregated rows and broadcast. With
    ``written`` they are written once (reliable checkpoint); in one lazy plan
    column pruning makes the two reads differ, and the lines are joined twice.
    """
    prod = product_column(df)
    lines = df.where(F.col(key).isNotNull())
    per = lines.groupBy(key).agg(
        F.count(ts).alias("n_lines"),
        F.sum(amount).alias("_total"),
        F.max(ts).alias("_last"),
        F.countDistinct(prod).alias("n_products"),
    )
    if written:
        checkpoint_dir(df.sparkSession)
        per = per.checkpoint(eager=True)
    ref = per.agg(F.max("_last").alias("_ref"))
    out = per.crossJoin(F.broadcast(ref))
    total = F.col("_total").cast("double")
    return out.select(
        key,
        "n_lines",
        total.alias("total_spent"),
        S.elapsed_days("_last", "_ref").alias("recency_days"),
        "n_products",
        S.safe_div(total, F.col("n_lines").cast("double")).alias("avg_ticket"),
    )
