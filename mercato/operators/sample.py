"""Deterministic sampling and top-k.

Rows are ranked by an md5 of their key and a seed, which both Spark and the
SQL oracle compute identically, instead of a random number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sample_hash(key: Sequence[str] | str, seed: int = 42) -> Column:
    keys = [key] if isinstance(key, str) else list(key)
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))


def sample_cap(df: DataFrame, n: int, key: Sequence[str] | str, seed: int = 42) -> DataFrame:
    """At most ``n`` rows, the same ones on every run.

    Planned as a top-n per partition followed by one merge of at most
    ``partitions × n`` rows (TakeOrderedAndProject)."""
    return df.withColumn("_h", sample_hash(key, seed)).orderBy("_h").limit(n).drop("_h")


def stratified_sample(df: DataFrame, label: str, n: int, key: Sequence[str] | str, seed: int = 42) -> DataFrame:
    """Per label ``max(1, int(share × n))`` rows, at most the label's size (W11). A NULL label is one like any other.

    Quotas are a table of one row per label, joined to the rows that are left
    after ``row_number <= max(1, n)``, which no quota exceeds: with that filter
    Spark cuts every input partition to that many rows per label before the
    shuffle (WindowGroupLimit), so a label that holds a third of all rows never
    reaches one task whole. Nothing is collected, and the plan has the same
    size for any number of labels.
    """
    from .joins import broadcast_if_small
    counts = df.groupBy(F.col(label).alias("_label")).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n").alias("_total"))
    quotas = counts.crossJoin(F.broadcast(total)).select(
        "_label", F.least(F.col("_n"), F.greatest(F.lit(1), F.floor(F.col("_n") / F.col("_total") * n))).alias("_quota"))
    w = Window.partitionBy(label).orderBy("_h")
    ranked = df.withColumn("_h", sample_hash(key, seed)).withColumn("_rn", F.row_number().over(w)) \
        .where(F.col("_rn") <= max(1, n))
    return ranked.join(broadcast_if_small(quotas), F.col(label).eqNullSafe(F.col("_label"))) \
        .where(F.col("_rn") <= F.col("_quota")).drop("_h", "_rn", "_label", "_quota")


def top_k(df: DataFrame, n: int, order: Sequence[Column | str]) -> DataFrame:
    """Sorted first ``n`` rows (W12, A4); TakeOrderedAndProject."""
    return df.orderBy(*order).limit(n)
