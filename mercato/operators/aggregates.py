"""Aggregations of invoice lines.

All are ``groupBy`` plans: Spark combines map-side before the shuffle, so a
key that holds a third of the lines costs one row per map task, not a third
of the data in one task. Money columns are summed exactly (decimal) and cast
to double at the end.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as S


def _sum_money(c: str = "sales", alias: str = "sales"):
    return F.sum(c).cast("double").alias(alias)


def daily_sales(df: DataFrame, keys: Sequence[str] = (), ts: str = "invoice_date", amount: str = "sales") -> DataFrame:
    """Sales per calendar day, per key (A1)."""
    return df.groupBy(*keys, F.to_date(ts).alias("day")).agg(_sum_money(amount))


def monthly_sales(df: DataFrame, keys: Sequence[str] = (), ts: str = "invoice_date", amount: str = "sales") -> DataFrame:
    """Sales per ``yyyy-MM`` month (A2)."""
    return df.groupBy(*keys, S.year_month(ts).alias("year_month")).agg(_sum_money(amount))


def sales_by_country(df: DataFrame, positive_only: bool = False, amount: str = "sales") -> DataFrame:
    """Sales per country (A3); ``positive_only`` keeps countries whose total
    is above 0 (the map variant)."""
    out = df.groupBy("country").agg(_sum_money(amount))
    return out.where(F.col("sales") > 0) if positive_only else out


def top_countries(df: DataFrame, n: int = 10, amount: str = "sales") -> DataFrame:
    """The n countries with the highest sales (A4), ties by name."""
    return sales_by_country(df, amount=amount).orderBy(F.desc("sales"), F.asc("country")).limit(n)


def sales_flow(df: DataFrame, source: str = "country", target: str = "customer_id", amount: str = "sales") -> DataFrame:
    """Weighted edges source → target (A5), the Sankey table."""
    return df.where(F.col(source).isNotNull() & F.col(target).isNotNull()) \
        .groupBy(F.col(source).alias("source"), F.col(target).alias("target")).agg(_sum_money(amount, "value"))


def sales_per_customer(df: DataFrame, key: str = "customer_id", amount: str = "sales") -> DataFrame:
    """Sales per customer (A6); NULL customers are not a customer."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(_sum_money(amount))


def sales_by_weekday(df: DataFrame, ts: str = "invoice_date", amount: str = "sales") -> DataFrame:
    """Sales per day of week, Monday = 0."""
    return df.groupBy(S.weekday0(ts).alias("day_of_week"), S.day_name(ts).alias("day_name")) \
        .agg(_sum_money(amount))


def sales_by_month_country(df: DataFrame, ts: str = "invoice_date", amount: str = "sales") -> DataFrame:
    """Sales per (month, country), the animation frames."""
    return df.groupBy(S.year_month(ts).alias("year_month"), "country").agg(_sum_money(amount))


HOURS = list(range(24))


def hour_day_pivot(df: DataFrame, ts: str = "invoice_date", amount: str = "sales") -> DataFrame:
    """Sales by day name × hour of day, empty cells 0.

    The 24 hour values are given, so the pivot needs no extra pass to find
    them; output columns are ``h00`` … ``h23``."""
    base = df.select(S.day_name(ts).alias("day_name"), F.hour(ts).alias("_hour"), F.col(amount).alias("_v"))
    piv = base.groupBy("day_name").pivot("_hour", HOURS).agg(F.sum("_v"))
    return piv.select("day_name", *[F.coalesce(F.col(str(h)).cast("double"), F.lit(0.0)).alias(f"h{h:02d}")
                                    for h in HOURS])


def distinct_countries(df: DataFrame, c: str = "country") -> DataFrame:
    """Sorted list of countries."""
    return df.select(c).where(F.col(c).isNotNull()).distinct().orderBy(c)


# Fixed value: the token pattern of the word-cloud corpus (a word character
# followed by at least one word character or apostrophe).
WORD_PATTERN = r"\w[\w']+"


def word_counts(df: DataFrame, text: str, pattern: str = WORD_PATTERN,
                stopwords: Sequence[str] = ()) -> DataFrame:
    """Lower-cased word frequencies over whole texts.

    Each text is tokenised in place (``regexp_extract_all``), exploded and
    counted; the partial aggregation collapses frequent words map-side."""
    words = df.select(F.explode(F.regexp_extract_all(F.lower(F.col(text)), F.lit(pattern), 0)).alias("word"))
    if stopwords:
        words = words.where(~F.col("word").isin(list(stopwords)))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def top_words(df: DataFrame, text: str, n: int = 200, **kw) -> DataFrame:
    """The n most frequent words, ties alphabetical (the cloud's vocabulary)."""
    return word_counts(df, text, **kw).orderBy(F.desc("n"), F.asc("word")).limit(n)
