"""Cleaning of invoice lines.

Every function is ``DataFrame -> DataFrame`` and composes with
``DataFrame.transform``. Statistics the cleaner needs (medians, quantiles) are
computed as small one-row frames and attached with a broadcast of that
bounded frame, never collected into driver-side Python values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions import scalar as S
from .rank import exact_quantiles


# -- C1 ---------------------------------------------------------------------
def null_cells(df: DataFrame) -> Column:
    """Total count of NULL cells over all columns, as one aggregate."""
    terms = [F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)) for c in df.columns]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return total.cast("bigint")


def cleaning_stats(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows and NULL cells before and after cleaning."""
    a = before.agg(F.count(F.lit(1)).alias("n_rows"), null_cells(before).alias("null_cells")) \
        .withColumn("stage", F.lit("before"))
    b = after.agg(F.count(F.lit(1)).alias("n_rows"), null_cells(after).alias("null_cells")) \
        .withColumn("stage", F.lit("after"))
    return a.unionByName(b).select("stage", "n_rows", "null_cells")


# -- C2, C3 -----------------------------------------------------------------
def filter_returns(df: DataFrame, keep: bool = True, quantity: str = "quantity") -> DataFrame:
    """Keep returns (negative quantity) or only lines with quantity > 0."""
    return df if keep else df.where(F.col(quantity) > 0)


def drop_missing_key(df: DataFrame, key: str = "customer_id") -> DataFrame:
    """Drop lines without a key."""
    return df.where(F.col(key).isNotNull())


# -- C4 ---------------------------------------------------------------------
def medians(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row, one column per input column: its exact interpolated median."""
    q = exact_quantiles(df, cols, [0.5])
    return q.groupBy().pivot("column", list(cols)).agg(F.first("value"))


def columns_with_nulls(df: DataFrame, cols: Sequence[str]) -> list[str]:
    """Which of ``cols`` hold a NULL. Columns a source certified NULL-free
    (column metadata) are not checked; the rest take one pass whose result
    is one row of flags."""
    from ..sources.tables import NULL_FREE
    cols = [c for c in cols if not df.schema[c].metadata.get(NULL_FREE)]
    if not cols:
        return []
    any_null = F.col(cols[0]).isNull()
    for c in cols[1:]:
        any_null = any_null | F.col(c).isNull()
    row = df.where(any_null).agg(*[F.max(F.col(c).isNull().cast("int")).alias(c) for c in cols]).first()
    return [c for c in cols if row is not None and row[c] == 1]


def impute_median(df: DataFrame, cols: Sequence[str], only_where_null: bool = True, cast: bool = False) -> DataFrame:
    """Fill NULLs of each column with the column's exact median (C4), only
    for columns that hold NULLs, as the reference does.

    A filled column becomes double, since a median can fall between two
    integers; ``cast=True`` makes all ``cols`` double, so that the schema does
    not depend on the rows. The median row is a single row, so broadcasting
    it is safe.
    """
    cols = [c for c in cols if c in df.columns]
    asked = cols
    if only_where_null:
        cols = columns_with_nulls(df, cols)
    if cast:
        df = df.withColumns({c: F.col(c).cast("double") for c in asked})
    if not cols:
        return df
    med = medians(df, cols).select(*[F.col(c).alias(f"_med_{c}") for c in cols])
    out = df.crossJoin(F.broadcast(med))
    for c in cols:
        out = out.withColumn(c, F.coalesce(F.col(c).cast("double"), F.col(f"_med_{c}")))
    return out.drop(*[f"_med_{c}" for c in cols])


# -- C5-C9 ------------------------------------------------------------------
def add_line_total(df: DataFrame, out: str = "sales", quantity: str = "quantity",
                   unit_price: str = "unit_price") -> DataFrame:
    """Line total (C5). When the source already carries an exact total
    (e.g. a decimal amount), only its NULLs are set to 0."""
    if out in df.columns:
        return df.withColumn(out, F.coalesce(F.col(out), F.lit(0).cast(df.schema[out].dataType)))
    return df.withColumn(out, S.line_total(quantity, unit_price))


def to_timestamp_column(df: DataFrame, c: str = "invoice_date", fmt: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """Parse a text time column; bad values become NULL."""
    if isinstance(df.schema[c].dataType, StringType):
        return df.withColumn(c, S.parse_time(c, fmt))
    return df


def add_calendar(df: DataFrame, ts: str = "invoice_date") -> DataFrame:
    """year, month, quarter, day_of_week (Monday = 0), hour."""
    return df.withColumns(S.calendar_columns(ts))


def add_labels(df: DataFrame, ts: str = "invoice_date") -> DataFrame:
    """day_name and year_month labels."""
    return df.withColumns({"day_name": S.day_name(ts), "year_month": S.year_month(ts)})


def add_log(df: DataFrame, c: str = "sales", out: str = "log_sales") -> DataFrame:
    """log1p of a column."""
    return df.withColumn(out, S.log1p(F.col(c).cast("double")))


def inverse_log(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """expm1 on columns that were modelled in log space."""
    return df.withColumns({c: S.expm1(c) for c in cols})


# -- C15, C16 ---------------------------------------------------------------
def trim_extremes(df: DataFrame, cols: Sequence[str], q: float = 0.99, require: Sequence[str] = ("country",)) -> DataFrame:
    """Keep rows where every column is > 0 and below its q-quantile, and the
    ``require`` columns are present (C15). Quantiles are taken over all
    rows, returns included."""
    qs = exact_quantiles(df, cols, [q]).groupBy().pivot("column", list(cols)).agg(F.first("value"))
    qs = qs.select(*[F.col(c).alias(f"_q_{c}") for c in cols])
    out = df.crossJoin(F.broadcast(qs))
    for c in cols:
        out = out.where((F.col(c) > 0) & (F.col(c) < F.col(f"_q_{c}")))
    for r in require:
        out = out.where(F.col(r).isNotNull())
    return out.drop(*[f"_q_{c}" for c in cols])


def filter_country(df: DataFrame, country: str, c: str = "country") -> DataFrame:
    """The dashboards' country predicate (C16); pushed to the scan by Catalyst."""
    return df.where(F.col(c) == F.lit(country))


# -- C17 --------------------------------------------------------------------
def clean(df: DataFrame, keep_returns: bool = True, impute: bool = True, use_log: bool = False,
          variant: str = "sales", key: str = "customer_id") -> DataFrame:
    """The composed cleaner (C17).

    ``variant='sales'``: returns filter, then impute key/quantity/price
    medians (or drop lines without a key), line total, time parse, calendar,
    optional log. ``variant='customers'`` drops lines without a customer
    first, so imputing the key is a no-op, as in the segmentation module.
    """
    if variant not in ("sales", "customers"):
        raise ValueError(f"unknown variant {variant!r}")
    out = df
    if variant == "customers":
        out = drop_missing_key(out, key)
    out = filter_returns(out, keep_returns)
    if impute:
        cols = [c for c in (key, "quantity", "unit_price") if c in out.columns]
        if variant == "customers":
            cols = [c for c in cols if c != key]
        out = impute_median(out, cols, cast=True)
    else:
        out = drop_missing_key(out, key)
    out = add_line_total(out)
    out = to_timestamp_column(out)
    out = add_calendar(out)
    if use_log:
        out = add_log(out)
    return out
