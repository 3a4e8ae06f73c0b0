"""Shared stage views for the catalog queries, each with its DuckDB twin.

The same stage appears on both sides: ``clean_customers`` is the segmentation
cleaner applied to the flat lines, ``clean_sales`` the forecasting cleaner.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import clean as C
from ..sources import SALES_LINES_SQL, sales_lines


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_lines(spark, sf_dir)


def clean_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.clean(sales_lines(spark, sf_dir), variant="customers")


def clean_sales(spark: SparkSession, sf_dir: str, use_log: bool = False) -> DataFrame:
    return C.clean(sales_lines(spark, sf_dir), variant="sales", use_log=use_log)


CALENDAR_SQL = """
  CAST(year(invoice_date) AS INTEGER) AS year,
  CAST(month(invoice_date) AS INTEGER) AS month,
  CAST(quarter(invoice_date) AS INTEGER) AS quarter,
  CAST(isodow(invoice_date) - 1 AS INTEGER) AS day_of_week,
  CAST(hour(invoice_date) AS INTEGER) AS hour"""

CLEAN_CUSTOMERS_SQL = SALES_LINES_SQL + """,
clean_customers AS (
  SELECT invoice_no, line_no, row_key, stock_code, description, quantity, unit_price,
         sales, invoice_date, customer_id, country, """ + CALENDAR_SQL + """
  FROM sales_lines WHERE customer_id IS NOT NULL
)"""

# Sales variant: the customer id is imputed with the exact median of the
# lines (quantity and price hold no NULLs in the test tables).
CLEAN_SALES_SQL = SALES_LINES_SQL + """,
clean_sales AS (
  SELECT invoice_no, line_no, row_key, stock_code, description, quantity, unit_price,
         sales, invoice_date,
         COALESCE(CAST(customer_id AS DOUBLE),
                  (SELECT quantile_cont(customer_id, 0.5) FROM sales_lines)) AS customer_id,
         country, """ + CALENDAR_SQL + """
  FROM sales_lines
)"""


def sql(body: str, *views: str) -> str:
    """Oracle text: ``WITH <views> <body>``."""
    return "WITH " + ",\n".join(v.strip() for v in views) + "\n" + body


# -- customers and their standardised features -------------------------------
FEATURES = ("avg_ticket", "n_lines", "total_spent", "recency_days", "n_products")

CUSTOMERS_SQL = CLEAN_CUSTOMERS_SQL + """,
cust_per AS (
  SELECT customer_id, count(invoice_date) AS n_lines, CAST(sum(sales) AS DOUBLE) AS total,
         max(invoice_date) AS last_ts, count(DISTINCT stock_code) AS n_products
  FROM clean_customers GROUP BY customer_id
),
customers AS (
  SELECT customer_id, n_lines, total AS total_spent,
         CAST(floor((epoch_us((SELECT max(last_ts) FROM cust_per)) - epoch_us(last_ts)) / 86400000000.0)
              AS INTEGER) AS recency_days,
         n_products, total / n_lines AS avg_ticket
  FROM cust_per
)"""


def scaled_sql(method: str = "standard", src: str = "customers", out: str = "z_customers",
               feats=FEATURES, key: str = "customer_id") -> str:
    """DuckDB text of the scaler applied to every feature over the whole table."""
    cols = []
    for f in feats:
        x = f"CAST({f} AS DOUBLE)"
        if method == "standard":
            c, s = f"avg({x}) OVER ()", f"stddev_pop({x}) OVER ()"
        elif method == "minmax":
            c, s = f"min({x}) OVER ()", f"max({x}) OVER () - min({x}) OVER ()"
        else:
            c = f"quantile_cont({x}, 0.5) OVER ()"
            s = f"quantile_cont({x}, 0.75) OVER () - quantile_cont({x}, 0.25) OVER ()"
        cols.append(f"({x} - {c}) / COALESCE(NULLIF({s}, 0), 1) AS {f}")
    return f"{out} AS (SELECT {key}, " + ", ".join(cols) + f" FROM {src})"


def rank_label_sql(src: str, order: str, k: int = 4, out: str = "labelled") -> str:
    return (f"{out} AS (SELECT *, CAST(floor((row_number() OVER (ORDER BY {order}) - 1) * {k} "
            f"/ count(*) OVER ()) AS INTEGER) AS cluster FROM {src})")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.customers import customer_features
    return customer_features(clean_customers(spark, sf_dir), written=True)


def scaled_customers(spark: SparkSession, sf_dir: str, method: str = "standard", materialise: bool = False) -> DataFrame:
    """Customers with standardised features. ``customer_features`` writes its
    aggregated rows once, so fitting the scaler and applying it read one row
    per customer, not the lines again; ``materialise`` also writes the
    result, for iterative consumers such as the clusterers."""
    from ..operators.scale import scale
    out = scale(customers(spark, sf_dir), list(FEATURES), method)
    return out.checkpoint(eager=True) if materialise else out


# -- daily panels ---------------------------------------------------------------
def panel_sql(keys=(), src: str = "sales_lines", value: str = "CAST(sum(sales) AS DOUBLE)", out: str = "panel",
              test_days: int = 31, val_days: int = 31) -> str:
    """DuckDB text of ``forecast.panel.build_panel``: daily sums per key, gap
    filled with 0, split by the last days, time index per key."""
    k = ", ".join(keys)
    kc = (k + ", ") if keys else ""
    using = f"USING ({k}, day)" if keys else "USING (day)"
    st_join = f"JOIN (SELECT {k}, min(day) AS start FROM {out}_split GROUP BY {k}) st USING ({k})" if keys \
        else f", (SELECT min(day) AS start FROM {out}_split) st"
    return f"""{out}_daily AS (SELECT {kc}CAST(invoice_date AS DATE) AS day, {value} AS sales
               FROM {src} GROUP BY {kc}CAST(invoice_date AS DATE)),
{out}_bounds AS (SELECT {kc}min(day) AS lo, max(day) AS hi FROM {out}_daily {"GROUP BY " + k if keys else ""}),
{out}_cal AS (SELECT {kc}CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM {out}_bounds),
{out}_filled AS (SELECT {kc}day, COALESCE(d.sales, 0) AS sales FROM {out}_cal LEFT JOIN {out}_daily d {using}),
{out}_sb AS (SELECT max(day) - {test_days + val_days} AS train_end, max(day) - {test_days} AS val_end FROM {out}_filled),
{out}_split AS (SELECT f.*, CASE WHEN day <= train_end THEN 'train' WHEN day <= val_end THEN 'validation'
                ELSE 'test' END AS split FROM {out}_filled f, {out}_sb),
{out} AS (SELECT s.*, CAST(datediff('day', st.start, s.day) AS INTEGER) AS t FROM {out}_split s {st_join})"""
