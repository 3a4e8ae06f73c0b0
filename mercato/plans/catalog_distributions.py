"""Catalog: distribution operators and sampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import clean as C
from ..operators import dist as D
from ..operators.sample import sample_cap, stratified_sample
from ..sources import SALES_LINES_SQL
from . import views as V
from .catalog_segments import LABELLED_SQL, labelled
from .registry import register

R = 6


def _lines(spark, sf_dir):
    return V.lines(spark, sf_dir).withColumn("sales", F.col("sales").cast("double"))


@register("h1_histogram", "H1", V.sql("""
, v AS (SELECT CAST(sales AS DOUBLE) AS x FROM sales_lines),
r AS (SELECT min(x) AS lo, max(x) AS hi FROM v),
b AS (SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((x - lo) / ((hi - lo) / 30)), 29) END AS INTEGER) AS bin
      FROM v, r)
SELECT bin, count(*) AS count FROM b GROUP BY 1""", SALES_LINES_SQL))
def h1_histogram(spark, sf_dir):
    return D.histogram(_lines(spark, sf_dir), "sales", 30).select("bin", "count")


@register("h1_histogram_by_country", "H1", V.sql("""
, v AS (SELECT country, unit_price AS x FROM sales_lines),
r AS (SELECT min(x) AS lo, max(x) AS hi FROM v),
b AS (SELECT country, CAST(least(floor((x - lo) / ((hi - lo) / 50)), 49) AS INTEGER) AS bin FROM v, r)
SELECT country, bin, count(*) AS count FROM b GROUP BY 1, 2""", SALES_LINES_SQL))
def h1_histogram_by_country(spark, sf_dir):
    return D.histogram(_lines(spark, sf_dir), "unit_price", 50, by=["country"]).select("country", "bin", "count")


def _kde_sql(cut, by="", value="quantity", src="sales_lines"):
    """The density as the plain sum over all rows (equal values counted once), without bins."""
    k, g = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    join = f"JOIN r USING ({by})" if by else ", r"
    return f"""
, v AS (SELECT {k}CAST({value} AS DOUBLE) AS x FROM {src}),
r AS (SELECT {k}min(x) AS lo, max(x) AS hi, count(*) AS n, stddev_samp(x) * power(count(*), -0.2) AS h FROM v {g}),
b AS (SELECT {k}x AS vx, count(*) AS c FROM v GROUP BY {k}x),
g AS (SELECT {k}unnest(range(0, 100)) AS point, lo - {cut} * h AS a, (hi - lo + 2 * {cut} * h) / 99 AS step FROM r WHERE h > 0),
k AS (SELECT {k}point, a + point * step AS x,
             sum(c * exp(-0.5 * power((a + point * step - vx) / h, 2))) / (any_value(n) * any_value(h) * sqrt(2 * pi())) AS density
      FROM b {join} {f"JOIN g USING ({by})" if by else ", g"} GROUP BY {k}point, a, step)"""


KDE_OUT = "CAST(point AS INTEGER) AS point, round(x, 9) AS x, round(density, 12) AS density"


def _kde_round(k, *more):
    return k.select(*more, "point", F.round("x", 9).alias("x"), F.round("density", 12).alias("density"))


@register("h2_kde", "H2", V.sql(_kde_sql(3) + f"""
SELECT {KDE_OUT} FROM k""", SALES_LINES_SQL))
def h2_kde(spark, sf_dir):
    return _kde_round(D.kde(_lines(spark, sf_dir), "quantity", 100))


@register("h2_kde_by_country", "H2", V.sql(_kde_sql(3, "country", "unit_price") + f"""
SELECT country, {KDE_OUT} FROM k""", SALES_LINES_SQL))
def h2_kde_by_country(spark, sf_dir):
    return _kde_round(D.kde(_lines(spark, sf_dir), "unit_price", 100, ["country"]), "country")


@register("h4_violin", "H4", V.sql(_kde_sql(2) + f""",
q AS (SELECT quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median, quantile_cont(x, 0.75) AS q3 FROM v)
SELECT {KDE_OUT}, q1, median, q3 FROM k, q""", SALES_LINES_SQL))
def h4_violin(spark, sf_dir):
    return _kde_round(D.violin_stats(_lines(spark, sf_dir), "quantity", grid=100), "q1", "median", "q3")


@register("h4_violin_by_country", "H4", V.sql(_kde_sql(2, "country") + f""",
q AS (SELECT country, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median, quantile_cont(x, 0.75) AS q3
      FROM v GROUP BY country)
SELECT country, {KDE_OUT}, q1, median, q3 FROM k JOIN q USING (country)""", SALES_LINES_SQL))
def h4_violin_by_country(spark, sf_dir):
    return _kde_round(D.violin_stats(_lines(spark, sf_dir), "quantity", ["country"], 100),
                      "country", "q1", "median", "q3")


BOX_SQL = """
, v AS (SELECT country, CAST(sales AS DOUBLE) AS x FROM sales_lines),
q AS (SELECT country, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median, quantile_cont(x, 0.75) AS q3
      FROM v GROUP BY 1),
f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence FROM q)"""


@register("h3_box_stats", "H3", V.sql(BOX_SQL + f"""
SELECT country, count(*) AS n, round(any_value(q1), {R}) AS q1, round(any_value(median), {R}) AS median,
       round(any_value(q3), {R}) AS q3, round(any_value(iqr), {R}) AS iqr,
       round(any_value(lower_fence), {R}) AS lower_fence, round(any_value(upper_fence), {R}) AS upper_fence,
       min(x) FILTER (WHERE x BETWEEN lower_fence AND upper_fence) AS whisker_low,
       max(x) FILTER (WHERE x BETWEEN lower_fence AND upper_fence) AS whisker_high,
       CAST(count(*) FILTER (WHERE x < lower_fence OR x > upper_fence) AS BIGINT) AS n_outliers
FROM v JOIN f USING (country) GROUP BY country""", SALES_LINES_SQL))
def h3_box_stats(spark, sf_dir):
    b = D.box_stats(_lines(spark, sf_dir), "sales", by=["country"])
    return b.select("country", "n", *[F.round(c, R).alias(c) for c in
                                      ("q1", "median", "q3", "iqr", "lower_fence", "upper_fence")],
                    "whisker_low", "whisker_high", "n_outliers")


@register("h5_outlier_points", "H5", V.sql("""
, v AS (SELECT row_key, country, CAST(sales AS DOUBLE) AS x FROM sales_lines),
q AS (SELECT country, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.75) AS q3 FROM v GROUP BY 1)
SELECT row_key, country, x AS sales FROM v JOIN q USING (country)
WHERE x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1)""", SALES_LINES_SQL))
def h5_outlier_points(spark, sf_dir):
    return D.outlier_points(_lines(spark, sf_dir), "sales", "row_key", by=["country"])


@register("h6_pair_sample", "H6, W10", V.sql("""
SELECT customer_id, total_spent, n_lines, recency_days FROM customers
ORDER BY md5(concat_ws('|', CAST(customer_id AS VARCHAR), '42')) LIMIT 1000""", V.CUSTOMERS_SQL))
def h6_pair_sample(spark, sf_dir):
    return D.pair_sample(V.customers(spark, sf_dir), ["total_spent", "n_lines", "recency_days"], "customer_id")


@register("h7_scatter_sample", "H7, C15, W10", V.sql("""
, q AS (SELECT quantile_cont(quantity, 0.99) AS q_qty, quantile_cont(unit_price, 0.99) AS q_price,
             quantile_cont(CAST(sales AS DOUBLE), 0.99) AS q_sales FROM sales_lines),
t AS (SELECT row_key, quantity, unit_price, CAST(sales AS DOUBLE) AS sales, country FROM sales_lines, q
      WHERE quantity > 0 AND quantity < q_qty AND unit_price > 0 AND unit_price < q_price
        AND sales > 0 AND CAST(sales AS DOUBLE) < q_sales AND country IS NOT NULL)
SELECT row_key, quantity, unit_price, sales, country FROM t
ORDER BY md5(concat_ws('|', row_key, '42')) LIMIT 2000""", SALES_LINES_SQL))
def h7_scatter_sample(spark, sf_dir):
    t = C.trim_extremes(_lines(spark, sf_dir), ["quantity", "unit_price", "sales"])
    return sample_cap(t.select("row_key", "quantity", "unit_price", "sales", "country"), 2000, "row_key")


@register("h8_sales_line", "H8, C16", V.sql("""
SELECT CAST(invoice_date AS DATE) AS day, CAST(sum(sales) AS DOUBLE) AS sales FROM sales_lines
WHERE country = 'NATION_3' GROUP BY 1""", SALES_LINES_SQL))
def h8_sales_line(spark, sf_dir):
    return D.sales_line(V.lines(spark, sf_dir), "NATION_3")


@register("h10_parallel_profile", "H10", V.sql(f"""
, s AS (SELECT customer_id, cluster, {", ".join(f"CAST({f} AS DOUBLE) AS {f}" for f in V.FEATURES)} FROM labelled)
SELECT customer_id, cluster, feature, round(value, 6) AS value
FROM (UNPIVOT s ON {", ".join(V.FEATURES)} INTO NAME feature VALUE value)""", *LABELLED_SQL))
def h10_parallel_profile(spark, sf_dir):
    p = D.parallel_profile(labelled(spark, sf_dir), list(V.FEATURES), "customer_id")
    return p.withColumn("value", F.round("value", 6))


@register("w9_ecdf", "W9", V.sql("""
SELECT CAST(sales AS DOUBLE) AS value,
       (row_number() OVER (ORDER BY sales) - 1) / count(*) OVER () AS ecdf
FROM sales_lines""", SALES_LINES_SQL))
def w9_ecdf(spark, sf_dir):
    return D.ecdf(_lines(spark, sf_dir), "sales", base=0)


@register("w9_ecdf_from_one", "W9", V.sql("""
SELECT CAST(total_spent AS DOUBLE) AS value, row_number() OVER (ORDER BY total_spent) / count(*) OVER () AS ecdf
FROM customers""", V.CUSTOMERS_SQL))
def w9_ecdf_from_one(spark, sf_dir):
    return D.ecdf(V.customers(spark, sf_dir), "total_spent", base=1)


@register("w10_sample_cap", "W10", V.sql("""
SELECT row_key, CAST(sales AS DOUBLE) AS sales FROM sales_lines
ORDER BY md5(concat_ws('|', row_key, '42')) LIMIT 1000""", SALES_LINES_SQL))
def w10_sample_cap(spark, sf_dir):
    return sample_cap(_lines(spark, sf_dir).select("row_key", "sales"), 1000, "row_key")


@register("w11_stratified_sample", "W11", V.sql("""
, c AS (SELECT cluster, count(*) AS cnt, sum(count(*)) OVER () AS total FROM labelled GROUP BY 1),
qt AS (SELECT cluster, least(cnt, greatest(1, CAST(floor(cnt / total * 200) AS BIGINT))) AS quota FROM c),
r AS (SELECT l.customer_id, l.cluster,
             row_number() OVER (PARTITION BY l.cluster ORDER BY md5(concat_ws('|', CAST(l.customer_id AS VARCHAR), '42')))
             AS rn FROM labelled l)
SELECT customer_id, cluster FROM r JOIN qt USING (cluster) WHERE rn <= quota""", *LABELLED_SQL))
def w11_stratified_sample(spark, sf_dir):
    lab = labelled(spark, sf_dir).select("customer_id", "cluster")
    return stratified_sample(lab, "cluster", 200, "customer_id")


@register("h1_customer_histogram_by_cluster", "H1", V.sql("""
, raw AS (SELECT c.total_spent AS x, l.cluster AS colour FROM customers c JOIN labelled l USING (customer_id)),
r AS (SELECT min(x) AS lo, max(x) AS hi FROM raw)
SELECT colour, CAST(least(floor((x - lo) / ((hi - lo) / 30)), 29) AS INTEGER) AS bin, count(*) AS count
FROM raw, r GROUP BY 1, 2""", *LABELLED_SQL))
def h1_customer_histogram_by_cluster(spark, sf_dir):
    lab = labelled(spark, sf_dir).select("customer_id", "cluster")
    raw = V.customers(spark, sf_dir).join(lab, "customer_id")
    return D.colour_histogram(raw, "total_spent", "cluster", 30).select("colour", "bin", "count")


# -- customers: sales histogram with its curve, pair-plot densities, boxes per cluster ---------
_CUSTOMER_SALES = """
, customer_sales AS (SELECT customer_id, CAST(sum(sales) AS DOUBLE) AS sales FROM sales_lines
                     WHERE customer_id IS NOT NULL GROUP BY 1)"""


def _customer_sales(spark, sf_dir):
    return A.sales_per_customer(V.lines(spark, sf_dir))


@register("a6_customer_histogram", "A6, H1", V.sql(_CUSTOMER_SALES + """,
r AS (SELECT min(sales) AS lo, max(sales) AS hi FROM customer_sales),
b AS (SELECT CAST(least(floor((sales - lo) / ((hi - lo) / 30)), 29) AS INTEGER) AS bin FROM customer_sales, r)
SELECT bin, round(any_value(lo) + bin * (any_value(hi) - any_value(lo)) / 30, 4) AS lo,
       round(any_value(lo) + (bin + 1) * (any_value(hi) - any_value(lo)) / 30, 4) AS hi, count(*) AS count
FROM b, r GROUP BY bin""", SALES_LINES_SQL))
def a6_customer_histogram(spark, sf_dir):
    h = D.histogram(_customer_sales(spark, sf_dir), "sales", 30)
    return h.select("bin", F.round("lo", 4).alias("lo"), F.round("hi", 4).alias("hi"), "count")


@register("a6_customer_density", "A6, H2", V.sql(_CUSTOMER_SALES + _kde_sql(0, "", "sales", "customer_sales") + """
SELECT CAST(point AS INTEGER) AS point, round(x, 4) AS x, round(density, 14) AS density FROM k""", SALES_LINES_SQL))
def a6_customer_density(spark, sf_dir):
    """The curve drawn over the histogram: it ends where the values end."""
    k = D.kde(_customer_sales(spark, sf_dir), "sales", 100, cut=0)
    return k.select("point", F.round("x", 4).alias("x"), F.round("density", 14).alias("density"))


@register("h6_pair_densities", "H6, H2", V.sql(f"""
, s AS (SELECT cluster, {", ".join(f"CAST({f} AS DOUBLE) AS {f}" for f in V.FEATURES)} FROM labelled),
u AS (FROM (UNPIVOT s ON {", ".join(V.FEATURES)} INTO NAME feature VALUE value))"""
    + _kde_sql(3, "feature, cluster", "value", "u") + """
SELECT feature, cluster, CAST(point AS INTEGER) AS point, round(x, 6) AS x, round(density, 9) AS density
FROM k""", *LABELLED_SQL))
def h6_pair_densities(spark, sf_dir):
    k = D.hue_densities(labelled(spark, sf_dir), list(V.FEATURES), "cluster")
    return k.select("feature", "cluster", "point", F.round("x", 6).alias("x"), F.round("density", 9).alias("density"))


@register("h3_box_by_cluster", "H3", V.sql("""
, q AS (SELECT cluster, count(*) AS n, quantile_cont(total_spent, 0.25) AS q1, quantile_cont(total_spent, 0.5) AS median,
               quantile_cont(total_spent, 0.75) AS q3 FROM labelled GROUP BY 1)
SELECT l.cluster, any_value(n) AS n, round(any_value(q1), 6) AS q1, round(any_value(median), 6) AS median,
       round(any_value(q3), 6) AS q3,
       CAST(count(*) FILTER (WHERE total_spent < q1 - 1.5 * (q3 - q1) OR total_spent > q3 + 1.5 * (q3 - q1)) AS BIGINT)
         AS n_outliers
FROM labelled l JOIN q USING (cluster) GROUP BY l.cluster""", *LABELLED_SQL))
def h3_box_by_cluster(spark, sf_dir):
    b = D.box_stats(labelled(spark, sf_dir), "total_spent", by=["cluster"])
    return b.select("cluster", "n", *[F.round(c, 6).alias(c) for c in ("q1", "median", "q3")], "n_outliers")
