"""Connected components of a large edge list by alternating large and small stars (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import stage


def _with_least(pairs: DataFrame) -> DataFrame:
    """(u, v, m): each u's neighbours with the least of them and u; the minimum is combined before the shuffle."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return pairs.join(least, "u").withColumn("m", F.least("m", "u"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    near = _with_least(down)
    out = near.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
    return out.where("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of the nodes of ``edges`` (u, v of one type); component is the least node reachable.

    Each round is written to the shared folder; rounds grow with the logarithm of the longest path.
    """
    edges = stage(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
                  "edges")
    seen = None
    while True:
        mark = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen or mark[0] == 0:
            break
        seen = mark
        edges = stage(_small_star(_large_star(edges)), "edges")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
