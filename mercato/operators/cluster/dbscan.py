"""DBSCAN over all rows (G2), on sub-cells.

Exact DBSCAN: eps-neighbourhood counts include the point itself, and a border
point reachable from several clusters takes the smallest cluster id. All work
is DataFrame joins and aggregates; row pairs are tested inside joins whose
output is counted at once, and never kept.

1. Identical points become one weighted point.
2. Points fall into sub-cells of side eps / sqrt(d), so any two points of a
   sub-cell are within eps of each other. A sub-cell of ``min_samples`` points
   is *dense*: all its points are core and one component, whatever its size.
   The others hold fewer than ``min_samples`` points each.
3. Sub-cells whose bounding boxes come within eps are paired through a coarse
   grid (each sub-cell meets half of its neighbour blocks, so every pair is
   found once).
4. Points of sparse sub-cells count the weights within eps in the paired ones.
   A large sub-cell is met in chunks of ``chunk`` points, so no key holds more.
5. Core sub-cells are linked where two of their core points are within eps.
   Two dense sub-cells are tried with up to four extreme points first; only pairs
   still in different components are compared in full, and only their points
   within eps of the other's box.
6. Components of the links by min-label propagation with pointer jumping, a
   reliable ``checkpoint`` each round.

Keys may have any type with an order. A row with a missing or infinite feature
gets a NULL label.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ...session import checkpoint_dir
from ..joins import fits
from ..rank import number_rows

#: Tables of at most so many rows (sub-cells, points; some hundred bytes each) are sent to every task, larger ones shuffled.
BROADCAST_ROWS = 200_000


def _sq(feats: Sequence[str], a: str, b: str) -> Column:
    """Squared distance between the features prefixed ``a`` and ``b``."""
    out = F.lit(0.0)
    for f in feats:
        out = out + (F.col(a + f) - F.col(b + f)) * (F.col(a + f) - F.col(b + f))
    return out


def _box_gap(feats: Sequence[str], a: str, b: str) -> Column:
    """Squared distance between two boxes given as ``lo_``/``hi_`` columns."""
    out = F.lit(0.0)
    for f in feats:
        gap = F.greatest(F.lit(0.0), F.col(f"{a}lo_{f}") - F.col(f"{b}hi_{f}"), F.col(f"{b}lo_{f}") - F.col(f"{a}hi_{f}"))
        out = out + gap * gap
    return out


def _sent(df: DataFrame, rows_of: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint if the written table ``rows_of``, which bounds its rows, is small."""
    return F.broadcast(df) if fits(rows_of, BROADCAST_ROWS) else df


def _prefixed(df: DataFrame, prefix: str, cols: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c) for c in cols])


def components(nodes: DataFrame, edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``(node, label)``: the smallest node of each node's component.

    ``nodes`` has a column node, ``edges`` the columns a and b. Every round
    twice takes the smallest label among a node and its neighbours and then the
    label's own label, which halves chains; it is written before the next."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) \
        .where("a <> b").distinct().checkpoint(eager=True)
    labels = nodes.select("node", F.col("node").alias("label"))
    if both.isEmpty():
        return labels
    small = fits(nodes, BROADCAST_ROWS)
    send = F.broadcast if small else lambda df: df

    def spread(labels: DataFrame) -> DataFrame:
        near = both.join(send(labels), F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("_near"))
        hop = labels.join(send(near), F.col("node") == F.col("a"), "left") \
            .select("node", "_old", F.least("label", "_near").alias("_hop"))
        jump = hop.select(F.col("node").alias("_at"), F.col("_hop").alias("_jump"))
        return hop.join(send(jump), F.col("_hop") == F.col("_at")) \
            .select("node", "_old", F.least("_hop", "_jump").alias("label"))

    for _ in range(max_rounds):
        now = spread(spread(labels.withColumn("_old", F.col("label")))).checkpoint(eager=True)
        labels = now.select("node", "label")
        if now.where("label <> _old").isEmpty():
            return labels
    raise RuntimeError(f"components did not settle in {max_rounds} rounds; raise max_rounds")


def _cell_pairs(cells: DataFrame, feats: Sequence[str], eps: float, per_block: int, grid_dims: int) -> DataFrame:
    """Unordered pairs (a_, b_) of sub-cells whose boxes come within eps.

    A block is ``per_block`` sub-cells wide, at least eps, so partners lie in
    the same or an adjacent block. Beyond ``grid_dims`` features only those
    with the most sub-cells across place the blocks."""
    dims = list(range(len(feats)))
    if len(dims) > grid_dims:
        wide = cells.agg(*[(F.max(F.col("cell")[i]) - F.min(F.col("cell")[i])).alias(str(i)) for i in dims]).first()
        dims = sorted(dims, key=lambda i: -(wide[str(i)] or 0))[:grid_dims]
    # Steps are numbered in base 3; those from the middle one, which stays in the block, are half of the neighbours.
    middle, last = (3 ** len(dims) - 1) // 2, 3 ** len(dims) - 1
    blocks = [f"_block{i}" for i in dims]
    cols = ["cell", "dense", "chunks", *[f"{e}_{f}" for f in feats for e in ("lo", "hi")]]
    own = cells.withColumns({k: F.floor(F.col("cell")[i] / per_block) for k, i in zip(blocks, dims, strict=True)})
    step = {k: F.col(k) + F.floor(F.col("_step") / 3 ** (len(dims) - 1 - n)) % 3 - 1 for n, k in enumerate(blocks)}
    a = own.withColumn("_step", F.explode(F.sequence(F.lit(middle), F.lit(last)))).withColumns(step) \
        .select(*blocks, (F.col("_step") == middle).alias("_home"), *[F.col(c).alias(f"a_{c}") for c in cols])
    b = own.select(*blocks, *[F.col(c).alias(f"b_{c}") for c in cols])
    return a.join(_sent(b, cells), blocks).where((~F.col("_home") | (F.col("a_cell") < F.col("b_cell")))
                                   & (_box_gap(feats, "a_", "b_") <= eps * eps * (1 + 1e-9))).drop(*blocks, "_home")


def dbscan(df: DataFrame, feats: Sequence[str], key: str, eps: float = 0.7, min_samples: int = 10,
           grid_dims: int = 5, max_rounds: int = 100, label: str = "cluster", chunk: int = 1_000) -> DataFrame:
    """Label every row: cluster 0…k-1 (numbered by each cluster's smallest
    core key), -1 for noise, NULL with a missing feature. Returns ``(key, label)``."""
    checkpoint_dir(df.sparkSession)
    names, d = [f"x{i}" for i in range(len(feats))], len(feats)
    side = eps / math.sqrt(d) * (1 - 1e-9)  # a hair less, so that rounding cannot part a sub-cell
    eps2 = float(eps) * float(eps)
    rows = df.select(F.col(key).alias("_key"), *[F.when(F.abs(F.col(f).cast("double")) < math.inf, F.col(f).cast("double"))
                                                 .alias(x) for f, x in zip(feats, names, strict=True)])
    # 1. and 2. weighted points, sub-cells
    uniq = rows.dropna(subset=names).groupBy(*names).agg(F.count(F.lit(1)).alias("w"), F.min("_key").alias("pid")) \
        .withColumn("cell", F.array(*[F.floor(F.col(x) / side) for x in names]))
    weights = uniq.groupBy("cell").agg(F.sum("w").alias("cw"), F.count(F.lit(1)).alias("_n"))
    points = uniq.join(weights, "cell").withColumns({
        "dense": F.col("cw") >= min_samples, "chunks": F.ceil(F.col("_n") / chunk).cast("int")}) \
        .withColumn("part", F.pmod(F.xxhash64("pid"), F.col("chunks")).cast("int")).drop("_n").checkpoint(eager=True)
    # 3. neighbouring sub-cells
    ends = [f(x).alias(f"{e}_{x}") for x in names for e, f in (("lo", F.min), ("hi", F.max))]
    cells = points.groupBy("cell").agg(F.first("dense").alias("dense"), F.first("chunks").alias("chunks"), *ends) \
        .checkpoint(eager=True)
    pairs = _cell_pairs(cells, names, eps, math.ceil(eps / side), grid_dims).checkpoint(eager=True)
    # 4. neighbour counts of the points of sparse sub-cells, by sub-cell met
    one_way = [pairs.where(f"NOT {s}_dense").select(F.col(f"{s}_cell").alias("cell"), F.col(f"{t}_cell").alias("b_cell"),
                                                   F.col(f"{t}_chunks").alias("_chunks")) for s, t in ("ab", "ba")]
    meets = one_way[0].unionByName(one_way[1]).withColumn("b_part", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)))
    other = _prefixed(points, "b_", ["cell", "part", "w", "dense", *names])
    sparse = points.where("NOT dense")
    near = meets.join(_sent(sparse, points), "cell").join(_sent(other, points), ["b_cell", "b_part"]).where(_sq(names, "", "b_") <= eps2) \
        .groupBy("pid", "b_cell").agg(F.sum("b_w").alias("n"), F.first("b_dense").alias("b_dense")) \
        .checkpoint(eager=True)
    total = near.groupBy("pid").agg(F.sum("n").alias("_n"))
    known = sparse.join(total, "pid", "left").withColumn("core", F.col("cw") + F.coalesce("_n", F.lit(0)) >= min_samples) \
        .select("pid", "cell", "core", *names).checkpoint(eager=True)
    # 5. what each point of a sparse sub-cell reaches: core points of a sub-cell, in any number
    met = near.where("NOT b_dense").join(_sent(known, known), "pid") \
        .join(_sent(_prefixed(known.where("core"), "b_", ["cell", *names]), known), "b_cell").where(_sq(names, "", "b_") <= eps2)
    reach = near.where("b_dense").select("pid", "b_cell").join(_sent(known.select("pid", "cell", "core"), known), "pid") \
        .select("pid", "cell", "core", "b_cell") \
        .unionByName(met.select("pid", "cell", "core", "b_cell"))
    core = points.where("dense").select("cell", "pid").unionByName(known.where("core").select("cell", "pid"))
    nodes = core.groupBy("cell").agg(F.min("pid").alias("node")).checkpoint(eager=True)

    def as_edges(links: DataFrame) -> DataFrame:
        """Pairs of sub-cells as pairs of nodes; only core sub-cells are nodes."""
        ends = [_sent(_prefixed(nodes, s, nodes.columns), nodes) for s in ("a_", "b_")]
        return links.join(ends[0], "a_cell").join(ends[1], "b_cell") \
            .select(F.col("a_node").alias("a"), F.col("b_node").alias("b"))

    links = reach.where("core").select(F.col("cell").alias("a_cell"), "b_cell").distinct()
    # border points also lie in core sub-cells: those are reached without distance test
    borders = known.where("NOT core").select("pid", F.col("cell").alias("b_cell")) \
        .unionByName(reach.where("NOT core").select("pid", "b_cell"))
    at = F.struct(*names)
    extremes = points.where("dense").groupBy("cell").agg(F.array_distinct(F.array(
        *[f(at, F.col(x)) for x in names[:2] for f in (F.min_by, F.max_by)])).alias("_ends")) \
        .select("cell", F.inline("_ends"))
    dense = pairs.where("a_dense AND b_dense")
    tried = dense.select("a_cell", "b_cell").join(_sent(_prefixed(extremes, "a_", extremes.columns), points), "a_cell") \
        .join(_sent(_prefixed(extremes, "b_", extremes.columns), points), "b_cell").where(_sq(names, "a_", "b_") <= eps2) \
        .select("a_cell", "b_cell").distinct()
    labels = components(nodes, as_edges(links.unionByName(tried)), max_rounds)
    of_cell = nodes.join(labels, "node").select("cell", "label")
    apart = dense.join(_prefixed(of_cell, "a_", of_cell.columns), "a_cell") \
        .join(_prefixed(of_cell, "b_", of_cell.columns), "b_cell").where("a_label <> b_label").checkpoint(eager=True)
    if not apart.isEmpty():
        near_box = [sum((F.pow(F.greatest(F.lit(0.0), F.col(f"{t}_lo_{x}") - F.col(f"{s}_{x}"),
                                          F.col(f"{s}_{x}") - F.col(f"{t}_hi_{x}")), 2) for x in names), F.lit(0.0))
                    <= eps2 * (1 + 1e-9) for s, t in ("ab", "ba")]
        held = points.where("dense")
        closer = apart.join(_prefixed(held, "a_", ["cell", *names]), "a_cell").where(near_box[0]) \
            .withColumn("b_part", F.explode(F.sequence(F.lit(0), F.col("b_chunks") - 1))) \
            .join(_prefixed(held, "b_", ["cell", "part", *names]), ["b_cell", "b_part"]).where(near_box[1]) \
            .where(_sq(names, "a_", "b_") <= eps2).select(F.col("a_label").alias("a"), F.col("b_label").alias("b")).distinct()
        joined = components(labels.select(F.col("label").alias("node")).distinct(), closer, max_rounds)
        labels = labels.withColumnRenamed("label", "_first").join(
            joined.select(F.col("node").alias("_first"), "label"), "_first").select("node", "label")
        of_cell = nodes.join(labels, "node").select("cell", "label")
    # 6. clusters are numbered by their smallest core key; border points take the smallest reachable one
    numbered = number_rows(labels.select("label").distinct(), ["label"]).select("label", F.col("pos").cast("int").alias("_num"))
    of_cell = of_cell.join(numbered, "label").select("cell", "_num")
    of_cell = _sent(of_cell, nodes)
    border = borders.join(of_cell.withColumnRenamed("cell", "b_cell"), "b_cell").groupBy("pid").agg(F.min("_num").alias("_num"))
    whole = points.where("dense").select("pid", "cell", *names).unionByName(known.where("core").select("pid", "cell", *names))
    final = whole.join(of_cell, "cell").select(*names, "_num") \
        .unionByName(known.where("NOT core").join(border, "pid").select(*names, "_num"))
    missing = F.lit(False)
    for x in names:
        missing = missing | F.col(x).isNull()
    out = rows.withColumn("_missing", missing).join(_sent(final, points), names, "left")
    return out.select(F.col("_key").alias(key), F.when(~F.col("_missing"), F.coalesce("_num", F.lit(-1))).cast("int").alias(label))
