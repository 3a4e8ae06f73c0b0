"""N-gram Jaccard self-join with adaptive multi-match prefixes, reduced to linked components.

A text's set is its distinct word n-grams as 64-bit hashes. Equal sets are one class; all work below is on classes.

1. One pass counts all n-grams in a sketch of fixed size. (estimated count, hash) is the global order, rare first;
   any common order gives exact prefixes, the sketch only decides how short the lists are.
2. Each class keeps the first ``n - ceil(t n) + l`` n-grams. ``l`` is chosen per class by estimated candidate cost:
   where the prefix meets long lists, a longer prefix is kept and more shared n-grams are required. Two linked
   classes share at least ``min(l1, l2)`` of their prefixes.
3. Each list pairs its members with its least member (as many pairs as list entries); those that share enough are
   verified and give first components. What remains are pairs across components: in lists of up to ``LIST_LIMIT``
   members they are counted, those with enough shared n-grams verified; longer lists are cut into blocks, and each task verifies one pair of
   blocks by counting common n-grams in a matrix and returns a spanning forest of the links, never the pairs.
4. Components over all links.

Edge cases: texts with fewer than n words are one n-gram of all their words; NULL, empty and blank texts have an
empty set and are linked with nothing; repeated rows fall into one class; rows without an id join the component of
equal texts but link to no other class, and their component is NULL if no row of the class has an id; an empty table
gives an empty result. Only the id and text columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import broadcast_if_small, map_texts, stage
from mercato.llm.graph import components

SKETCH_BITS = 20
#: Numbers of shared n-grams that a class may ask for, as shares of its set.
MATCH_SHARES = (1 / 16, 1 / 12, 1 / 8, 1 / 6)
#: Cost of verifying a candidate, in list entries read.
VERIFY_COST = 20
LIST_LIMIT = 64
BLOCK = 512
BROADCAST_IDS = 1_000_000
MEMO_SIZE = 300_000
_C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > MEMO_SIZE:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def ngram_set(text: str | None, n: int, words: dict) -> np.ndarray:
    """Sorted distinct n-gram hashes. Encoded as bytes, lower() and split() touch A-Z and ASCII white space only."""
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(words.__getitem__, tokens), dtype=np.uint64, count=len(tokens))
    size = max(1, len(h) - n + 1)
    out = np.full(size, min(n, len(h)), dtype=np.uint64)
    for k in range(min(n, len(h))):
        out = (out ^ (out >> np.uint64(31))) * _C1 + h[k:k + size] * _C2
    return np.unique(out ^ (out >> np.uint64(29)))


def node_of(ngrams: np.ndarray) -> bytes:
    return hashlib.blake2b(ngrams.tobytes(), digest_size=16).digest()


def _bucket(ngrams: np.ndarray) -> np.ndarray:
    return (ngrams >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def needed(n: int, pct: int) -> int:
    """The least overlap of a set of ``n`` with any set at ``pct`` percent similarity."""
    return (pct * n + 99) // 100


def prefix(ngrams: np.ndarray, pct: int, counts: np.ndarray, noise: float) -> tuple[int, np.ndarray]:
    """(l, the n-grams of the adaptive prefix)."""
    n = len(ngrams)
    least = needed(n, pct)
    matches = sorted({min(1 + int(n * x), least) for x in MATCH_SHARES})
    estimate = counts[_bucket(ngrams)]
    order = np.lexsort((ngrams, estimate))[:n - least + matches[-1]]
    entries = np.cumsum(np.maximum(estimate[order] - noise, 0) + 1)
    cost = [entries[n - least + m - 1] * (1 + VERIFY_COST / m) for m in matches]
    match = matches[int(np.argmin(cost))]
    return match, ngrams[order[:n - least + match]]


def _sets(docs: DataFrame, n: int) -> DataFrame:
    """(_id, n, node, sketch): a row for each document and, at the end of each task, one with its n-gram counts."""
    def start():
        words, counts = _Words(), np.zeros(1 << SKETCH_BITS, dtype=np.int64)

        def work(texts: list[str | None]) -> list[dict]:
            sets = [ngram_set(t, n, words) for t in texts]
            work.counts += np.bincount(_bucket(np.concatenate(sets)), minlength=1 << SKETCH_BITS)
            return [{"n": len(s), "node": node_of(s) if len(s) else None, "sketch": None} for s in sets]
        work.counts = counts
        return work

    return map_texts(docs, "_text", ["_id"], start, {"n": "long", "node": "binary", "sketch": "array<long>"},
                     finish=lambda work: [{"n": -1, "node": None, "sketch": work.counts}])


def _sketch(found: DataFrame) -> np.ndarray:
    """The summed n-gram counts; the driver gets one number per bucket, in a few hundred rows."""
    summed = (found.where("sketch IS NOT NULL").select(F.posexplode("sketch").alias("at", "x"))
              .groupBy("at").agg(F.sum("x").alias("x")))
    chunks = summed.groupBy(F.shiftright("at", 12).alias("chunk")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("at", "x"))), lambda s: s["x"]).alias("x"))
    counts = np.zeros((1 << SKETCH_BITS - 12, 1 << 12), dtype=np.int64)
    for r in chunks.toLocalIterator():
        counts[r["chunk"]] = r["x"]
    return counts.ravel()


def _prefixes(docs: DataFrame, n: int, pct: int, counts: np.ndarray) -> DataFrame:
    noise = float(np.median(counts))

    def start():
        words = _Words()

        def work(texts: list[str | None]) -> Iterator[dict]:
            for s in (ngram_set(t, n, words) for t in texts):
                match, grams = prefix(s, pct, counts, noise) if len(s) else (None, None)
                yield {"node": node_of(s) if len(s) else None, "n": len(s), "l": match,
                       "grams": None if grams is None else grams.view(np.int64)}
        return work

    return map_texts(docs, "_text", [], start, {"node": "binary", "n": "long", "l": "int", "grams": "array<long>"}) \
        .where("node IS NOT NULL")


def _full_sets(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """(cls, grams) of the wanted classes (cls, node, _id), worked out again from the texts."""
    def start():
        words = _Words()
        return lambda texts: ({"node": node_of(s) if len(s) else None, "grams": s.view(np.int64)}
                              for s in (ngram_set(t, n, words) for t in texts))

    wanted = stage(wanted.withColumnRenamed("node", "want"), "wanted")
    texts = docs.join(broadcast_if_small(wanted, BROADCAST_IDS), "_id")
    made = map_texts(texts, "_text", ["cls", "want"], start, {"node": "binary", "grams": "array<long>"})
    return stage(made.where("node = want").select("cls", "grams"), "full-sets")


def _linked(common: Column, na: Column, nb: Column, pct: int) -> Column:
    return 100 * common >= pct * (na + nb - common)


def _verified(pairs: DataFrame, sets: DataFrame, pct: int) -> DataFrame:
    """The pairs (u, v) of classes that are linked."""
    a, b = (sets.select(F.col("cls").alias(k), F.col("grams").alias(f"g{k}")) for k in ("u", "v"))
    both = pairs.join(a, "u").join(b, "v")
    common = F.size(F.array_intersect("gu", "gv"))
    return both.where(_linked(common, F.size("gu"), F.size("gv"), pct)).select("u", "v")


def _lengths_fit(na: Column, nb: Column, pct: int) -> Column:
    return 100 * F.least(na, nb) >= pct * F.greatest(na, nb)


def block_links(left: list[np.ndarray], right: list[np.ndarray], pct: int) -> np.ndarray:
    """Boolean matrix of linked pairs; common n-grams are counted column block by column block."""
    sizes = [np.array([len(x) for x in side], dtype=np.int64) for side in (left, right)]
    flat = [np.concatenate(side) for side in (left, right)]
    shared = np.intersect1d(*flat)
    common = np.zeros((len(left), len(right)), dtype=np.float32)
    rows = [np.repeat(np.arange(len(s)), s) for s in sizes]
    at = [np.searchsorted(shared, f) for f in flat]
    hit = [(a < len(shared)) & (shared[np.minimum(a, max(len(shared) - 1, 0))] == f) if len(shared) else
           np.zeros(len(f), dtype=bool) for a, f in zip(at, flat, strict=True)]
    for start in range(0, len(shared), 4096):
        part = []
        for k, side in enumerate((left, right)):
            own = hit[k] & (at[k] >= start) & (at[k] < start + 4096)
            m = np.zeros((len(side), min(4096, len(shared) - start)), dtype=np.float32)
            m[rows[k][own], at[k][own] - start] = 1
            part.append(m)
        common += part[0] @ part[1].T
    common = common.astype(np.int64)
    return 100 * common >= pct * (sizes[0][:, None] + sizes[1][None, :] - common)


def _forest(cls: np.ndarray, comp: np.ndarray, links: np.ndarray, other: np.ndarray,
            other_comp: np.ndarray) -> list[tuple[int, int]]:
    """Links that join components not joined before, at most one less than there are components."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for i, j in zip(*np.nonzero(links & (comp[:, None] != other_comp[None, :])), strict=True):
        a, b = find(int(comp[i])), find(int(other_comp[j]))
        if a != b:
            parent[a] = b
            out.append((int(cls[i]), int(other[j])))
    return out


def _block_links(entries: DataFrame, sets: DataFrame, pct: int) -> DataFrame:
    """Links across components in long lists. ``entries``: gram, cls, comp, k (list length)."""
    blocks = F.ceil(F.col("k") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("cls"), blocks).cast("int")
    dealt = entries.withColumns({"own": own, "other": F.explode(F.sequence(F.lit(0), blocks - 1))}).select(
        "gram", "cls", "comp", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))

    def run(key: tuple, b: pd.DataFrame) -> pd.DataFrame:
        i, j = key[1], key[2]
        left, right = b[b["own"] == i], b[b["own"] == j]
        out: list[tuple[int, int]] = []
        if len(left) and len(right):
            links = block_links([np.asarray(x) for x in left["grams"]], [np.asarray(x) for x in right["grams"]], pct)
            out = _forest(left["cls"].to_numpy(), left["comp"].to_numpy(), links,
                          right["cls"].to_numpy(), right["comp"].to_numpy())
        return pd.DataFrame(out, columns=["u", "v"], dtype="int64")

    return dealt.join(sets, "cls").groupBy("gram", "i", "j").applyInPandas(run, "u long, v long")


def linked_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 3,
                      pct: int = 90) -> DataFrame:
    """(id, n_shingles, component_id) of every row; two texts link at ``pct`` percent Jaccard similarity or more."""
    own = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    found = stage(_sets(own, n), "ngram-sets")
    counts = _sketch(found)
    rows = found.where("n >= 0").select("_id", "n", "node")

    classes = stage(_prefixes(own, n, pct, counts).dropDuplicates(["node"])
                    .withColumn("cls", F.monotonically_increasing_id()), "prefixes")
    rep = rows.where("n > 0").groupBy("node").agg(F.min("_id").alias("_id")).where("_id IS NOT NULL")
    sizes = classes.select("cls", "n", "l")
    entries = classes.select("cls", F.explode("grams").alias("gram"))
    lists = entries.groupBy("gram").agg(F.count(F.lit(1)).alias("k"), F.min("cls").alias("head")).where("k > 1")
    entries = stage(entries.join(lists, "gram"), "lists")
    # a partner asks for at least this many shared n-grams; a class with fewer in all its lists has no partner
    asked = 1 + F.floor(F.col("n") * F.lit(pct) / 100 * F.lit(MATCH_SHARES[0]))
    hopeful = (entries.groupBy("cls").agg(F.count(F.lit(1)).alias("t")).join(sizes, "cls")
               .where(F.col("t") >= asked).select("cls", "n", "l"))
    entries = stage(entries.join(hopeful, "cls"), "entries")

    def sets_of(pairs: DataFrame) -> DataFrame:
        nodes = pairs.select(F.explode(F.array("u", "v")).alias("cls")).distinct()
        return _full_sets(own, classes.select("cls", "node").join(nodes, "cls").join(rep, "node"), n)

    heads = (entries.where("cls != head").groupBy(F.col("head").alias("u"), F.col("cls").alias("v"))
             .agg(F.count(F.lit(1)).alias("shared"), F.first("n").alias("nv"))
             # the head's l is not known here: the least that one of a fitting length can ask for
             .where(F.col("shared") >= 1 + F.floor(F.col("nv") * F.lit(pct) / 100 * F.lit(MATCH_SHARES[0]))))
    fit = _lengths_fit(F.col("nu"), F.col("nv"), pct)
    heads = stage(heads.join(sizes.select(F.col("cls").alias("u"), F.col("n").alias("nu")), "u").where(fit)
                  .select("u", "v"), "star-pairs")
    star = stage(_verified(heads, sets_of(heads), pct), "star-links")
    first = components(star)

    placed = (entries.join(first, entries["cls"] == first["node"], "left")
              .select("gram", "cls", "n", "l", "k", F.coalesce("component", "cls").alias("comp")))
    mixed = placed.groupBy("gram").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi")
    placed = stage(placed.join(mixed.select("gram"), "gram", "left_semi"), "open-lists")
    short = placed.where(F.col("k") <= LIST_LIMIT)
    a, b = short.alias("a"), short.alias("b")
    met = (a.join(b, (F.col("a.gram") == F.col("b.gram")) & (F.col("a.cls") < F.col("b.cls"))
                  & (F.col("a.comp") != F.col("b.comp")) & _lengths_fit(F.col("a.n"), F.col("b.n"), pct))
           .groupBy(F.col("a.cls").alias("u"), F.col("b.cls").alias("v"))
           .agg(F.count(F.lit(1)).alias("shared"), F.min(F.least("a.l", "b.l")).alias("l")).where("shared >= l"))
    cross = stage(met.select("u", "v").join(heads, ["u", "v"], "left_anti"), "cross-pairs")
    crossed = stage(_verified(cross, sets_of(cross), pct), "cross-links")
    long_lists = placed.where(F.col("k") > LIST_LIMIT).select("gram", "cls", "comp", "k")
    ends = long_lists.select(F.col("cls").alias("u"), F.col("cls").alias("v"))
    blocked = stage(_block_links(long_lists, sets_of(ends), pct), "block-links")
    linked = components(star.unionByName(crossed).unionByName(blocked))

    linked = linked.withColumnRenamed("node", "_cls")
    of_class = classes.select("cls", "node").join(linked, F.col("cls") == F.col("_cls"), "left")
    of_class = of_class.select("node", F.coalesce("component", "cls").alias("comp")).join(rep, "node", "left")
    least = of_class.groupBy("comp").agg(F.min("_id").alias("component_id"))
    of_node = of_class.join(least, "comp").select("node", "component_id")
    out = rows.join(of_node, "node", "left")
    return out.select(F.col("_id").alias(id_col), F.col("n").alias("n_shingles"),
                      F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("_id")).alias("component_id"))
