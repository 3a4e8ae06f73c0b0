"""Sharding by a Feistel permutation of the global row number.

Rows are numbered 0..n-1 by (id, size, checksum): a range sort of these small columns, written once, with one offset
per partition. A four-round Feistel network over the smallest even-bit domain that holds n, with cycle walking for
numbers that fall outside it, permutes the row numbers. The permuted number p gives shard = p mod shards and
slot = p div shards, so shard sizes differ by at most one (law ``rows``), slots are gapless, the shuffle repeats for a
given seed, and ``row_of`` computes which row any (shard, slot) holds without a table. The numbers are joined to the
whole rows by a hash of (id, text), and the rows are moved into the order of shard and slot.

Edge cases: a NULL text has size 1 and checksum 0; NULL ids sort first; repeated rows are rows of their own; rows that
tie in (id, size, checksum) follow the hash, so each number goes to one row; an empty table gives an empty result.
Columns named row, shard or slot are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm.common import hash128, stage

SHARDS = 16
SEED = 42
ROUNDS = 4


def half_bits(n: int) -> int:
    """Bits in each half of the smallest even-bit domain with at least ``n`` values."""
    k = 1
    while 1 << (2 * k) < n:
        k += 1
    return k


def round_keys(seed: int) -> list[tuple[int, int]]:
    """(xor key, odd multiplier) of each round, below 2^30 so that products stay inside 64 bits."""
    keys, x = [], seed & 0x3FFFFFFF
    for _ in range(2 * ROUNDS):
        x = (x * 1103515245 + 12345) & 0x3FFFFFFF
        keys.append(x)
    return [(keys[2 * i], keys[2 * i + 1] | 1) for i in range(ROUNDS)]


def _mix(r: np.ndarray, key: tuple[int, int], mask: int) -> np.ndarray:
    t = (r ^ key[0]) * key[1]
    return (t ^ (t >> 15)) & mask


def _network(v: np.ndarray, k: int, keys: list[tuple[int, int]], inverse: bool) -> np.ndarray:
    mask = (1 << k) - 1
    left, right = v >> k, v & mask
    for key in reversed(keys) if inverse else keys:
        if inverse:
            left, right = right ^ _mix(left, key, mask), left
        else:
            left, right = right, left ^ _mix(right, key, mask)
    return (left << k) | right


def permute(rows: np.ndarray, n: int, seed: int = SEED, inverse: bool = False) -> np.ndarray:
    """The permutation of 0..n-1 at ``rows``: the network is applied again to any value outside the range."""
    k, keys = half_bits(n), round_keys(seed)
    out = _network(np.asarray(rows, dtype=np.int64), k, keys, inverse)
    outside = np.flatnonzero(out >= n)
    while len(outside):
        out[outside] = _network(out[outside], k, keys, inverse)
        outside = outside[out[outside] >= n]
    return out


def row_of(shard: int, slot: int, n: int, shards: int = SHARDS, seed: int = SEED) -> int:
    """The global row number that stands in ``slot`` of ``shard``."""
    return int(permute(np.array([slot * shards + shard]), n, seed, inverse=True)[0])


def numbered(rows: DataFrame, *order: str) -> tuple[DataFrame, dict[int, int], int]:
    """Rows with (part, idx), the first global number of each part, and the row count.

    The driver gets one count per partition. The numbered rows are written first, because range bounds are sampled
    and would differ between two runs of the same plan.
    """
    local = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    parts = stage(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                  .withColumns({"part": F.spark_partition_id(), "idx": local}), "row-numbers")
    first, n = {}, 0
    for part, rows_in in sorted(parts.groupBy("part").count().collect()):
        first[part] = n
        n += rows_in
    return parts, first, n


def _size_and_crc(text_col: str) -> tuple[Column, Column]:
    return (F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long") + 1,
            F.coalesce(F.crc32(F.col(text_col)), F.lit(0).cast("long")))


def shard_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS,
                    seed: int = SEED) -> DataFrame:
    """``docs`` with row, shard and slot, moved into the order of shard and slot.

    Only small columns are sorted and numbered; the rows themselves are shuffled for the join and into their shards.
    """
    docs = docs.drop("row", "shard", "slot", "_r1", "_r2", "_copy", "_places")
    size, crc = _size_and_crc(text_col)
    r1, r2 = hash128(F.col(id_col).isNull(), F.col(id_col), F.col(text_col).isNull(), F.col(text_col))
    small = docs.select(F.col(id_col).alias("_id"), size.alias("_size"), crc.alias("_crc"),
                        r1.alias("_r1"), r2.alias("_r2"))
    parts, first, n = numbered(small, "_id", "_size", "_crc", "_r1", "_r2")

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            row = b["idx"].to_numpy(np.int64) + b["part"].map(first).to_numpy(np.int64)
            p = permute(row, n, seed)
            yield pd.DataFrame({"_r1": b["_r1"], "_r2": b["_r2"], "row": row,
                                "shard": (p % shards).astype(np.int32), "slot": p // shards})

    placed = parts.select("_r1", "_r2", "part", "idx").mapInPandas(
        place, "_r1 long, _r2 long, row long, shard int, slot long")
    # rows of the same id and text take the numbers of their hash one by one
    placed = placed.groupBy("_r1", "_r2").agg(F.array_sort(F.collect_list(F.struct("row", "shard", "slot")))
                                              .alias("_places"))
    copy = F.row_number().over(Window.partitionBy("_r1", "_r2").orderBy(F.xxhash64(*docs.columns)))
    rows = docs.withColumns({"_r1": r1, "_r2": r2}).withColumn("_copy", copy)
    out = rows.join(placed, ["_r1", "_r2"]).select(*docs.columns, F.get("_places", F.col("_copy") - 1).alias("_at"))
    return (out.select(*docs.columns, "_at.row", "_at.shard", "_at.slot")
            .repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot"))


def shard_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS,
               seed: int = SEED) -> DataFrame:
    """(id, size, text_crc32, row, shard, slot) of every row, from the rows in their shards."""
    size, crc = _size_and_crc(text_col)
    return shard_documents(docs, id_col, text_col, shards, seed).select(
        F.col(id_col).alias("id"), size.alias("size"), crc.alias("text_crc32"), "row", "shard", "slot")
