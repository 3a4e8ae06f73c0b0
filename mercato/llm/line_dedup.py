"""Line dedup: key hashes range-partitioned with a secondary sort, per-document keep bitmaps out.

A line's key is the line stripped of ASCII white space with A-Z lower-cased. Lines travel as two 64-bit hashes and
their (document, position); text is never shuffled by line. The range partitioning is on (hash, document), so a key
held by a third of all lines is cut over many partitions, and counts per key are pre-aggregated before they move.
The result per document is a run-length-compressed bitmap: the runs of line numbers to drop, all others kept.

Edge cases: a NULL or empty text is one empty line; a key shorter than ``min_chars`` is never dropped; identical rows
(same id, same text) are one document for the counts and each get the same bitmap; rows with the same id but
different texts, and rows without an id, are different documents; an empty table gives an empty result. Only the id
and text columns are read, so extra columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import ASCII_SPACE, ascii_lower, hash128, let

MIN_CHARS = 1
MIN_DOCS = 10


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return ascii_lower(F.trim(line, F.lit(ASCII_SPACE)))


def _documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    base = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    r1, r2 = hash128(F.col("_id"), F.col("_text"))
    return base.withColumns({"_r1": r1, "_r2": r2})


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS,
                 min_chars: int = MIN_CHARS, keep: str = "none") -> DataFrame:
    """(_r1, _r2, drop_runs) for every document that loses a line.

    A key is repeated when ``min_docs`` documents have it. ``keep='none'`` drops all its lines; ``keep='first'``
    keeps its first occurrence by (id, position). ``drop_runs`` is array<struct<first, last>> of line numbers.
    """
    if keep not in ("none", "first"):
        raise ValueError("keep must be 'none' or 'first'")
    def hashed(line: Column) -> Column:
        def of(key: Column) -> Column:
            h1, h2 = hash128(key)
            return F.struct((F.length(key) >= min_chars).alias("counts"), h1.alias("h1"), h2.alias("h2"))
        return let(line_key(line), of)

    order = ["h1", "h2", "_id", "_r1", "_r2"]
    streamed = (_documents(docs, id_col, text_col)
                .select("_id", "_r1", "_r2", F.posexplode(F.transform(_lines(F.col("_text")), hashed)).alias("pos", "k"))
                .where("k.counts").select("k.h1", "k.h2", "_id", "_r1", "_r2", "pos")
                .repartitionByRange(*order).sortWithinPartitions(*order, "pos"))
    held = streamed.groupBy(*order).agg(F.min("pos").alias("pos"))
    repeated = held.groupBy("h1", "h2").agg(
        F.count(F.lit(1)).alias("n_docs"),
        *([F.min(F.struct("_id", "_r1", "_r2", "pos")).alias("first")] if keep == "first" else []))
    hit = streamed.join(repeated.where(F.col("n_docs") >= min_docs), ["h1", "h2"])
    if keep == "first":
        hit = hit.where(~F.struct("_id", "_r1", "_r2", "pos").eqNullSafe(F.col("first")))
    per_doc = hit.groupBy("_r1", "_r2").agg(F.array_sort(F.collect_set("pos")).alias("at"))
    starts = F.filter("at", lambda p, i: (i == 0) | (p - F.get("at", i - 1) > 1))
    ends = F.filter("at", lambda p, i: (i == F.size("at") - 1) | (F.get("at", i + 1) - p > 1))
    return per_doc.select("_r1", "_r2", F.arrays_zip(starts.alias("first"), ends.alias("last")).alias("drop_runs"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with drop_runs, n_lines, n_dropped and kept_text (a column of one of these names is replaced)."""
    r1, r2 = hash128(F.col(id_col), F.col(text_col))
    runs = F.coalesce("drop_runs", F.expr("array()").cast(bitmaps.schema["drop_runs"].dataType))
    own = docs.drop("drop_runs").withColumns({"_r1": r1, "_r2": r2}).join(bitmaps, ["_r1", "_r2"], "left")
    own = own.withColumns({"drop_runs": runs, "_lines": _lines(F.col(text_col))})
    kept = F.filter("_lines", lambda _, i: ~F.exists("drop_runs", lambda r: i.between(r["first"], r["last"])))
    n_dropped = F.aggregate("drop_runs", F.lit(0).cast("long"), lambda n, r: n + r["last"] - r["first"] + 1)
    return own.withColumns({
        "n_lines": F.size("_lines").cast("long"), "n_dropped": n_dropped,
        "kept_text": F.when(F.size("drop_runs") == 0, F.coalesce(F.col(text_col), F.lit("")))
                      .otherwise(F.array_join(kept, "\n")),
    }).drop("_r1", "_r2", "_lines")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS,
                min_chars: int = MIN_CHARS, keep: str = "none") -> DataFrame:
    """The id of every document with n_lines, n_dropped, drop_runs and its kept text."""
    own = docs.select(F.col(id_col), F.col(text_col))
    bitmaps = keep_bitmaps(own, id_col, text_col, min_docs, min_chars, keep)
    return apply_bitmaps(own, bitmaps, id_col, text_col).select(
        id_col, "n_lines", "n_dropped", "drop_runs", "kept_text")
