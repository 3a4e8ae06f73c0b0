"""Labelled rows for training: which may be learnt from, and a bounded sample of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS, HELD_OUT = 3, 1


def held_out(id_col: str) -> Column:
    """crc32 of the id as text, mod 3, is 1. False for a NULL id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, label_col: str, max_rows: int, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(_text, _label, _order) of at most ``max_rows`` labelled rows outside the held-out fold.

    The rows are the first by a hash of the id, so the sample is the same in every run and at every layout.
    Ids with a NULL label or with contradicting labels are not learnt from.
    """
    known = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(id_col))
             .groupBy(F.col(id_col).alias("_id")).agg(F.min(label_col).alias("_label"), F.max(label_col).alias("_max"))
             .where("_label = _max").select("_id", F.col("_label").cast("int"), F.xxhash64("_id").alias("_order")))
    chosen = known.orderBy("_order", "_id").limit(max_rows)
    own = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    return own.join(F.broadcast(chosen), "_id").select("_text", "_label", "_order")
