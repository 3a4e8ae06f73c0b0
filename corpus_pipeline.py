"""The corpus pipeline: five stages from raw documents to token ids, each written before the next reads it.

Quality rules drop rejected documents and take boilerplate lines out of the others, line dedup takes out repeated
lines, the n-gram join keeps one document of each group of near copies, decontamination drops documents with benchmark
passages, and the last stage encodes the rest.
All stages but the last return the columns of ``documents``; n_chars follows the text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm import bpe, decontamination, line_dedup, ngram_join, quality_rules
from mercato.llm.common import hash128, stage, table

#: Near copies: word 5-grams at 80 percent Jaccard similarity or more.
NGRAM, SIMILARITY_PCT = 5, 80
VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = quality_rules.quality_rules(docs).where("kept")
    text = F.col("kept_text")
    return kept.withColumns({"text": text, "n_chars": F.length(text).cast("long")}).select(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs, keep="first"))
    text = F.when(F.col("n_dropped") > 0, F.col("kept_text")).otherwise(F.col("text"))
    return kept.withColumns({"text": text, "n_chars": F.length(text).cast("long")}).select(*docs.columns)


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component stays, that of the smallest id; so do rows without words.

    A row is known by its id and a hash of id and text, so different texts under one id are different documents; an
    identical row that stands several times stays once. A row without an id stays if no row of its component has one.
    """
    h1, h2 = hash128(F.col("doc_id"), F.col("text"))
    key = F.struct(F.col("doc_id").isNull().alias("without"), F.col("doc_id").alias("id"), h1.alias("h1"), h2.alias("h2"))
    found = stage(ngram_join.linked_components(docs.select(key.alias("key"), "text"), "key", n=NGRAM, pct=SIMILARITY_PCT),
                  "components").where("n_shingles > 0")
    row = [F.col("key.h1").alias("_h1"), F.col("key.h2").alias("_h2")]
    copies = found.where("key != component_id").select(*row).distinct()
    kept = docs.withColumns({"_h1": h1, "_h2": h2}).join(copies, ["_h1", "_h2"], "left_anti")
    repeated = found.where("key = component_id").groupBy(*row).count().where("count > 1").select("_h1", "_h2")
    if not repeated.isEmpty():
        once = kept.join(repeated, ["_h1", "_h2"], "left_semi").dropDuplicates(["_h1", "_h2"])
        kept = kept.join(repeated, ["_h1", "_h2"], "left_anti").unionByName(once)
    return kept.drop("_h1", "_h2")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"), any_case=True)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(docs, VOCABULARY, public_tokenizers.PATTERN)


STAGES = [("quality rules", quality_stage), ("line dedup", line_stage), ("n-gram join", near_copy_stage),
          ("decontamination", decontamination_stage), ("bpe", token_stage)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, f in STAGES[:-1]:
        docs = stage(f(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
