"""The registered queries of the corpus operators, over the whole tables, and their SQL where it can be written."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm import (bpe, collocations, decontamination, html_text, line_dedup, ngram_join, periodic_runs,
                         quality_model, quality_rules, sharding, token_counts, toxicity, warc)
from mercato.llm.common import table

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard_rows(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    folder, blocks = warc.archive_pages(spark, pages)
    kind = pages.schema["page_id"].dataType
    out = warc.read_records(warc.read_blocks(blocks, folder), folder)
    return out.select(F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                      F.col("refers_to").cast(kind).alias("refers_to"))


def op4_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"),
                                     any_case=True)
    return out.select("doc_id", "item_id", "n_windows", "item_windows", "reparameterised")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.quality_rules(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      "kept", "boiler_words")


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_main_text(table(spark, sf_dir, "pages"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"), VOCABULARY, public_tokenizers.PATTERN,
                                with_ids=False)


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.linked_components(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), WORD_VOCABULARY)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine_phrases(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    out = periodic_runs.find_runs(docs, tile=F.when(h % 10 == 0, F.floor(h / 10)))
    runs = F.arrays_zip("starts", "lengths", "periods")
    best = F.array_max(F.transform(runs, lambda r: F.struct(r["lengths"].alias("length"), (-r["starts"]).alias("at"),
                                                            (-r["periods"]).alias("per"))))
    lines = F.transform(runs, lambda r: F.concat_ws(",", r["starts"], r["lengths"], r["periods"]))
    return (out.withColumn("best", best)
            .select("doc_id", F.size("starts").cast("long").alias("n_runs"), (-F.col("best.at")).alias("start"),
                    F.col("best.length").alias("length"), (-F.col("best.per")).alias("period"),
                    F.expr("1000 * best.length div -best.per").alias("exponent_milli"),
                    F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256)
                    .alias("runs_sha256"), F.sha2("collapsed_text", 256).alias("collapsed_sha256")))


QUERIES = {f.__name__: f for f in (op1_line_dedup, op2_sharding, op3_warc, op4_quality_model, op5_decontamination,
                                   op6_quality_rules, op7_html_text, op8_bpe, op9_ngram_join, op10_toxicity, op11_token_counts,
                                   op12_collocations, op13_periodic_runs)}

ORACLES: dict[str, str] = {"op1_line_dedup": """
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents
), k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), r AS (SELECT key AS repeated FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
f AS (SELECT k.*, repeated IS NOT NULL AS dropped FROM k LEFT JOIN r ON key = repeated)
SELECT doc_id, count(*) AS n_lines, CAST(sum(dropped::INT) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM f GROUP BY doc_id""",
    "op12_collocations": """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                             'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
), w AS (
  SELECT lang, list_filter(string_split_regex(piece, '[ \\t]+'), lambda x: x <> '') AS w FROM pieces
), g AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM w, (SELECT unnest([1, 2, 3, 4]) AS k)
), f AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL),
c AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND a >= 30),
cuts AS (
  SELECT lang, k, phrase, a, j, array_to_string(w[1:j], ' ') AS first_part, array_to_string(w[j + 1:], ' ') AS rest
  FROM c, (SELECT unnest([1, 2, 3]) AS j) WHERE j < k
), scored AS (
  SELECT cuts.lang, cuts.phrase, cuts.a, x.a AS l, y.a AS r,
         (2000000 * cuts.a::HUGEINT) // (x.a + y.a) AS score, j
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = first_part AND x.k = j
            JOIN f y ON y.lang = cuts.lang AND y.phrase = rest AND y.k = cuts.k - j
), best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
sub AS (
  SELECT lang, a, unnest(list_transform(range(1, k - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase
  FROM c, (SELECT unnest([2, 3]) AS m) WHERE m < k
), cover AS (SELECT lang, phrase, max(a) AS around FROM sub GROUP BY ALL),
kept AS (
  SELECT best.* FROM best LEFT JOIN cover ON cover.lang = best.lang AND cover.phrase = best.phrase
  WHERE around IS NULL OR 100 * around < 80 * a
), n AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang)
SELECT kept.lang, row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score::BIGINT AS score
FROM kept JOIN n ON n.lang = kept.lang
QUALIFY row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, a DESC, phrase) <= 2000"""}
