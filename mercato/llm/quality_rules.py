"""Quality rules: per-document counts, then cross-document line frequency within a host.

Base rules need the document alone and are computed in the scan. The second rule hashes normalised lines and counts,
per host (``source``), in how many distinct texts a line stands. A line at the limit is boilerplate and is taken
out; a document that loses more than ``max_removed`` percent of its words that way is depleted and rejected. Exact
copies of one text count once: being copied does not make a document's own lines boilerplate.

Edge cases: NULL or empty texts have no words and fail the base rule; a NULL host is a host of its own; repeated rows
and ids each keep a row; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import ASCII_SPACE, ascii_lower, hash128, let, stage

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PCT = 30
#: A line is boilerplate on a host when at least so many of its distinct texts hold it, however large the host.
LINE_MIN_DOCS = 20
#: Depleted: the boilerplate lines hold more than this share of the words.
MAX_REMOVED_PCT = 80
#: Boilerplate lines (16 bytes each) that may be broadcast.
BROADCAST_LINES = 500_000


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "c")


def words(text: Column) -> Column:
    """The ``[^\\x20\\x09-\\x0D]+`` words of a text; none for NULL or blank."""
    cut = F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", -1)
    return F.filter(cut, lambda w: w != "")


def _windows(w: Column) -> Column:
    """The hash of each run of eight words, by way of pair hashes; NULL for fewer words."""
    pairs = let(w, lambda x: F.transform(x, lambda y, i: F.xxhash64(y, F.get(x, i + 1))))
    return let(pairs, lambda h: F.when(F.size(h) >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.size(h) - WINDOW),
        lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(0, WINDOW, 2)]))))


def _repeated_words(hashes: Column) -> Column:
    """The words that windows found twice or more cover. Only hashes that are not all distinct are sorted."""
    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - p, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda x, y: x + y)

    def positions(by_hash: Column) -> Column:
        again = F.filter(by_hash, lambda x, k: (F.get(by_hash, k - 1)["h"] == x["h"])
                         | (F.get(by_hash, k + 1)["h"] == x["h"]))
        return F.array_sort(F.transform(again, lambda x: x["i"]))

    def of(h: Column) -> Column:
        by_hash = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) < F.size(h), let(let(by_hash, positions), covered))

    return F.coalesce(let(hashes, of), F.lit(0).cast("long"))


def base_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed.

    Repeated windows are found inside the row: a hash is of the eight words themselves (array elements, 64 bits), the
    positions covered are the merged intervals.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.trim(x, F.lit(ASCII_SPACE)) != "")
    dup = let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))
    counts = let(words(F.col(text_col)), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        _repeated_words(_windows(w)).alias("n_repeat_words")))
    # inline() keeps filters on the counts above them, so that they are worked out once
    made = F.array(F.struct(counts.alias("c"), dup.alias("n_dup_lines"),
                            F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols")))
    df = docs.drop(*COUNTS).select("*", F.inline(made)).select(
        *[c for c in docs.columns if c not in COUNTS], "c.*", "n_dup_lines", "n_symbols")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))
    return df.withColumn("base_failed", failed)


def normalised_line(line: Column) -> Column:
    """Stripped, A-Z lower-cased, digit runs as one 0, white-space runs as one space."""
    plain = let(F.trim(line, F.lit(ASCII_SPACE)), lambda x: F.when(
        x.rlike(r"[0-9\x09-\x0D]|  "),
        F.regexp_replace(F.regexp_replace(x, r"[0-9]+", "0"), r"[\x20\x09-\x0D]+", " ")).otherwise(x))
    return let(plain, ascii_lower)


def _with_unit(docs: DataFrame, text_col: str, host_col: str) -> DataFrame:
    u1, u2 = hash128(F.col(host_col), F.col(text_col))
    return docs.withColumns({"_u1": u1, "_u2": u2})


def _line_hashes(line: Column, host: Column) -> Column:
    """The hashes of a host's normalised line; NULL for a blank one."""
    def of(x: Column) -> Column:
        h1, h2 = hash128(host, x)
        return F.when(x != "", F.struct(h1.alias("h1"), h2.alias("h2")))
    return let(normalised_line(line), of)


def boilerplate(docs: DataFrame, text_col: str = "text", host_col: str = "source",
                min_docs: int = LINE_MIN_DOCS) -> DataFrame:
    """(_u1, _u2, boiler_lines) of the distinct (host, text) pairs with boilerplate lines: the hashes of those lines.

    The lines above the limit are written first. When a bounded count shows that they are few, they are broadcast to
    the texts, and only the lines found move; beyond it both sides are shuffled, one row for each line of a text.
    """
    own = _with_unit(docs.select(F.col(host_col).alias("_host"), F.col(text_col).alias("_text")), "_text", "_host")
    lines = (own.select("_u1", "_u2", F.explode(F.transform(
        F.split("_text", "\n", -1), lambda x: _line_hashes(x, F.col("_host")))).alias("x"))
        .where("x IS NOT NULL").select("_u1", "_u2", "x.h1", "x.h2"))
    # one row for each line of a text, however often the text or the line is repeated; salted over texts, so a line
    # held by a third of them is no hot group
    held = lines.distinct()
    common = stage(held.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs"))
                   .where(F.col("n_docs") >= min_docs).select("h1", "h2"), "boilerplate")
    few = common.limit(BROADCAST_LINES + 1).count() <= BROADCAST_LINES
    found = (lines.join(F.broadcast(common), ["h1", "h2"], "left_semi") if few
             else held.join(common, ["h1", "h2"], "left_semi"))
    return found.groupBy("_u1", "_u2").agg(F.collect_set(F.struct("h1", "h2")).alias("boiler_lines"))


def quality_rules(docs: DataFrame, text_col: str = "text", host_col: str = "source", min_docs: int = LINE_MIN_DOCS,
                  max_removed_pct: int = MAX_REMOVED_PCT) -> DataFrame:
    """``docs`` with the base counts, base_failed, boiler_words, kept and kept_text, the text without its boilerplate
    lines; columns of these names are replaced. The counts are those of the whole text."""
    docs = docs.drop("boiler_words", "boiler_lines", "kept", "kept_text")
    counted = _with_unit(base_counts(docs, text_col), text_col, host_col)
    out = counted.join(boilerplate(docs, text_col, host_col, min_docs), ["_u1", "_u2"], "left")
    left = F.filter(F.split(text_col, "\n", -1), lambda x: let(
        _line_hashes(x, F.col(host_col)), lambda h: h.isNull() | ~F.array_contains("boiler_lines", h)))
    out = out.withColumn("kept_text", F.when(F.col("boiler_lines").isNull(), F.col(text_col))
                         .otherwise(F.array_join(left, "\n")))
    boiler = F.when(F.col("boiler_lines").isNull(), F.lit(0).cast("long")) \
              .otherwise(F.col("n_words") - F.size(words(F.col("kept_text"))))
    out = out.withColumn("boiler_words", boiler)
    depleted = 100 * F.col("boiler_words") > max_removed_pct * F.col("n_words")
    return out.withColumn("kept", ~F.col("base_failed") & ~depleted).drop("_u1", "_u2", "boiler_lines")
