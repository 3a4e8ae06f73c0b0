"""Benchmark decontamination by templates.

Numbers, names (words capitalised inside a sentence) and units (after a number) are replaced by typed placeholders,
the rest is lower-cased and cut into words. Windows of ``WINDOW`` canonical words are
hashed and joined with the benchmark's windows, so a question with other numbers or names still meets its source. A
window needs ``MIN_LITERAL`` plain words to count. A window whose words are the item's own (upper and lower case are
one) counts as it is; with ``any_case`` such windows are also found where names cannot be told by their capitals. For
the others the slots are checked: when a value of the item stands for several values of the document within one
alignment, the windows with that slot are left out. An item is found in a document when the windows left make up
``MIN_COVER`` percent of the item's windows, or when words that they cover in a row hold ``MIN_RUN`` plain ones, however
long the item is.

The benchmark side is broadcast only after a bounded count; beyond it the windows are joined by shuffle. All is
column expressions; no Python runs on rows.

Edge cases: NULL or empty texts and texts under ``WINDOW`` words have no windows and are never found; an item under
``WINDOW`` words, or without a countable window, finds nothing; repeated rows are found alike; NULL ids are carried
through; an empty table on either side gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import broadcast_if_small, hash128, let, stage

WINDOW = 8
MIN_LITERAL = 4
MIN_COVER = 50
#: Plain words in a row that make a document contaminated, whatever share of the item they are.
MIN_RUN = 13
#: Rows of the benchmark side (40 bytes each) that may be broadcast.
BROADCAST_ROWS = 500_000
#: Row hashes (16 bytes each) that may be broadcast to filter the texts.
BROADCAST_IDS = 1_000_000
# Units of measure and money.
UNITS = ("mm", "cm", "m", "km", "inch", "inches", "foot", "feet", "yard", "yards", "mile", "miles", "mg", "g", "kg",
         "ton", "tons", "pound", "pounds", "ounce", "ounces", "ml", "l", "litre", "litres", "liter", "liters",
         "second", "seconds", "minute", "minutes", "hour", "hours", "day", "days", "week", "weeks", "month", "months",
         "year", "years", "percent", "degree", "degrees", "dollar", "dollars", "euro", "euros", "cent", "cents")


# One character of the private use area for each placeholder, so that no plain word can equal one.
NUM, NAME, UNIT = "\ue000", "\ue001", "\ue002"
_NUMBER = r"\d+(?:[.,]\d+)*"
# capitalised inside a sentence: it follows a letter, digit or comma and white space; all-capital words are no names
_NAME = r"\p{Lu}(?<=[\p{L}\p{N},;]\s\p{Lu})\p{Ll}[\p{L}\p{M}]*"
_CUT = r"[^\p{L}\p{M}\p{N}\ue000-\ue002]+"


def plain_words(text: Column) -> Column:
    """The words of a text as they are, lower-cased; a number is one word."""
    x = F.regexp_replace(F.coalesce(text, F.lit("")), r"(?<=\d)[.,](?=\d)", "\u0301")
    return F.filter(F.split(F.lower(x), _CUT, -1), lambda w: w != "")


def template_words(text: Column) -> Column:
    """The words of a text with numbers, names and units replaced; stands word by word beside ``plain_words``."""
    x = F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), _NAME, NAME), _NUMBER, NUM)
    x = F.regexp_replace(x, rf"{NUM}([^\p{{L}}\p{{N}}]{{0,2}})(?:{'|'.join(UNITS)})(?![\p{{L}}\p{{N}}])", f"{NUM}$1{UNIT}")
    return F.filter(F.split(F.lower(x), _CUT, -1), lambda w: w != "")


def _hashes(words: Column) -> Column:
    """One hash for each run of ``WINDOW`` template words; NULL for fewer words. Pairs are hashed first, four pairs
    make a window: far fewer reads for each window than its eight words."""
    pairs = let(words, lambda w: F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1))))
    return let(pairs, lambda h: F.when(F.size(h) >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.size(h) - WINDOW),
        lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(0, WINDOW, 2)]))))


def _windows(text: Column, any_case: bool) -> Column:
    """array<struct<at, window>>: the template windows and, with ``any_case``, the plain ones that differ from them."""
    def numbered(hashes: Column) -> Column:
        return F.transform(hashes, lambda x, i: F.struct(i.alias("at"), x.alias("window")))

    def plain(types: Column) -> Column:
        return let(_hashes(plain_words(text)), lambda h: F.concat(
            numbered(types), F.filter(numbered(h), lambda s: s["window"] != F.get(types, s["at"]))))

    return let(_hashes(template_words(text)), lambda x: plain(x) if any_case else numbered(x))


def benchmark_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
                      any_case: bool = False) -> DataFrame:
    """(item, item_words, item_types, j, window, item_windows): the countable windows of the distinct items."""
    items = benchmark.select(F.col(id_col).alias("item"), F.col(text_col).alias("_text")).distinct()
    rows = items.select("item", plain_words(F.col("_text")).alias("item_words"),
                        template_words(F.col("_text")).alias("item_types"),
                        F.inline(_windows(F.col("_text"), any_case)).alias("j", "window"))
    literal = F.size(F.filter(F.slice("item_types", F.col("j") + 1, WINDOW), lambda t: ~t.isin(NUM, NAME, UNIT)))
    rows = rows.where(literal >= MIN_LITERAL)
    total = rows.groupBy(F.col("item").alias("_item")).agg(F.countDistinct("j").alias("item_windows"))
    return rows.join(total, F.col("item").eqNullSafe(F.col("_item"))).drop("_item")


def _with_hash(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    r1, r2 = hash128(F.col(id_col), F.col(text_col))
    return docs.withColumns({"_r1": r1, "_r2": r2})


def _longest_run(kept: Column) -> Column:
    """The most plain words in a row under windows of one alignment; windows up to ``WINDOW`` words apart touch."""
    start = F.struct(F.lit(-2 * WINDOW).alias("last"), F.lit(0).alias("since"), F.lit(0).alias("most"))

    def step(at: Column, w: Column) -> Column:
        since = F.when(w["j"] - at["last"] <= WINDOW, at["since"]).otherwise(w["plain_before"])
        return F.struct(w["j"].alias("last"), since.alias("since"),
                        F.greatest(at["most"], w["plain_to_end"] - since).alias("most"))

    return F.aggregate(F.array_sort(kept), start, step, lambda at: at["most"])


def _found(own: DataFrame, bench: DataFrame, min_cover: int, min_run: int, any_case: bool) -> DataFrame:
    """(_r1, _r2, item, n_windows, item_windows, reparameterised) of the documents ``own`` (_text, _r1, _r2).

    The hits are written once. Of the documents with hits, only the words under those hits go on, eight a row.
    """
    windows = own.select("_r1", "_r2", F.inline(_windows(F.col("_text"), any_case)).alias("i", "window"))
    side = bench.select("item", "j", "window")
    hits = stage(windows.join(broadcast_if_small(side, BROADCAST_ROWS), "window")
                 .select("_r1", "_r2", "item", "i", "j").distinct(), "window-hits")

    ids = broadcast_if_small(hits.select("_r1", "_r2").distinct(), BROADCAST_IDS)
    at = hits.groupBy("_r1", "_r2").agg(F.collect_set("i").alias("at"))
    texts = own.select("_r1", "_r2", "_text").join(ids, ["_r1", "_r2"], "left_semi")
    under = let(plain_words(F.col("_text")), lambda w: F.transform(
        "at", lambda i: F.struct(i.alias("i"), F.slice(w, i + 1, WINDOW).alias("doc_words"))))
    # repeated rows have the same hash and the same words
    words = (texts.join(at, ["_r1", "_r2"]).select("_r1", "_r2", F.inline(under))
             .dropDuplicates(["_r1", "_r2", "i"]))
    def plain(to: Column) -> Column:
        return F.size(F.filter(F.slice("item_types", F.lit(1), to), lambda t: ~t.isin(NUM, NAME, UNIT)))

    items = bench.select("item", "j", plain(F.col("j")).alias("plain_before"),
                         plain(F.col("j") + WINDOW).alias("plain_to_end"),
                         F.slice("item_words", F.col("j") + 1, WINDOW).alias("item_words"),
                         F.slice("item_types", F.col("j") + 1, WINDOW).alias("item_types"), "item_windows").distinct()
    same = F.col("h.item").eqNullSafe(F.col("b.item")) & (F.col("h.j") == F.col("b.j"))
    both = (hits.join(words, ["_r1", "_r2", "i"]).alias("h").join(items.alias("b"), same)
            .select("_r1", "_r2", "h.item", "i", "h.j", "doc_words", "item_words", "item_types", "item_windows",
                    "plain_before", "plain_to_end"))
    slots = F.transform(F.filter(F.sequence(F.lit(0), F.lit(WINDOW - 1)),
                                 lambda o: F.get("item_types", o).isin(NUM, NAME, UNIT)),
                        lambda o: F.struct(F.struct(F.get("item_types", o).alias("type"),
                                                    F.get("item_words", o).alias("value")).alias("slot"),
                                           F.get("doc_words", o).alias("stands")))
    window = F.struct("j", "plain_before", "plain_to_end",
                      (F.col("doc_words") == F.col("item_words")).alias("verbatim"), slots.alias("slots"))
    lined = (both.groupBy("_r1", "_r2", "item", (F.col("i") - F.col("j")).alias("shift"))
             .agg(F.collect_set(window).alias("all"), F.first("item_windows").alias("item_windows")))
    # the slots with more than one value in the document
    slot = let(F.array_distinct(F.flatten(F.col("all.slots"))), lambda x: F.transform(x, lambda p: p["slot"]))
    torn = let(slot, lambda x: F.array_distinct(F.filter(x, lambda p, k: F.array_position(x, p) <= k)))
    kept = let(torn, lambda x: F.filter("all", lambda w: w["verbatim"] | ~F.arrays_overlap(
        F.transform(w["slots"], lambda p: p["slot"]), x)))
    lined = lined.withColumn("kept", kept).where(F.size("kept") > 0)
    return (lined.groupBy("_r1", "_r2", "item")
            .agg(F.size(F.array_distinct(F.flatten(F.collect_list("kept.j")))).cast("long").alias("n_windows"),
                 F.first("item_windows").alias("item_windows"),
                 F.max(F.exists("kept", lambda w: ~w["verbatim"])).alias("reparameterised"),
                 F.max(_longest_run(F.col("kept"))).alias("run"))
            .where((100 * F.col("n_windows") >= min_cover * F.col("item_windows")) | (F.col("run") >= min_run))
            .drop("run"))


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text", min_cover: int = MIN_COVER,
               min_run: int = MIN_RUN, any_case: bool = False) -> DataFrame:
    """One row for each (document, item) found: the ids, the document's row hash, windows and coverage in percent,
    and whether slot values differ (``reparameterised``)."""
    own = _with_hash(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")), "_id", "_text")
    found = _found(own, benchmark_windows(benchmark, item_col, item_text_col, any_case), min_cover, min_run, any_case)
    return (own.select("_id", "_r1", "_r2").join(found, ["_r1", "_r2"])
            .select(F.col("_id").alias(id_col), F.col("item").alias(item_col), "n_windows", "item_windows",
                    "reparameterised", "_r1", "_r2"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                      text_col: str = "text", any_case: bool = False) -> DataFrame:
    """``docs`` without those that hold a benchmark item."""
    own = _with_hash(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")), "_id", "_text")
    found = _found(own, benchmark_windows(benchmark, any_case=any_case), MIN_COVER, MIN_RUN, any_case)
    leaks = stage(found.select("_r1", "_r2").distinct(), "leaks")
    return _with_hash(docs, id_col, text_col).join(broadcast_if_small(leaks, BROADCAST_IDS), ["_r1", "_r2"],
                                                   "left_anti").drop("_r1", "_r2")
