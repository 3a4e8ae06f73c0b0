"""Toxicity: a weighted lexicon matched by Aho-Corasick.

Texts are folded first: compatibility forms and look-alike letters of other scripts become Latin letters, digits and
signs beside letters become the letters they stand for, invisible characters go, and all other characters, numbers
among them, become spaces. The lexicon holds word beginnings; each has the log ratio of its document shares in toxic and other labelled
texts. Exception phrases (given, or learnt: words and word pairs with a lexicon entry that clean texts have as well)
cancel the matches they cover. The summed weights, plain and per hundred words, go through a logistic curve.

Learnt on at most ``MAX_TRAIN_ROWS`` labelled rows (documented bound): terms are counted in Spark, the driver gets the
terms that enough toxic texts have. Scoring is one pass over all rows and whole texts.

Edge cases: NULL and empty texts have no match and get the score of the intercept; without rows of both classes every
score is the share of label 1, or 0 without labels; repeated rows score alike; NULL ids are carried through; an empty
table gives an empty result. Only the id and text columns are read.
"""

from __future__ import annotations

import math
import re
import unicodedata
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import map_texts
from mercato.llm.labels import held_out, training_sample
from mercato.llm.quality_model import fit_logistic

MAX_TRAIN_ROWS = 12_000
THRESHOLD = 0.7
PREFIX = (3, 10)
#: A term enters the lexicon when so many toxic texts have it and its share there is so many times that elsewhere.
MIN_TEXTS = 5
MIN_RATIO = 20.0
#: A word or word pair is an exception when its own ratio is below this and so many clean texts have it.
EXCEPTION_RATIO, EXCEPTION_TEXTS = 3.0, 3
EXCEPTIONS: tuple[str, ...] = ()

# Letters that look like a Latin letter (Cyrillic, Greek, Armenian, phonetic and small capital letters,
# letters with a stroke), and digits or signs written for letters.
LOOK_ALIKES = {
    "a": "аαɑᴀ", "b": "вβʙ", "c": "сϲᴄ", "d": "ԁᴅđ", "e": "еёεᴇ", "g": "ɡɢց", "h": "һнհʜħ", "i": "іїιɩıɪ", "j": "јϳᴊ",
    "k": "кκᴋ", "l": "ӏʟł", "m": "мᴍ", "n": "ηոɴ", "o": "оοօøᴏ", "p": "рρᴘ", "q": "ԛզ", "r": "ʀ", "s": "ѕꜱ", "t": "тτᴛŧ",
    "u": "υսᴜ", "v": "ѵνᴠ", "w": "ԝωᴡ", "x": "хχ", "y": "уүγʏ", "z": "ᴢ"}
HOMOGLYPHS = {like: letter for letter, likes in LOOK_ALIKES.items() for like in likes}
DIGITS = dict(zip("013457@", "oieasta", strict=True))
_SIGNS = {"$": "s", "!": "i", "|": "l"}
_LETTER = r"[^\W\d_]"
#: Signs that stand for letters: one ! or | beside a letter inside a word; any run of $ before a letter or behind one,
#: unless a number follows (a price), or behind an @ at the end of a word.
_SIGN = re.compile(rf"(?<={_LETTER})[!|](?=\w)|(?<=\w)[!|](?={_LETTER})"
                   rf"|(?<!\$)\$++(?={_LETTER})|(?<={_LETTER})\$++(?!\d)|(?<=@)\$++(?!\w)")
#: Numbers: digits (or @) with no letter on either side.
_NUMBER = re.compile(r"(?<![^\W_])(?<!@)[\d@]++(?![^\W_])")


class _Folding(dict):
    """Code point -> folded text, worked out once for each code point met."""

    def __missing__(self, point: int) -> str:
        c = chr(point)
        category = unicodedata.category(c)
        if category in ("Cf", "Mn") or point == 0xAD:
            out = ""
        else:
            c = unicodedata.normalize("NFKC", c).lower()
            out = "".join(HOMOGLYPHS.get(x, DIGITS.get(x, x)) for x in c)
            out = "".join(x if x.isalpha() else " " for x in out)
        self[point] = out
        return out


_FOLD = _Folding()


def fold(text: str | None) -> str:
    """The folded text with one space at both ends."""
    text = unicodedata.normalize("NFC", text or "")
    if "$" in text or "!" in text or "|" in text:
        text = _SIGN.sub(lambda m: "".join(_SIGNS[c] for c in m[0]), text)
    text = _NUMBER.sub(" ", text)
    return f" {text.translate(_FOLD)} "


def terms(folded: str) -> set[str]:
    """Word beginnings of the lengths that the lexicon may hold, and whole words."""
    found = set()
    for w in set(folded.split()):
        found.update(w[:n] for n in range(PREFIX[0], min(PREFIX[1], len(w)) + 1))
    return found


class Lexicon:
    """Weighted word beginnings and exception phrases in one automaton."""

    def __init__(self, weights: dict[str, float], exceptions: list[str], curve: np.ndarray) -> None:
        self.weights, self.exceptions, self.curve = weights, exceptions, curve
        self._machine = None

    def __getstate__(self) -> tuple:
        return self.weights, self.exceptions, self.curve

    def __setstate__(self, state: tuple) -> None:
        self.__init__(*state)

    def machine(self) -> ahocorasick.Automaton:
        if self._machine is None:
            entries: dict[str, tuple[float | None, int]] = {f" {t}": (w, len(t)) for t, w in self.weights.items()}
            entries |= {f" {p} ": (None, len(p) + 2) for p in self.exceptions}
            machine = ahocorasick.Automaton()
            for key, value in entries.items():
                machine.add_word(key, value)
            machine.make_automaton()
            self._machine = machine
        return self._machine

    def total(self, folded: str) -> float:
        """The summed weights of the matches that no exception covers."""
        if not self.weights:
            return 0.0
        hits, holes = [], []
        for end, (weight, size) in self.machine().iter(folded):
            if weight is None:
                holes.append((end - size + 1, end))
            else:
                hits.append((end - size, end, weight))
        if holes:
            # of the exceptions that begin no later than a match, the one that reaches furthest covers it or none does
            holes.sort()
            starts = [a for a, _ in holes]
            reach = list(accumulate((b for _, b in holes), max))
            hits = [h for h in hits if not (i := bisect_right(starts, h[0])) or reach[i - 1] < h[1]]
        return sum(w for _, _, w in hits)

    def signals(self, text: str | None) -> tuple[float, float]:
        folded = fold(text)
        total = self.total(folded)
        return math.log1p(total), math.log1p(100 * total / max(folded.count(" "), 1)) if total else 0.0

    def score(self, text: str | None) -> float:
        a, b = self.signals(text)
        z = self.curve[0] * a + self.curve[1] * b + self.curve[2]
        return 1 / (1 + math.exp(-min(max(z, -30), 30)))


def _count(sample: DataFrame, phrases_of: list[str] | None) -> DataFrame:
    """(term, toxic, clean): in how many texts of each class a term stands; counted in each batch first.

    With ``phrases_of``, the terms are the words and word pairs that begin with one of these entries.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        starts = tuple(phrases_of or ())
        for b in batches:
            counts = Counter(), Counter()
            for text, label in zip(b["_text"], b["_label"], strict=True):
                folded = fold(text)
                if phrases_of is None:
                    found = terms(folded)
                else:
                    words = folded.split()
                    found = {w for w in words if w.startswith(starts)}
                    found |= {f"{x} {y}" for x, y in zip(words, words[1:]) if x in found or y in found}
                counts[int(label == 1)].update(found)
            both = list(counts[1].keys() | counts[0].keys())
            yield pd.DataFrame({"term": both, "toxic": [counts[1][t] for t in both],
                                "clean": [counts[0][t] for t in both]})

    return (sample.mapInPandas(run, "term string, toxic long, clean long")
            .groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))


def _ratio(toxic: int, clean: int, n_toxic: int, n_clean: int) -> float:
    return ((toxic + 0.5) / (n_toxic + 1)) / ((clean + 0.5) / (n_clean + 1))


def learn(sample: DataFrame, exceptions: tuple[str, ...] = EXCEPTIONS) -> Lexicon:
    given = [fold(p).strip() for p in exceptions]
    n = {int(r["_label"]): r["n"] for r in sample.groupBy("_label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = n.get(1, 0), sum(v for k, v in n.items() if k != 1)
    if not n1 or not n0:
        share = n1 / max(n1 + n0, 1)
        return Lexicon({}, given, np.array([0.0, 0.0, math.log((share + 1e-6) / (1 - share + 1e-6))]))
    counted = _count(sample, None).where(F.col("toxic") >= MIN_TEXTS)
    found = {}
    for r in counted.where((F.col("toxic") + 0.5) * (n0 + 1) >= MIN_RATIO * (F.col("clean") + 0.5) * (n1 + 1)).collect():
        found[r["term"]] = math.log(_ratio(r["toxic"], r["clean"], n1, n0))
    weights = {t: w for t, w in sorted(found.items()) if not any(t[:k] in found for k in range(1, len(t)))}
    learnt = []
    if weights:
        phrases = _count(sample, list(weights)).where(F.col("clean") >= EXCEPTION_TEXTS).collect()
        learnt = [r["term"] for r in phrases if _ratio(r["toxic"], r["clean"], n1, n0) < EXCEPTION_RATIO]
    lexicon = Lexicon(weights, sorted({*given, *learnt}), np.zeros(3))

    def start():
        return lambda texts: (dict(zip("ab", lexicon.signals(t))) for t in texts)

    rows = map_texts(sample, "_text", ["_order", "_label"], start, {"a": "double", "b": "double"}).toPandas()
    rows = rows.sort_values("_order", kind="stable")
    lexicon.curve = fit_logistic(rows[["a", "b"]].to_numpy(), (rows["_label"] == 1).to_numpy(dtype=float))
    return lexicon


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "toxic", max_rows: int = MAX_TRAIN_ROWS,
                   exceptions: tuple[str, ...] = EXCEPTIONS) -> DataFrame:
    """(id, held_out, score, predicted) of every row."""
    lexicon = learn(training_sample(docs, labels, label_col, max_rows, id_col, text_col), exceptions)

    def start():
        return lambda texts: ({"score": lexicon.score(t)} for t in texts)

    out = map_texts(docs, text_col, [id_col], start, {"score": "double"})
    return out.select(id_col, held_out(id_col).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
