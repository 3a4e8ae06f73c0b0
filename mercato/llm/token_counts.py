"""Token counts by a map-side two-tier lookup: a table of frequent pre-token lengths, and a cache in each worker.

A text's token count is the sum of the token counts of its pre-tokens, for the vocabulary merges inside pre-tokens
only. The most frequent pre-tokens of a bounded sample of rows get their lengths on the driver; the table is sent in
compact form (one blob of words, one byte of length each) and opened as a hash table by every worker. Words that it
lacks go through the worker's own cache and, if new there too, through the library's model. Nothing is shuffled by
pre-token, and the sample decides on speed only, never on a count.

Pre-tokens are cut by the expression of the tokenizer file after its normalisation (canonical composition, lower
case letter by letter). Both are done here for letters on whose class and case this Python and the library surely
agree (all but ``ODD``, which holds also four separators that only Python takes for white space); a text with an odd
letter is encoded whole by the library. The strings of special tokens count one token each, as the library takes them
by default.

Edge cases: NULL and empty texts have 0 bytes and 0 tokens; texts are never cut; repeated rows and NULL ids are
carried through; an empty table gives an empty result. Only the id and text columns are read.
"""

from __future__ import annotations

import json
import os.path
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import map_texts

#: Rows of the sample behind the table of frequent words, its parts, and the words that the table and a part keep.
SAMPLE_ROWS, SAMPLE_PARTS, TABLE_WORDS = 8_000, 8, 65_536
#: Characters of words a worker remembers beside the table; the store is emptied when it is full.
CACHE_CHARS = 8_000_000
#: All but fixed ranges of Latin, Greek, Cyrillic, punctuation, kana, Han and Hangul letters assigned long ago. The
#: tests compare every one of these with the library.
ODD = re.compile(r"[^\x00-\x1b\x20-ԯḀ-⁯₠-₹←-⇿∀-⋿　-ヿ"
                 r"一-龥가-힣]")

#: The letters that stand for bytes in such vocabularies. Printable bytes stand for themselves, the
#: others for the letters from 256 on.
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_LETTERS = {b: 256 + k for k, b in enumerate(sorted(set(range(256)) - set(_PRINTABLE)))}


class Counts:
    """Token counts of texts by one tokenizer file whose text is ``spec``, given the lengths of some pre-tokens."""

    def __init__(self, spec: str, words: Iterable[str] = (), lengths: bytes = b"") -> None:
        from tokenizers import Tokenizer
        parts = json.loads(spec)
        steps = parts["pre_tokenizer"]["pretokenizers"]
        kinds = [s["type"] for s in parts["normalizer"]["normalizers"]], [s["type"] for s in steps]
        if kinds != (["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]) or not steps[0]["invert"]:
            raise ValueError(f"normalisation or pre-tokens of another kind: {kinds}")
        self.find = regex.compile(steps[0]["pattern"]["Regex"]).findall
        special = sorted((t["content"] for t in parts["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.hint = os.path.commonprefix(special)
        self.whole = Tokenizer.from_str(spec)
        self.tokenize = self.whole.model.tokenize
        self.table = dict(zip(words, lengths, strict=True))
        self.seen = dict(self.table)  # the table and, beside it, what this worker has met
        self.held = 0

    def length(self, word: str) -> int:
        """Tokens of one pre-token."""
        return len(self.tokenize(word.encode().decode("latin-1").translate(BYTE_LETTERS)))

    def normal(self, text: str) -> str:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower()

    def _learn(self, piece: str) -> int:
        """The count of a piece between white space that was not met before, and of its new pre-tokens."""
        if self.held > CACHE_CHARS:
            self.seen = dict(self.table)
            self.held = 0
        total = 0
        for word in self.find(piece):
            n = self.seen.get(word)
            if n is None:
                n = self.seen[word] = self.length(word)
                self.held += len(word)
            total += n
        if piece not in self.seen:
            self.seen[piece] = total
            self.held += len(piece)
        return total

    def _plain(self, text: str) -> int:
        """Pre-tokens never span white space, so each piece between it is looked up first, then what it is made of."""
        total = 0
        for piece in self.normal(text).split():
            n = self.seen.get(piece)
            total += self._learn(piece) if n is None else n
        return total

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if ODD.search(text):
            return len(self.whole.encode(text, add_special_tokens=False))
        if self.special is None or self.hint not in text:
            return self._plain(text)
        return sum(1 for _ in self.special.finditer(text)) + sum(map(self._plain, self.special.split(text)))


def frequent_words(docs: DataFrame, text_col: str, spec: str) -> list[str]:
    """The ``TABLE_WORDS`` commonest pre-tokens of about ``SAMPLE_ROWS`` rows; the driver gets ``SAMPLE_PARTS`` lists."""
    rows = docs.count()
    if not rows:
        return []
    sample = docs.select(F.col(text_col).alias("_text")).sample(min(1.0, SAMPLE_ROWS / rows), seed=7)

    def top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, found = Counts(spec), Counter()
        for batch in batches:
            for text in batch.column("_text").to_pylist():
                if text and not ODD.search(text):
                    found.update(counts.find(counts.normal(text)))
        words, times = zip(*found.most_common(TABLE_WORDS), strict=True) if found else ((), ())
        yield pa.RecordBatch.from_pydict({"words": pa.array([words], pa.list_(pa.string())),
                                          "times": pa.array([times], pa.list_(pa.int64()))})

    total: Counter[str] = Counter()
    for row in sample.repartition(SAMPLE_PARTS).mapInArrow(top, "words array<string>, times array<long>").collect():
        total.update(dict(zip(row["words"], row["times"], strict=True)))
    return [w for w, _ in total.most_common(TABLE_WORDS)]


def count_tokens(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 2048) -> DataFrame:
    """The id of every document with n_bytes, n_tokens and over_limit (more than ``limit`` tokens).

    ``vocabulary`` is the path of a tokenizer file that normalises by composition and lower case and cuts pre-tokens
    by one expression; it is read on the driver and sent as text.
    """
    with open(vocabulary, encoding="utf-8") as f:
        spec = f.read()
    words = frequent_words(docs, text_col, spec)
    counts = Counts(spec)
    pairs = [(w, n) for w in words if (n := counts.length(w)) < 256]
    blob, sizes = "\n".join(w for w, _ in pairs), bytes(n for _, n in pairs)
    sent = docs.sparkSession.sparkContext.broadcast((spec, blob, sizes))

    def start():
        spec, blob, sizes = sent.value
        counts = Counts(spec, blob.split("\n") if sizes else [], sizes)

        def work(texts: list[str | None]) -> Iterable[dict]:
            for text in texts:
                n = counts.count(text)
                size = 0 if not text else len(text) if text.isascii() else len(text.encode())
                yield {"n_bytes": size, "n_tokens": n, "over_limit": n > limit}
        return work

    return map_texts(docs, text_col, [id_col], start, {"n_bytes": "long", "n_tokens": "long", "over_limit": "boolean"})
