"""Token counts, phrase collocations and periodic runs: exactness, hot keys and edge cases."""

import random
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer, normalizers, pre_tokenizers

from mercato.llm import collocations, periodic_runs, token_counts
from mercato.llm import queries as Q
from tests.llm import brute

DOCS = "doc_id long, text string, lang string"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(Q.WORD_VOCABULARY)


@pytest.fixture(scope="module")
def counts():
    return token_counts.Counts(open(Q.WORD_VOCABULARY, encoding="utf-8").read())


STRANGE = ["<|endoftext|>a<|endoftext|> b", "<|endoftext|", "Σας ΑΣ İ ǅ", "é Å İ", "日本語テキスト123",
           "\x1c\x1d a\x1cb", "😀 it's <|startoftext|>x", "ֈ꟎ a", "don't WE'LL '' 's", "<|x|> <<||>>", "",
           "a\u0085b c　d", " \t\n ", "x" * 50_000, "word " * 20_000, "½ ² ٣ 4", "<|startoftext|><|endoftext|>"]


def test_counts_of_strange_texts(counts, library):
    for text in STRANGE:
        assert counts.count(text) == len(library.encode(text, add_special_tokens=False).ids), text
    assert counts.count(None) == 0


def test_every_plain_letter_is_cut_and_lowered_as_by_the_library(counts, library):
    split, lower, nfc = library.pre_tokenizer, normalizers.Lowercase(), normalizers.NFC()
    letters = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and not token_counts.ODD.search(chr(c))]
    assert len(letters) > 30_000
    for c in letters:
        text = counts.normal(f"a{c}a{c}{c}1{c}-{c}")
        assert [len(w.encode()) for w in counts.find(text)] == [len(w) for w, _ in split.pre_tokenize_str(text)], c
        assert lower.normalize_str(c) == counts.normal(c) or unicodedata.normalize("NFC", c) != c
        assert nfc.normalize_str(c) == unicodedata.normalize("NFC", c)
    marks = [c for c in letters if unicodedata.combining(c)]
    for c in [c for c in letters if ord(c) < 0x530 and c.isalpha()]:
        for m in marks:
            assert nfc.normalize_str(c + m) == unicodedata.normalize("NFC", c + m)


def test_a_full_cache_and_a_table_change_no_count(library, monkeypatch):
    monkeypatch.setattr(token_counts, "CACHE_CHARS", 50)
    spec = open(Q.WORD_VOCABULARY, encoding="utf-8").read()
    small = token_counts.Counts(spec, ["the", "unbelievably"], bytes([1, 3]))
    rng = random.Random(3)
    for _ in range(50):
        text = " ".join("".join(rng.choices("abcde,'", k=rng.randint(1, 9))) for _ in range(40)) + " the"
        assert small.count(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_token_count_edges(spark):
    rows = [(1, None, "a"), (2, "", "a"), (None, "two words", "a"), (3, "two words", None), (3, "two words", None)]
    docs = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit("x") for c in ("n_tokens", "_text", "a.b")})
    got = token_counts.count_tokens(docs, Q.WORD_VOCABULARY, limit=1).collect()
    assert sorted((r["doc_id"] or 0, r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in got) == [
        (0, 9, 2, True), (1, 0, 0, False), (2, 0, 0, False), (3, 9, 2, True), (3, 9, 2, True)]
    assert token_counts.count_tokens(docs.limit(0), Q.WORD_VOCABULARY).count() == 0


@pytest.mark.parametrize("min_count,shard_words,range_windows", [(5, 3_000, 20_000), (2, 20_000, 2_000)])
def test_phrases_over_many_shards_and_ranges(spark, min_count, shard_words, range_windows):
    """Every phrase that crosses a bound is counted in several ranges; the more ranges, the more of them."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(4)
    got = collocations.mine_phrases(docs, min_count=min_count, shard_words=shard_words, range_windows=range_windows)
    want = brute.phrases([(r["lang"], r["text"]) for r in docs.select("lang", "text").collect()], min_count)
    assert sorted(map(tuple, got.collect())) == want


def test_phrase_edges(spark):
    rows = [(1, None, "en"), (2, "", None), (3, "A b\tC. a b c! A B c\x0bd", None), (3, "A b\tC. a b c! A B c\x0bd", None),
            (4, "é ü é ü é ü ... \n\n , ,", "fr"), (5, "b b b b b b b b", "de"), (6, "a\x00b \x00 a\x00b \x00", "x y")]
    docs = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit("x") for c in ("range", "n", "a.b", "phrase")})
    got = sorted(map(tuple, collocations.mine_phrases(docs, min_count=2).collect()))
    assert got == brute.phrases([(r[2], r[1]) for r in rows], 2) and len(got) == 5
    assert len(collocations.mine_phrases(docs, min_count=2, top=1).collect()) == len({r[0] for r in got})
    assert collocations.mine_phrases(docs.limit(0)).count() == 0


def test_hot_phrase_is_one_state_of_each_shard(spark):
    docs = spark.range(3_000).selectExpr("id AS doc_id", "concat('on the whole ', id % 7, ' on the') AS text",
                                         "'en' AS lang")
    got = collocations.mine_phrases(docs, shard_words=2_000, range_windows=1_000).collect()
    assert sorted(map(tuple, got)) == brute.phrases([(r["lang"], r["text"]) for r in docs.collect()])


def test_transducers():
    rng = random.Random(1)
    paths = [{tuple(rng.choice([b"a", b"b", b"cc"]) for _ in range(rng.randint(1, 4))): rng.randint(1, 300)
              for _ in range(30)} for _ in range(5)]
    parts = [collocations.Transducer.of_paths(p) for p in paths]
    total = brute.Counter()
    for p in paths:
        total.update(p)
    whole = collocations.Transducer.union([collocations.Transducer.from_bytes(t.to_bytes()) for t in parts])
    assert {p: w for p, w in whole.items() if w} == total
    for p, w in whole.items():
        assert whole.levels[len(p) - 1][2][whole.place(p)] == w
    assert whole.place((b"a", b"zz")) is None and whole.place((b"A",)) is None
    asked = collocations.Transducer.of_paths({(b"a", b"b"): 1, (b"zz",): 1, (b"cc", b"cc", b"a", b"b"): 1})
    assert all(w == total.get(p, 0) for p, w in whole.compose(asked).items())


def stream(words):
    return periodic_runs.stream_runs(np.array([*words, -1], dtype=np.int64), len(words))


def test_runs_by_brute_force():
    rng = random.Random(5)
    for _ in range(400):
        n, k = rng.randint(0, 120), rng.choice([1, 2, 2, 3, 5, 30])
        w = [rng.randint(1, k) for _ in range(n)]
        if n > 4 and rng.random() < 0.5:
            a, p = rng.randint(0, n - 1), rng.randint(1, max(1, n // 2))
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        assert stream(w) == brute.runs(w)


def test_runs_do_not_cross_documents():
    docs = [[1] * 11, [1] * 11, [1] * 12, [], [1, 2] * 6, [2, 1] * 6]
    ids = np.concatenate([np.array([*d, -1 - k], dtype=np.int64) for k, d in enumerate(docs)])
    assert [(q, n) for _, n, q in periodic_runs.stream_runs(ids, 12)] == [(1, 12), (2, 12), (2, 12)]


@pytest.mark.parametrize("n,p", [(100_000, 1), (100_000, 3), (90_001, 30_000), (131_072, 65_536)])
def test_long_runs(n, p):
    words = np.resize(np.random.default_rng(p).integers(1, 10_000, p), n)
    assert stream(words.tolist()) == [(0, n, p)]


def test_transform_is_a_convolution():
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, periodic_runs.PRIME, (2, 3, 16)).astype(np.uint64)
    got = periodic_runs.invert(periodic_runs.transform(a) * periodic_runs.transform(b) % np.uint64(periodic_runs.PRIME))
    for x, y, z in zip(a.tolist(), b.tolist(), got.tolist(), strict=True):
        assert z == [sum(x[i] * y[(k - i) % 16] for i in range(16)) % periodic_runs.PRIME for k in range(16)]


def test_run_edges(spark):
    rows = [(1, None, "a"), (2, "", "a"), (3, " \t\n", "a"), (None, "ha " * 30, "a"), (4, "ha " * 12, None),
            (4, "ha " * 12, None), (5, "ha " * 11, "a"), (6, "x y " * 20, "a")]
    docs = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit("x") for c in ("starts", "_in", "a.b", "n_words")})
    got = {(r["doc_id"], r["n_words"], tuple(zip(r["starts"], r["lengths"], r["periods"], strict=True)),
            r["collapsed_text"]) for r in periodic_runs.find_runs(docs).collect()}
    assert got == {(1, 0, (), ""), (2, 0, (), ""), (3, 0, (), ""), (None, 30, ((0, 30, 1),), "ha"),
                   (4, 12, ((0, 12, 1),), "ha"), (5, 11, (), " ".join(["ha"] * 11)),
                   (6, 20, ((0, 20, 1),), "x y")}
    assert periodic_runs.find_runs(docs.limit(0)).count() == 0
