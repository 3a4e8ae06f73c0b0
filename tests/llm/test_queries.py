"""Each corpus query over the whole sf0.001 tables against brute force, and its SQL where there is some."""

import hashlib
import html
import re

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from mercato.llm import queries as Q
from mercato.llm import sharding
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


@pytest.fixture(scope="module")
def docs(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


def rows(spark, name):
    return Q.QUERIES[name](spark, SF).collect()


def test_line_dedup(spark, docs):
    want = {i: (n, k, sha(t)) for i, n, k, t in brute.line_dedup(docs)}
    assert {r["doc_id"]: tuple(r)[1:] for r in rows(spark, "op1_line_dedup")} == want


def test_sharding(spark, docs):
    got = sorted(rows(spark, "op2_sharding"), key=lambda r: r["doc_id"])
    assert [r["doc_id"] for r in got] == sorted(i for i, _ in docs)
    by_shard = {}
    for r in got:
        by_shard.setdefault(r["shard"], []).append(r["slot"])
    assert sorted(by_shard) == list(range(16))
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    sizes = [len(s) for s in by_shard.values()]
    assert max(sizes) - min(sizes) <= 1
    for number, r in enumerate(got):
        assert sharding.row_of(r["shard"], r["slot"], len(got)) == number
    text = dict(docs)
    assert all(r["size"] == len((text[r["doc_id"]] or "").encode()) + 1 for r in got)


def test_warc(spark):
    pages = [(r["page_id"], r["html"]) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    assert {r["page_id"]: tuple(r)[1:] for r in rows(spark, "op3_warc")} == brute.payloads(pages)


@pytest.mark.parametrize("name,label,least", [("op4_quality_model", "quality", 0.95), ("op10_toxicity", "toxic", 0.85)])
def test_classifiers_on_held_out_labels(spark, docs, name, label, least):
    known = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = rows(spark, name)
    assert sorted(r["doc_id"] for r in got) == sorted(i for i, _ in docs)
    assert all(r["held_out"] == brute.held_out(r["doc_id"]) and 0 <= r["score"] <= 1 for r in got)
    line = 0.5 if label == "quality" else 0.7
    assert all(r["predicted"] == int(r["score"] >= line) for r in got)
    tested = [r for r in got if r["held_out"] and r["doc_id"] in known]
    right = sum(r["predicted"] == known[r["doc_id"]] for r in tested)
    assert right >= least * len(tested)


def test_decontamination(spark, docs):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert {(r["doc_id"], r["item_id"]) for r in rows(spark, "op5_decontamination")} == brute.leaks(docs, items)


def test_quality_rules(spark, docs):
    text = dict(docs)
    got = rows(spark, "op6_quality_rules")
    assert {r["doc_id"]: tuple(r)[1:7] for r in got} == {i: brute.base_counts(t) for i, t in docs}
    assert all(not (r["kept"] and r["base_failed"]) for r in got) and len(got) == len(text)


def test_html_text(spark):
    got = {r["page_id"]: r for r in rows(spark, "op7_html_text")}
    right = 0
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    for p in pages:
        article = re.search(r"<article>(.*)</article>", p["html"], re.S)[1]
        cut = re.split(r"</?(?:p|h1|h2|br|ul|li|div)\b[^>]*>", article)
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in cut]
        right += got[p["page_id"]]["text"] == "\n".join(b for b in blocks if b)
        assert got[p["page_id"]]["n_chars"] == len(got[p["page_id"]]["text"])
    assert right >= 0.97 * len(pages)


def test_bpe_equals_the_library_and_round_trips(spark, docs):
    library = brute.tokenizer(Q.VOCABULARY)
    got = {r["doc_id"]: r for r in rows(spark, "op8_bpe")}
    for i, t in docs:
        ids = library.encode_ordinary(t or "")
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == sha(np.array(ids, dtype="<u4").tobytes())
        assert got[i]["decoded_sha256"] == sha(t or "")


def test_ngram_join(spark, docs):
    assert {r["doc_id"]: tuple(r)[1:] for r in rows(spark, "op9_ngram_join")} == brute.jaccard_components(docs)


def test_pipeline_stages_by_brute_force(spark, docs):
    """Each stage on its own input: what it keeps, what it drops, and the columns it returns."""
    library = brute.tokenizer(Q.VOCABULARY)
    columns = spark.read.parquet(f"{SF}/documents.parquet").columns
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    now = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = [(r["doc_id"], r["text"]) for r in now.collect()]
        out = corpus_pipeline.stage(stage(spark, now, SF), "test")
        if name == "bpe":
            assert {r["doc_id"]: list(np.frombuffer(r["ids"], dtype="<u4")) for r in out.collect()} == \
                {i: library.encode_ordinary(t or "") for i, t in before}
            break
        after = {r["doc_id"]: r["text"] for r in out.collect()}
        assert out.columns == columns
        if name == "quality rules":
            clean = {i for i, t in before if not brute.base_counts(t)[-1]}
            assert after.keys() <= clean and len(after) >= 0.99 * len(clean)
        elif name == "line dedup":
            lines = {}
            for i, t in sorted(before):
                for k, line in enumerate((t or "").split("\n")):
                    lines.setdefault(line.strip(brute.SPACE).translate(brute.LOWER), []).append((i, k))
            for i, t in before:
                own = (t or "").split("\n")
                keys = [x.strip(brute.SPACE).translate(brute.LOWER) for x in own]
                kept = [x for k, x in enumerate(own) if not keys[k] or lines[keys[k]][0] == (i, k)
                        or len({d for d, _ in lines[keys[k]]}) < 10]
                assert after[i] == "\n".join(kept)
        elif name == "n-gram join":
            groups = brute.jaccard_components(before, n=5, pct=80)
            assert after.keys() == {i for i, (_, c) in groups.items() if i == c}
        else:
            assert after.keys() == {i for i, _ in before} - {d for d, _ in brute.leaks(before, items)}
        now = out


def test_token_counts_equal_the_library(spark, docs):
    library = Tokenizer.from_file(Q.WORD_VOCABULARY)
    got = {r["doc_id"]: tuple(r)[1:] for r in rows(spark, "op11_token_counts")}
    for i, t in docs:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        assert got[i] == (len((t or "").encode()), n, n > 2048)


def test_collocations(spark):
    docs = [(r["lang"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted(map(tuple, rows(spark, "op12_collocations"))) == brute.phrases(docs)


def test_periodic_runs(spark, docs):
    short = {i: t for i, t in docs if len(brute.words(t)) <= 1_500}  # the brute force is cubic
    got = {r["doc_id"]: tuple(r)[1:] for r in rows(spark, "op13_periodic_runs")}
    assert got.keys() == {i for i, _ in docs} and len(short) > 0.8 * len(docs)
    assert {i: got[i] for i in short} == {i: brute.run_row(i, t) for i, t in short.items()}
