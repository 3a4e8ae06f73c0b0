"""Brute-force versions of the corpus queries in plain Python, for small inputs."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import tiktoken

SPACE = " \t\n\x0b\x0c\r"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def line_dedup(docs, min_docs=10, min_chars=1):
    """docs: (id, text) pairs, each a document. -> [(id, n_lines, n_dropped, kept text)]"""
    key = lambda line: line.strip(SPACE).translate(LOWER)
    holders = defaultdict(set)
    for d, (i, t) in enumerate(docs):
        for line in (t or "").split("\n"):
            holders[key(line)].add((i, t))
    out = []
    for i, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < min_chars or len(holders[key(x)]) < min_docs]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def base_counts(text):
    w = words(text)
    windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    times = Counter(windows)
    covered = {p for i, x in enumerate(windows) if times[x] > 1 for p in range(i, i + 8)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if line.strip(SPACE):
            dup += line in seen
            seen.add(line)
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered), failed)


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


def payloads(pages):
    """pages: (id, html) -> {id: (bytes, digest, type, refers_to)}"""
    first = {}
    for i, h in sorted(pages):
        first.setdefault(h or "", i)
    out = {}
    for i, h in pages:
        raw = (h or "").encode()
        lead = first[h or ""]
        out[i] = (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
                  "response" if lead == i else "revisit", None if lead == i else lead)
    return out


def shingles(text, n):
    w = words((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1)))


def jaccard_components(docs, n=3, pct=90):
    """docs: (id, text) -> {id: (set size, component)}; every pair that shares a shingle is compared."""
    sets = {i: shingles(t, n) for i, t in docs}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    common = Counter()
    for ids in holders.values():
        for k, a in enumerate(ids):
            for b in ids[k + 1:]:
                common[a, b] += 1
    for (a, b), c in common.items():
        if 100 * c >= pct * (len(sets[a]) + len(sets[b]) - c):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {i: (len(s), find(i)) for i, s in sets.items()}


def tokenizer(path):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def bench_words(text):
    return re.findall(r"\w+", (text or "").lower())


def leaks(docs, items, window=8, cover=50):
    """(doc, item) pairs where half of the item's plain word windows stand in the document."""
    where = defaultdict(set)
    total = {}
    for i, t in items:
        w = bench_words(t)
        total[i] = len(w) - window + 1
        for k in range(total[i]):
            where[tuple(w[k:k + window])].add((i, k))
    out = set()
    for d, t in docs:
        w, hit = bench_words(t), defaultdict(set)
        for k in range(len(w) - window + 1):
            for i, j in where.get(tuple(w[k:k + window]), ()):
                hit[i].add(j)
        out |= {(d, i) for i, js in hit.items() if 100 * len(js) >= cover * total[i]}
    return out


def phrases(docs, min_count=30, top=2000):
    """docs: (lang, text) -> sorted (lang, rank, phrase, a, l, r, n, score) rows."""
    found, n = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                found[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in found.items():
        own = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        around = Counter()
        for p, a in own.items():
            for i in range(len(p)):
                for j in range(i + 2, len(p) + 1):
                    if j - i < len(p):
                        around[p[i:j]] = max(around[p[i:j]], a)
        rows = []
        for p, a in own.items():
            if 100 * around[p] < 80 * a:
                s, _, left, right = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]])
                                        for k in range(1, len(p)))
                rows.append((lang, " ".join(p), a, left, right, n[lang], s))
        rows.sort(key=lambda x: (-x[6], -x[2], x[1].encode()))
        out += [(x[0], i + 1, *x[1:]) for i, x in enumerate(rows[:top])]
    return sorted(out)


def runs(w, min_words=12):
    """[(start, length, period)] of the maximal runs of a list, by trying every period."""
    out = set()
    for q in range(1, len(w) // 2 + 1):
        k = 0
        while k < len(w) - q:
            i = k
            while k < len(w) - q and w[k] == w[k + q]:
                k += 1
            length = k - i + q
            if k > i and length >= max(min_words, 2 * q) and \
                    not any(all(w[x] == w[x + p] for x in range(i, i + length - p)) for p in range(1, q)):
                out.add((i, length, q))
            k += k == i
    return sorted(out)


def run_row(doc_id, text):
    """The row of the periodic run query, but for the id."""
    w, h = WORD.findall(text or ""), zlib.crc32(str(doc_id).encode())
    n, g = len(w), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = runs(w)
    gone = {x for i, length, q in found for x in range(i + q, i + length)}
    start, length, q = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (len(found), start, length, q, 1000 * length // q if found else None,
            sha("".join(f"{i},{m},{p}\n" for i, m, p in found)),
            sha(" ".join(x for i, x in enumerate(w) if i not in gone)))
