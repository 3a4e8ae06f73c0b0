"""Maximal periodic runs of words by block convolution at dyadic scales.

A run is a stretch of words with smallest period q (words q apart are identical) that no neighbouring word extends and
that is at least ``max(min_words, 2 * q)`` words long. Words become numbers, the documents of a batch one long stream
with a separator of its own after each. At scale B the stream is cut into blocks of B words, and every period q from
2B - 1 to 4B - 2 (1 to 6 at B = 2) is looked for: the part of the run that has a copy q words on is at least 2B - 1
words long, so it holds a whole block. The sum of squared differences between a block and each place of the window
behind it comes from one number-theoretic transform, in exact integers modulo a prime: a copy always gives zero. Each
zero is a distance, which is extended to both sides word by word; that comparison alone decides, so a sum that is
zero only modulo the prime finds nothing.

Work is kept near-linear without leaving anything out: a block can only have a copy at distance d if each of its
words comes again within d words, so other blocks are not transformed; and a block whose whole window lies in a known
run of period p <= B has copies at multiples of p only, which give that run again.

Edge cases: NULL, empty and blank texts have no words and no runs; texts are never cut; a text of one word repeated is
one run of period 1; repeated rows and NULL ids are carried through; an empty table gives an empty result. Only the id
and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import Numbering, map_texts

MIN_WORDS = 12
#: Words of a stream (a longer text is a stream by itself) and numbers of a transform held at a time.
STREAM_WORDS, TRANSFORM_SIZE = 1 << 18, 1 << 20
#: The prime 15 * 2^27 + 1 and a generator of its multiplicative group; transforms of up to 2^27 numbers.
PRIME, GENERATOR = 2_013_265_921, 31
FAR = np.iinfo(np.int64).max


@cache
def _twiddles(half: int, inverse: bool) -> np.ndarray:
    root = pow(GENERATOR, (PRIME - 1) // (2 * half), PRIME)
    if inverse:
        root = pow(root, PRIME - 2, PRIME)
    out = np.ones(half, dtype=np.uint64)
    done = 1
    while done < half:  # powers done .. 2 * done - 1 from those below
        out[done:2 * done] = out[:done] * np.uint64(pow(root, done, PRIME)) % np.uint64(PRIME)
        done *= 2
    return out


def transform(a: np.ndarray) -> np.ndarray:
    """The transform of each row (a power of two long, numbers below PRIME), in bit-reversed order."""
    rows, n = a.shape
    p, half = np.uint64(PRIME), n // 2
    while half:
        pair = a.reshape(rows, n // (2 * half), 2, half)
        u, v = pair[:, :, 0], pair[:, :, 1]
        a = np.stack([(u + v) % p, (u + p - v) % p * _twiddles(half, False) % p], axis=2).reshape(rows, n)
        half //= 2
    return a


def invert(a: np.ndarray) -> np.ndarray:
    """The rows whose ``transform`` is ``a``."""
    rows, n = a.shape
    p, half = np.uint64(PRIME), 1
    while half < n:
        pair = a.reshape(rows, n // (2 * half), 2, half)
        u, v = pair[:, :, 0], pair[:, :, 1] * _twiddles(half, True) % p
        a = np.stack([(u + v) % p, (u + p - v) % p], axis=2).reshape(rows, n)
        half *= 2
    return a * np.uint64(pow(n, PRIME - 2, PRIME)) % p


def block_copies(x: np.ndarray, starts: np.ndarray, size: int, low: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, distance) of each zero of the squared differences between ``x[start:start + size]`` and the places
    ``low`` to ``low + 2 * size - 1`` words on. ``x`` holds 5 * size numbers after the last start."""
    p = np.uint64(PRIME)
    found_s, found_d = [], []
    at_once = max(1, TRANSFORM_SIZE // (4 * size))
    for k in range(0, len(starts), at_once):
        s = starts[k:k + at_once]
        window = x[s[:, None] + (low + np.arange(4 * size))[None, :]]
        window[:, 3 * size - 1:] = 0
        block = np.zeros_like(window)  # reversed in the cyclic sense, so that the product is a correlation
        block[:, 0] = x[s]
        block[:, :-size:-1] = x[s[:, None] + np.arange(1, size)[None, :]]
        product = invert(transform(block) * transform(window) % p)[:, :2 * size]
        squares = np.zeros((len(s), 3 * size), dtype=np.uint64)
        np.cumsum(window[:, :3 * size - 1] ** np.uint64(2) % p, axis=1, out=squares[:, 1:])
        own = (block ** np.uint64(2) % p).sum(axis=1) % p
        there = (squares[:, size:] - squares[:, :2 * size]) % p
        row, place = np.nonzero((own[:, None] + there + 2 * (p - product)) % p == 0)
        found_s.append(s[row])
        found_d.append(place + low)
    if not found_s:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(found_s), np.concatenate(found_d)


def _extent(ids: np.ndarray, at: int, d: int) -> tuple[int, int]:
    """The widest stretch around ``at`` in which words ``d`` apart are identical; empty if those at ``at`` are not."""
    i, j, n = at, at, len(ids) - d
    if at >= n:
        return at, at
    step = 32
    while j < n:
        differs = np.flatnonzero(ids[j:min(j + step, n)] != ids[j + d:min(j + step, n) + d])
        if len(differs):
            j += int(differs[0])
            break
        j = min(j + step, n)
        step *= 2
    step = 32
    while i > 0:
        low = max(0, i - step)
        differs = np.flatnonzero(ids[low:i] != ids[low + d:i + d])
        if len(differs):
            i = low + int(differs[-1]) + 1
            break
        i = low
        step *= 2
    return (i, j + d) if j > at else (at, at)


def _primes_of(n: int) -> list[int]:
    out, k = [], 2
    while k * k <= n:
        if n % k == 0:
            out.append(k)
            while n % k == 0:
                n //= k
        k += 1
    return [*out, n] if n > 1 else out


def stream_runs(ids: np.ndarray, longest: int, min_words: int = MIN_WORDS) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a stream whose documents have at most ``longest`` words, by start and
    period. Words are numbers from 1, separators are negative and occur once."""
    total = len(ids)
    order = np.argsort(ids, kind="stable")
    again = np.full(total, FAR)  # words to the next occurrence
    same = ids[order[1:]] == ids[order[:-1]]
    again[order[:-1][same]] = (order[1:] - order[:-1])[same]
    runs: dict[tuple[int, int], int] = {}  # (start, period) -> end
    size, slowest, x = 2, again, None
    while size == 2 or 2 * (2 * size - 1) <= longest:
        cut = len(slowest) // 2 * 2
        slowest = np.maximum(slowest[0:cut:2], slowest[1:cut:2])  # of each block, the word that takes longest
        starts = np.flatnonzero(slowest <= 4 * size - 2) * size
        if len(starts) and (known := sorted((i, j) for (i, q), j in runs.items() if q <= size)):
            begins = np.array([i for i, _ in known])
            ends = np.maximum.accumulate([j for _, j in known])
            left = np.searchsorted(begins, starts, side="right") - 1
            starts = starts[(left < 0) | (ends[left] < starts + 5 * size - 2)]
        if len(starts):
            if x is None or len(x) < total + 5 * size:
                x = np.zeros(total + 10 * size, dtype=np.uint64)
                x[:total] = ids % PRIME
            for low in (1, 3) if size == 2 else (2 * size - 1,):
                _add_runs(ids, *block_copies(x, starts, size, low), size, min_words, runs)
        size *= 2
    return sorted((i, j - i, q) for (i, q), j in runs.items())


def _add_runs(ids: np.ndarray, starts: np.ndarray, distances: np.ndarray, size: int, min_words: int,
              runs: dict[tuple[int, int], int]) -> None:
    """Extend the copies found to runs. A copy at a multiple of a known run's period inside it is that run again."""
    order = np.lexsort((distances, starts))
    s, d = starts[order], distances[order]
    keep = np.ones(len(s), dtype=bool)
    known = np.array([(i, j, q) for (i, q), j in runs.items()], dtype=np.int64).reshape(-1, 3)
    spans = np.searchsorted(s, known[:, :2])
    for k in np.flatnonzero(spans[:, 0] < spans[:, 1]):
        a, b = spans[k]
        keep[a:b] &= (d[a:b] % known[k, 2] != 0) | (s[a:b] + d[a:b] + size > known[k, 1])
    last: dict[int, int] = {}  # distance -> end of the stretch extended last
    for at, q in zip(s[keep].tolist(), d[keep].tolist(), strict=True):
        if at + q + size <= last.get(q, 0):
            continue
        i, j = _extent(ids, at, q)
        last[q] = max(j, last.get(q, 0))
        if j - i < max(min_words, 2 * q):
            continue
        if not any((ids[i:j - q // r] == ids[i + q // r:j]).all() for r in _primes_of(q)):
            runs[i, q] = j


def _described(part: list[tuple[np.ndarray, bytes]], min_words: int) -> Iterable[dict]:
    ids = np.concatenate([x for k, (numbers, _) in enumerate(part) for x in (numbers, [-1 - k])])
    ends = np.cumsum([len(numbers) + 1 for numbers, _ in part])
    found = stream_runs(ids, max(len(numbers) for numbers, _ in part), min_words)
    runs = np.array(found, dtype=np.int64).reshape(-1, 3)
    split = np.searchsorted(runs[:, 0], ends)
    for k, (numbers, text) in enumerate(part):
        n = len(numbers)
        start, length, period = (runs[split[k - 1] if k else 0:split[k]] - (ends[k] - n - 1, 0, 0)).T
        if len(start):
            change = np.zeros(n + 1, dtype=np.int64)
            np.add.at(change, start + period, 1)
            np.add.at(change, start + length, -1)
            words = text.split(b" ")
            text = b" ".join([words[i] for i in np.flatnonzero(np.cumsum(change[:n]) == 0)])
        yield {"n_words": n, "starts": start.tolist(), "lengths": length.tolist(), "periods": period.tolist(),
               "collapsed_text": text.decode()}


def _tiled(words: list[bytes], tile: int) -> list[bytes]:
    """Words from place a = tile % n on repeat those of a stretch of p = 1 + (n - a) // (3 + tile % 8) words at a."""
    n = len(words)
    a = tile % n
    p = 1 + (n - a) // (3 + tile % 8)
    return words[:a] + (words[a:a + p] * ((n - a) // p + 1))[:n - a]


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
              tile: Column | None = None) -> DataFrame:
    """The id of every document with n_words, its runs as three arrays (starts, lengths, periods; by start, then
    period) and collapsed_text: the words, joined by spaces, without those that a run holds after its first period.

    Where the long column ``tile`` is not NULL, the words are first rewritten as ``_tiled`` says.
    """
    text = F.struct(F.col(text_col).cast("binary").alias("text"),
                    (F.lit(None) if tile is None else tile).cast("long").alias("tile"))

    def start():
        def work(rows: list[dict]) -> Iterable[dict]:
            part, size, number = [], 0, Numbering()
            for row in rows:
                words = (row["text"] or b"").split()  # bytes split at ASCII white space only
                if row["tile"] is not None and words:
                    words = _tiled(words, row["tile"])
                ids = np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=len(words))
                part.append((ids, b" ".join(words)))
                size += len(words)
                if size >= STREAM_WORDS:
                    yield from _described(part, min_words)
                    part, size, number = [], 0, Numbering()
            if part:
                yield from _described(part, min_words)
        return work

    made = {"n_words": "long", "starts": "array<long>", "lengths": "array<long>", "periods": "array<long>",
            "collapsed_text": "string"}
    own = docs.select(F.col(id_col).alias("_id"), text.alias("_in"))
    return map_texts(own, "_in", ["_id"], start, made).withColumnRenamed("_id", id_col)
