"""Phrase collocations by weighted acyclic automata.

A shard (some two million words of one task) is turned into the sorted list of its windows of up to four words, and
from that list, in order, into a count transducer: an acyclic automaton over words in which the weight of each state
is the count of the phrase that leads to it. States are shared by prefix, all ends of four words are one final state.
A shard's transducer is cut into prefix ranges (stretches of the sorted windows, whose bounds come from a bounded
sample and decide on balance only), and the pieces of a range are united and their weights summed, level by level.

A phrase whose windows cross a bound has part of its weight in several ranges; there are at most six such phrases a
bound, and their sums are made apart. What stays of a range are the states of at least ``min_count``.

The counts of a phrase's parts, which mostly lie in other ranges, come from composition: each range sends every other
range one acceptor of the parts it needs, the receiver composes it with its transducer and sends the weights back. An
acceptor carries with each part the count of the longest-lived phrase around it, so the receiver learns as well which
of its own phrases are covered by longer ones. A part that a thousand phrases need is asked for once per range, so no
part is a hot key.

Edge cases: NULL texts have no words; a NULL lang is ``und``; a text is never cut; repeated rows count each time; ties
are ranked by phrase in UTF-8 byte order; an empty table gives an empty result. Only the text and lang columns are read.
"""

from __future__ import annotations

import struct
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm.common import LOWER, UPPER, Numbering, stage

MAX_WORDS, MIN_COUNT, TOP, COVER_PCT, SCALE = 4, 30, 2_000, 80, 2_000_000
#: Words of a shard, windows meant for a range, and the most ranges there are.
SHARD_WORDS, RANGE_WINDOWS, MAX_RANGES = 2_000_000, 1_000_000, 20_000
#: Rows of the sample that places the bounds, its parts, and the windows that a part gives the driver.
SAMPLE_ROWS, SAMPLE_PARTS, SAMPLE_WINDOWS = 4_000, 8, 4_096
#: States united at a time.
UNION_STATES = 1_000_000
#: A-Z in lower case; what ends a piece as a line feed, tabs as spaces.
BYTES = bytes.maketrans(UPPER.encode() + b".,;:!?\x0b\x0c\r\t", LOWER.encode() + b"\n" * 9 + b" ")
END = b"."  # no word: dots end pieces
Path = tuple[bytes, ...]


class Transducer:
    """Phrases of up to ``MAX_WORDS`` words with a weight each.

    ``words`` is sorted; level d holds three arrays (parent: place in level d - 1, label: place in ``words``, weight),
    sorted by parent and label.
    """

    def __init__(self, words: list[bytes], levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> None:
        self.words = words
        self.levels = levels

    def __len__(self) -> int:
        return sum(len(w) for _, _, w in self.levels)

    @classmethod
    def of_windows(cls, words: list[bytes], rows: np.ndarray, counts: np.ndarray) -> Transducer:
        """From sorted distinct windows: rows of places in ``words`` from 1, 0 after the end of a piece."""
        used = np.unique(rows)
        used = used[used > 0]
        place = np.searchsorted(used, rows)
        levels, known, parents = [], np.zeros(len(rows), dtype=bool), np.zeros(len(rows), dtype=np.int64)
        known[:1] = True
        for d in range(MAX_WORDS):
            known = known.copy()
            known[1:] |= rows[1:, d] != rows[:-1, d]
            first = np.flatnonzero(known)
            weight = np.add.reduceat(counts, first) if len(first) else counts
            real = rows[first, d] > 0
            levels.append((parents[first][real], place[first, d][real], weight[real]))
            parents = (np.cumsum(real) - 1)[np.cumsum(known) - 1]
        return cls([words[i - 1] for i in used], levels)

    @classmethod
    def of_paths(cls, weights: dict[Path, int]) -> Transducer:
        """From phrases; phrases that are only beginnings of others get weight 0."""
        every = {p[:d]: weights.get(p[:d], 0) for p in weights for d in range(1, len(p) + 1)}
        words = sorted({w for p in every for w in p})
        at = {w: i for i, w in enumerate(words)}
        levels, place = [], {(): 0}
        for d in range(1, MAX_WORDS + 1):
            paths = sorted(p for p in every if len(p) == d)
            levels.append(tuple(np.array(x, dtype=np.int64) for x in (
                [place[p[:-1]] for p in paths], [at[p[-1]] for p in paths], [every[p] for p in paths])))
            place = {p: i for i, p in enumerate(paths)}
        return cls(words, levels)

    @classmethod
    def union(cls, parts: list[Transducer]) -> Transducer:
        """The phrases of all parts, weights summed."""
        words = sorted(set().union(*(t.words for t in parts)))
        at = {w: i for i, w in enumerate(words)}
        label_of = [np.fromiter(map(at.__getitem__, t.words), dtype=np.int64, count=len(t.words)) for t in parts]
        state_of = [np.zeros(1, dtype=np.int64) for _ in parts]
        levels = []
        for d in range(MAX_WORDS):
            keys = [(s[t.levels[d][0]] << 32) | w[t.levels[d][1]]
                    for t, s, w in zip(parts, state_of, label_of, strict=True)]
            key, weight = np.concatenate(keys), np.concatenate([t.levels[d][2] for t in parts])
            order = np.argsort(key, kind="stable")
            key = key[order]
            new = np.ones(len(key), dtype=bool)
            new[1:] = key[1:] != key[:-1]
            first = np.flatnonzero(new)
            levels.append((key[first] >> 32, key[first] & 0xFFFFFFFF,
                           np.add.reduceat(weight[order], first) if len(first) else weight))
            state = np.empty(len(key), dtype=np.int64)
            state[order] = np.cumsum(new) - 1
            state_of = np.split(state, np.cumsum([len(k) for k in keys])[:-1])
        return cls(words, levels)

    def pruned(self, least: int, always: Iterable[Path]) -> Transducer:
        """The states of at least that weight, and those of ``always``, which keep no weight of their own."""
        opened = [set() for _ in range(MAX_WORDS)]
        for path in always:
            if (place := self.place(path)) is not None:
                opened[len(path) - 1].add(place)
        levels, moved = [], np.zeros(1, dtype=np.int64)
        for (parent, label, weight), shut in zip(self.levels, opened, strict=True):
            keep, weight = weight >= least, weight.copy()
            keep[list(shut)], weight[list(shut)] = True, 0
            levels.append((moved[parent[keep]], label[keep], weight[keep]))
            moved = np.cumsum(keep) - 1
        used = np.unique(np.concatenate([label for _, label, _ in levels]))
        return Transducer([self.words[i] for i in used],
                          [(p, np.searchsorted(used, label), w) for p, label, w in levels])

    def place(self, path: Path) -> int | None:
        """The place of a phrase in its level."""
        state = 0
        for word, (parent, label, _) in zip(path, self.levels, strict=False):
            at = bisect_left(self.words, word)
            if at == len(self.words) or self.words[at] != word:
                return None
            low, high = np.searchsorted(parent, (state, state + 1))
            state = low + np.searchsorted(label[low:high], at)
            if state == high or label[state] != at:
                return None
        return int(state)

    def compose(self, acceptor: Transducer) -> Transducer:
        """The states of the acceptor with the weights that this transducer gives their phrases (0: none)."""
        at = {w: i for i, w in enumerate(self.words)}
        label_of = np.array([at.get(w, -1) for w in acceptor.words], dtype=np.int64)
        state, levels = np.zeros(1, dtype=np.int64), []
        for (parent, label, _), (own_parent, own_label, own_weight) in zip(acceptor.levels, self.levels, strict=True):
            before, wanted = state[parent], label_of[label]
            key = np.where((before >= 0) & (wanted >= 0), (before << 32) | wanted, -1)
            own = (own_parent << 32) | own_label
            found = np.searchsorted(own, key)
            met = found < len(own)
            met[met] = own[found[met]] == key[met]
            state = np.where(met, found, -1)
            weight = np.zeros(len(key), dtype=np.int64)
            weight[met] = own_weight[found[met]]
            levels.append((parent, label, weight))
        return Transducer(acceptor.words, levels)

    def items(self) -> Iterator[tuple[Path, int]]:
        paths: list[Path] = [()]
        for parent, label, weight in self.levels:
            paths = [(*paths[p], self.words[x]) for p, x in zip(parent.tolist(), label.tolist(), strict=True)]
            yield from zip(paths, weight.tolist(), strict=True)

    def to_bytes(self) -> bytes:
        parts = [np.frombuffer(b"\n".join(self.words), dtype=np.uint8)]
        above = 1
        for parent, label, weight in self.levels:
            parts += [np.bincount(parent, minlength=above), label, weight]
            above = len(label)
        out = []
        for x in parts:
            kind = np.min_scalar_type(int(x.max())) if len(x) else np.dtype(np.uint8)
            out += [struct.pack("<QB", len(x), kind.itemsize), x.astype(kind).tobytes()]
        return zstandard.ZstdCompressor(level=1).compress(b"".join(out))

    @classmethod
    def from_bytes(cls, raw: bytes) -> Transducer:
        raw, at, parts = zstandard.ZstdDecompressor().decompress(raw), 0, []
        while at < len(raw):
            n, size = struct.unpack_from("<QB", raw, at)
            parts.append(np.frombuffer(raw, dtype=f"<u{size}", count=n, offset=at + 9))
            at += 9 + n * size
        words = parts[0].tobytes().split(b"\n") if len(parts[0]) else []
        levels = [(np.repeat(np.arange(len(children)), children), label.astype(np.int64), weight.astype(np.int64))
                  for children, label, weight in zip(parts[1::3], parts[2::3], parts[3::3], strict=True)]
        return cls(words, levels)


class Shard:
    """Words of some texts, by language."""

    def __init__(self) -> None:
        self.number = Numbering()
        self.end = self.number[END]
        self.streams: dict[str, list[np.ndarray]] = defaultdict(list)
        self.n_words = 0

    def add(self, lang: str, text: bytes | None) -> None:
        if text:
            words = text.translate(BYTES).replace(b"\n", b" . ").split()
            self.streams[lang].append(np.fromiter(map(self.number.__getitem__, words), np.int64, count=len(words)))
            self.n_words += len(words)

    def windows(self) -> Iterator[tuple[str, list[bytes], np.ndarray, np.ndarray]]:
        """By language: the sorted vocabulary, the sorted distinct windows as places in it from 1, their counts."""
        vocabulary = sorted(w for w in self.number if w != END)
        rank = np.zeros(len(self.number) + 1, dtype=np.int64)
        rank[[self.number[w] for w in vocabulary]] = np.arange(1, len(vocabulary) + 1)
        for lang in sorted(self.streams):
            s = np.concatenate([x for text in self.streams.pop(lang) for x in (text, [self.end])])
            s = np.append(rank[s], [0] * MAX_WORDS)
            w = [s[:-MAX_WORDS]]
            for d in range(1, MAX_WORDS):
                w.append(np.where(w[-1] > 0, s[d:d - MAX_WORDS], 0))
            real = w[0] > 0
            first, head = np.unique((w[0] << 32 | w[1])[real], return_inverse=True)
            second, tail = np.unique((w[2] << 32 | w[3])[real], return_inverse=True)
            key, counts = np.unique(head << 32 | tail, return_counts=True)
            first, second = first[key >> 32], second[key & 0xFFFFFFFF]
            low = 0xFFFFFFFF
            yield lang, vocabulary, np.stack([first >> 32, first & low, second >> 32, second & low], axis=1), counts


def _shards(batches: Iterator[pa.RecordBatch], shard_words: int) -> Iterator[Shard]:
    shard = Shard()
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
            shard.add(lang, text.as_py())
            if shard.n_words >= shard_words:
                yield shard
                shard = Shard()
    if shard.n_words:
        yield shard


def _window(vocabulary: list[bytes], row: np.ndarray) -> Path:
    return tuple(vocabulary[i - 1] if i else b"" for i in row.tolist())


def _bounds(texts: DataFrame, range_windows: int) -> list[tuple[str, Path]]:
    """The first window of each range but the first, from about ``SAMPLE_ROWS`` rows."""
    rows = texts.count()
    if not rows:
        return []
    fraction = min(1.0, SAMPLE_ROWS / rows)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in _shards(batches, SHARD_WORDS):
            total = shard.n_words
            for lang, vocabulary, windows, counts in shard.windows():
                up_to = np.cumsum(counts)
                n = max(1, int(SAMPLE_WINDOWS * up_to[-1] / total)) if len(up_to) else 0
                at = np.searchsorted(up_to, (np.arange(n) + 0.5) * (up_to[-1] / n)) if n else []
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array([lang] * n, pa.string()),
                    "window": pa.array([list(_window(vocabulary, windows[i])) for i in at], pa.list_(pa.binary())),
                    "weight": pa.array([up_to[-1] / n] * n, pa.float64())})

    sample = texts.sample(fraction, seed=7).repartition(SAMPLE_PARTS)
    points = sorted(((r["lang"].encode(), tuple(map(bytes, r["window"]))), r["weight"]) for r in
                    sample.mapInArrow(spread, "lang string, window array<binary>, weight double").collect())
    if not points:
        return []
    up_to = np.cumsum([w for _, w in points])
    n = min(MAX_RANGES, int(up_to[-1] / fraction / range_windows) + 1)
    at = np.searchsorted(up_to, np.arange(1, n) * (up_to[-1] / n))
    return [(lang.decode(), window) for lang, window in sorted({points[min(i, len(points) - 1)][0] for i in at})]


def _open_paths(bounds: list[tuple[str, Path]], k: int, lang: str) -> set[Path]:
    """The phrases that may go on in the range before or behind range ``k``."""
    near = [window for of, window in bounds[max(0, k - 1):k + 1] if of == lang]
    return {window[:d] for window in near for d in range(1, MAX_WORDS) if b"" not in window[:d]}


def _united(blobs: Iterable[bytes]) -> Transducer:
    done, held = None, []
    for blob in blobs:
        held.append(Transducer.from_bytes(blob))
        if sum(map(len, held)) >= max(UNION_STATES, len(done or ())):
            done, held = Transducer.union([*([done] if done else []), *held]), []
    return Transducer.union([*([done] if done else []), *held])


def range_transducers(texts: DataFrame, bounds: list[tuple[str, Path]], min_count: int,
                      shard_words: int = SHARD_WORDS) -> DataFrame:
    """(range, lang, n, blob, open, open_counts): the united transducer of each prefix range, of states of at least
    ``min_count``, with the number of windows in the range and its share of the phrases that cross its bounds."""
    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _shards(batches, shard_words):
            for lang, vocabulary, windows, counts in part.windows():
                base = bisect_left(bounds, lang.encode(), key=lambda b: b[0].encode())
                own = [window for of, window in bounds[base:] if of == lang]
                cuts = [bisect_left(range(len(windows)), w, key=lambda i: _window(vocabulary, windows[i])) for w in own]
                for k, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(windows)], strict=True)):
                    if a < b:
                        blob = Transducer.of_windows(vocabulary, windows[a:b], counts[a:b]).to_bytes()
                        yield pa.RecordBatch.from_pydict({
                            "range": pa.array([base + k], pa.int32()), "lang": [lang],
                            "n": pa.array([counts[a:b].sum()], pa.int64()), "blob": pa.array([blob], pa.binary())})

    def unite(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        k, lang = int(key[0]), key[1]
        whole = _united(rows["blob"])
        open_paths = _open_paths(bounds, k, lang)
        shares = {p: int(whole.levels[len(p) - 1][2][i]) for p in open_paths if (i := whole.place(p)) is not None}
        return pd.DataFrame({"range": [k], "lang": [lang], "n": [int(rows["n"].sum())],
                             "blob": [whole.pruned(min_count, open_paths).to_bytes()],
                             "open": [[b" ".join(p) for p in shares]], "open_counts": [list(shares.values())]})

    pieces = texts.mapInArrow(shard, "range int, lang string, n long, blob binary")
    return pieces.groupBy("range", "lang").applyInPandas(
        unite, "range int, lang string, n long, blob binary, open array<binary>, open_counts array<long>")


def _crossing(ranges: DataFrame, min_count: int) -> tuple[dict[tuple[str, Path], int],
                                                         dict[tuple[int, str], dict[Path, int]]]:
    """The phrases that cross bounds (six a bound at most): the range that owns each, and their counts by owner."""
    each = ranges.select("range", "lang", F.explode(F.arrays_zip("open", "open_counts")).alias("p"))
    total = (each.groupBy("lang", F.col("p.open").alias("phrase"))
             .agg(F.min("range").alias("range"), F.sum("p.open_counts").alias("count"))
             .where(F.col("count") >= min_count))
    owners, held = {}, defaultdict(dict)
    for r in total.collect():
        path = tuple(bytes(r["phrase"]).split(b" "))
        owners[r["lang"], path] = r["range"]
        held[r["range"], r["lang"]][path] = r["count"]
    return owners, dict(held)


def _entries(blobs: Iterable[bytes], held: dict[Path, int]) -> dict[Path, int]:
    """The phrases that a range owns, with their counts."""
    return {p: a for blob in blobs for p, a in Transducer.from_bytes(blob).items() if a} | held


def mine_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT,
                 top: int = TOP, shard_words: int = SHARD_WORDS, range_windows: int = RANGE_WINDOWS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of two to four words.

    A phrase found ``a`` times is cut where floor(2000000 * a / (l + r)) is lowest, l and r being the counts of its
    two parts; a phrase is left out when a longer one around it has at least ``COVER_PCT`` percent of its count.
    """
    texts = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"),
                        F.col(text_col).cast("binary").alias("text"))
    bounds = _bounds(texts, range_windows)
    keys = [(lang.encode(), window) for lang, window in bounds]
    ranges = stage(range_transducers(texts, bounds, min_count, shard_words), "phrase-ranges")
    crossing = docs.sparkSession.sparkContext.broadcast(_crossing(ranges, min_count))

    def owner(lang: str, path: Path) -> int:
        k = crossing.value[0].get((lang, path))
        return bisect_right(keys, (lang.encode(), path + (b"",) * (MAX_WORDS - len(path)))) if k is None else k

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for k, lang, blob in zip(frame["range"], frame["lang"], frame["blob"], strict=True):
                wanted: dict[int, dict[Path, int]] = defaultdict(dict)
                for path, a in _entries([blob], crossing.value[1].get((k, lang), {})).items():
                    n = len(path)
                    for part in {path[i:j] for i in range(n) for j in range(i + 1, n + 1) if 0 < j - i < n}:
                        if len(part) > 1 or part[0] in (path[0], path[-1]):
                            asked = wanted[owner(lang, part)]
                            asked[part] = max(asked.get(part, 1), a if len(part) > 1 else 1)
                yield pd.DataFrame([(to, k, lang, Transducer.of_paths(paths).to_bytes())
                                    for to, paths in wanted.items()], columns=["to", "range", "lang", "blob"])

    def answer(key: tuple, asked: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        if asked.empty:
            return pd.DataFrame(columns=["to", "lang", "covers", "blob"])
        k, lang = int(key[0]), key[1]
        whole = _united(own["blob"]) if len(own) else Transducer.of_paths({})
        extra = crossing.value[1].get((k, lang), {})
        out, covers = [], {}
        for to, blob in zip(asked["range"], asked["blob"], strict=True):
            acceptor = Transducer.from_bytes(blob)
            got = whole.compose(acceptor)
            counts = {}
            for (path, cover), (_, a) in zip(acceptor.items(), got.items(), strict=True):
                if cover:
                    counts[path] = extra.get(path, a)
                    covers[path] = max(covers.get(path, 0), cover)
            out.append((int(to), lang, False, Transducer.of_paths(counts).to_bytes()))
        out.append((k, lang, True, Transducer.of_paths(covers).to_bytes()))
        return pd.DataFrame(out, columns=["to", "lang", "covers", "blob"])

    def score(key: tuple, answers: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        columns = ["lang", "phrase", "a", "l", "r", "score"]
        if own.empty:
            return pd.DataFrame(columns=columns)
        k, lang = int(key[0]), key[1]
        counts, covers = {}, {}
        for of_covers, blob in zip(answers["covers"], answers["blob"], strict=True):
            (covers if of_covers else counts).update((p, w) for p, w in Transducer.from_bytes(blob).items() if w)
        out = []
        for path, a in _entries(own["blob"], crossing.value[1].get((k, lang), {})).items():
            if len(path) > 1 and 100 * covers.get(path, 0) < COVER_PCT * a:
                best, _, left, right = min((SCALE * a // (counts[path[:i]] + counts[path[i:]]), i, counts[path[:i]],
                                            counts[path[i:]]) for i in range(1, len(path)))
                out.append((lang, b" ".join(path).decode(), a, left, right, best))
        out.sort(key=lambda r: (-r[5], -r[2], r[1].encode()))
        return pd.DataFrame(out[:top], columns=columns)

    own = ranges.select("range", "lang", "blob")
    asked = own.mapInPandas(ask, "to int, range int, lang string, blob binary")
    answers = (asked.groupBy("to", "lang").cogroup(own.groupBy("range", "lang"))
               .applyInPandas(answer, "to int, lang string, covers boolean, blob binary"))
    scored = (answers.groupBy("to", "lang").cogroup(own.groupBy("range", "lang"))
              .applyInPandas(score, "lang string, phrase string, a long, l long, r long, score long"))
    best = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    n = ranges.groupBy("lang").agg(F.sum("n").alias("n"))
    return (scored.withColumn("rank", best).where(F.col("rank") <= top).join(n, "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
