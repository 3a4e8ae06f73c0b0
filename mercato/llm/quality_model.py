"""Quality classifier: Naive Bayes support vectors.

Features are indicators of hashed n-grams of a whole text: words and word pairs, and runs of up to four word shapes
(``THE!!`` is ``X!``, ``mente$$$`` is ``x$``, a word equal to the one before it is ``=``). Each indicator is scaled by
the log-count ratio of the two classes, and a linear hinge-loss model is fitted on the scaled rows by dual coordinate
descent. A logistic curve through the margins of rows kept out of that fit turns a margin into a score.

Fitted on the driver on at most ``MAX_TRAIN_ROWS`` labelled rows (a documented bound: their feature indices take
about 50 MB); scoring is one pass over all rows with a weight vector of fixed size.

Edge cases: NULL and empty texts have no indicators and get the score of the intercept; without rows of both classes
every score is the share of label 1, or 0.5 without labels; repeated rows score alike; NULL ids are carried through;
an empty table gives an empty result. Only the id and text columns are read.
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import map_texts
from mercato.llm.labels import held_out, training_sample

BITS = 18
MAX_TRAIN_ROWS = 6_000
EPOCHS = 10
COST = 1.0
THRESHOLD = 0.5
MEMO_SIZE = 300_000
SHAPE_RUN = 4

_MULT = np.uint64(0x9E3779B97F4A7C15)


def shape(word: str) -> str:
    """Capitals as X, other letters as x, digits as 0, each run as one."""
    if word.islower() and word.isalpha():
        return "x"
    if word.isupper():
        word = word.lower()
        letter = "X"
    else:
        letter = "x"
    word = re.sub(r"[^\W\d_]+", letter, word)
    word = re.sub(r"\d+", "0", word)
    return re.sub(r"([^\w\s])\1+", r"\1", word)


class _Words(dict):
    """word -> (hash of the word, hash of its shape), remembered up to a bound."""

    def __missing__(self, word: str) -> tuple[int, int]:
        if len(self) > MEMO_SIZE:
            self.clear()
        raw = word.encode()
        value = self[word] = (zlib.crc32(raw) | len(raw) << 32, zlib.crc32(shape(word).encode()) | 1 << 40)
        return value


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * _MULT
    return h ^ (h >> np.uint64(32))


def features(text: str | None, words: dict, bits: int = BITS) -> np.ndarray:
    """Sorted distinct indices of the n-grams of a text."""
    tokens = (text or "").split()
    if not tokens:
        return np.empty(0, dtype=np.int32)
    both = np.array([words[w] for w in tokens], dtype=np.uint64)
    w, s = both[:, 0], both[:, 1].copy()
    s[1:][w[1:] == w[:-1]] = 61
    grams = [_mix(w), _mix(w[:-1] * np.uint64(31) + w[1:])]
    run = s
    for k in range(SHAPE_RUN):
        grams.append(_mix(run + np.uint64(k)))
        if len(run) < 2:
            break
        run = _mix(run[:-1]) * np.uint64(33) + s[k + 1:]
    return np.unique(np.concatenate(grams) & np.uint64((1 << bits) - 1)).astype(np.int32)


def log_count_ratio(rows: list[np.ndarray], y: np.ndarray, bits: int = BITS) -> np.ndarray:
    """log of the smoothed feature shares of label 1 over label 0."""
    counts = [np.bincount(np.concatenate([r for r, k in zip(rows, y, strict=True) if k == c] or [np.empty(0, int)]),
                          minlength=1 << bits) + 1.0 for c in (1, 0)]
    return np.log(counts[0] / counts[0].sum()) - np.log(counts[1] / counts[1].sum())


def fit_hinge(rows: list[np.ndarray], scale: np.ndarray, y: np.ndarray, cost: float = COST,
              epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """Weights and intercept of the L2-regularised hinge loss by dual coordinate descent (Hsieh et al., 2008).

    Rows are scaled to unit length; the intercept is a constant feature.
    """
    values = []
    for r in rows:
        v = scale[r]
        values.append(v / max(math.sqrt(float(v @ v)), 1e-12))
    w, b, alpha, sign = np.zeros(len(scale)), 0.0, np.zeros(len(rows)), np.where(y == 1, 1.0, -1.0)
    order = np.random.default_rng(0)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            r, v = rows[i], values[i]
            gradient = sign[i] * (float(w[r] @ v) + b) - 1
            norm = float(v @ v) + 1
            new = min(max(alpha[i] - gradient / norm, 0.0), cost)
            if new != alpha[i]:
                step = (new - alpha[i]) * sign[i]
                w[r] += step * v
                b += step
                alpha[i] = new
    return w, b


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 50) -> np.ndarray:
    """Coefficients (intercept last) of a ridge logistic regression by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    beta = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(beta))
        step = np.linalg.solve(hessian, x.T @ (y - p) - ridge * beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


class Model:
    """Weights by feature, with the scale folded in, and the curve from margin to score."""

    def __init__(self, scale: np.ndarray, w: np.ndarray, b: float, curve: np.ndarray) -> None:
        self.scale, self.weight = scale.astype(np.float32), (scale * w).astype(np.float32)
        self.b, self.curve = b, curve

    def margin(self, row: np.ndarray) -> float:
        v = self.scale[row]
        return float(self.weight[row].sum(dtype=np.float64)) / max(math.sqrt(float(v @ v)), 1e-12) + self.b

    def score(self, row: np.ndarray) -> float:
        z = self.curve[0] * self.margin(row) + self.curve[1]
        return 1 / (1 + math.exp(-min(max(z, -30), 30)))


def train(sample: DataFrame) -> Model:
    """Fit on the bounded rows of ``training_sample``; every fifth row is kept out to fit the curve."""
    def start():
        words = _Words()
        return lambda texts: ({"row": features(t, words).tobytes()} for t in texts)

    got = map_texts(sample, "_text", ["_order", "_label"], start, {"row": "binary"}).toPandas()
    got = got.sort_values("_order", kind="stable")
    rows = [np.frombuffer(r, dtype=np.int32) for r in got["row"]]
    y = got["_label"].to_numpy(dtype=np.int64)
    zero = np.zeros(1 << BITS)
    if len(set(y.tolist())) < 2:
        share = float(y.mean()) if len(y) else 0.5
        return Model(zero, zero, 0.0, np.array([0.0, math.log((share + 1e-6) / (1 - share + 1e-6))]))
    kept = np.arange(len(y)) % 5 == 0
    if len(set(y[kept].tolist())) < 2 or len(set(y[~kept].tolist())) < 2:
        kept[:] = False
    fit = [r for r, k in zip(rows, kept, strict=True) if not k]
    scale = log_count_ratio(fit, y[~kept])
    model = Model(scale, *fit_hinge(fit, scale, y[~kept]), np.array([1.0, 0.0]))
    on = np.flatnonzero(kept) if kept.any() else np.arange(len(y))
    margins = np.array([model.margin(rows[i]) for i in on])
    model.curve = fit_logistic(margins[:, None], y[on].astype(float))
    return model


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality", max_rows: int = MAX_TRAIN_ROWS) -> DataFrame:
    """(id, held_out, score, predicted) of every row."""
    model = train(training_sample(docs, labels, label_col, max_rows, id_col, text_col))

    def start():
        words = _Words()
        return lambda texts: ({"score": model.score(features(t, words))} for t in texts)

    out = map_texts(docs, text_col, [id_col], start, {"score": "double"})
    return out.select(id_col, held_out(id_col).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
