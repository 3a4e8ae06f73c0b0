"""Random forest on the time index, one forest per key (F2).

100 bootstrapped trees of full depth and seed 42, as in the reference. A key's daily series is at most the calendar
span long, however many lines it has, so each key is one group of ``applyInPandas``; there, all trees of the key grow
together, one level per step. A node of a tree on one feature is a stretch of consecutive days, so a level is a few
array operations on running sums: every possible cut of every open node is scored at once and the best of each node is
taken. The draws are seeded by the key's own values: a key's forecast does not depend on the other keys.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .panel import per_key, prediction_frame

MODEL = "random_forest"


def bootstrap(n: int, num_trees: int, seed: int, key: tuple) -> np.ndarray:
    """Draw counts, trees x days; the key's text is part of the seed."""
    rng = np.random.default_rng([seed, zlib.crc32(repr([str(k) for k in key]).encode())])
    draws = rng.integers(0, n, size=(num_trees, n)) + np.arange(num_trees)[:, None] * n
    return np.bincount(draws.ravel(), minlength=num_trees * n).reshape(num_trees, n)


def grow(y: np.ndarray, counts: np.ndarray, max_depth: int | None = None):
    """Leaves of all trees over days in time order: ``(tree, first day, last
    day, mean)`` arrays, where the days are positions of drawn days. A node is
    cut where the squared error falls most (the earliest such cut), until its
    values are equal or ``max_depth`` cuts lie above it."""
    tree, day = np.nonzero(counts)
    w = counts[tree, day].astype(float)
    v = y[day] - y.mean()  # centred, so that the running sums stay small
    cw = np.concatenate([[0.0], np.cumsum(w)])
    cv = np.concatenate([[0.0], np.cumsum(w * v)])
    changes = np.concatenate([[0], np.cumsum(np.concatenate([[False], v[1:] != v[:-1]]))])
    lo = np.flatnonzero(np.concatenate([[True], tree[1:] != tree[:-1]]))
    hi = np.concatenate([lo[1:], [len(tree)]])
    leaves = []
    depth = 0
    while len(lo):
        # changes[i + 1] counts the value changes up to row i
        pure = changes[hi] == changes[lo + 1]
        if max_depth is not None and depth >= max_depth:
            pure[:] = True
        leaves.append((lo[pure], hi[pure]))
        lo, hi = lo[~pure], hi[~pure]
        if not len(lo):
            break
        cuts = hi - lo - 1  # at least one, since the values differ
        first = np.concatenate([[0], np.cumsum(cuts)[:-1]])
        node = np.repeat(np.arange(len(lo)), cuts)
        at = np.arange(cuts.sum()) - first[node] + lo[node] + 1  # the right part starts here
        wl, sl = cw[at] - cw[lo[node]], cv[at] - cv[lo[node]]
        wr, sr = cw[hi[node]] - cw[at], cv[hi[node]] - cv[at]
        gain = sl * sl / wl + sr * sr / wr
        best = np.maximum.reduceat(gain, first)
        hits = np.flatnonzero(gain == best[node])
        owner, pos = np.unique(node[hits], return_index=True)
        cut = at[hits[pos]]
        lo, hi = np.concatenate([lo, cut]), np.concatenate([cut, hi])
        depth += 1
    lo = np.concatenate([a for a, _ in leaves])
    hi = np.concatenate([b for _, b in leaves])
    order = np.argsort(lo)
    lo, hi = lo[order], hi[order]
    return tree[lo], day[lo], day[hi - 1], (cv[hi] - cv[lo]) / (cw[hi] - cw[lo]) + y.mean()


def predict(leaves, t: np.ndarray, at: np.ndarray, num_trees: int) -> np.ndarray:
    """Mean over the trees of the leaf that holds each time in ``at``; leaves
    of a tree part halfway between their outermost drawn days."""
    tree, first, last, mean = leaves
    start = np.flatnonzero(np.concatenate([[True], tree[1:] != tree[:-1]]))
    upper = np.full(len(tree), np.inf)
    same = np.flatnonzero(tree[1:] == tree[:-1])
    upper[same] = (t[last[same]] + t[first[same + 1]]) / 2.0
    out = np.zeros(len(at))
    for s, e in zip(start, np.concatenate([start[1:], [len(tree)]])):  # once a tree, not a row
        out += mean[s + np.searchsorted(upper[s:e], at, side="left")]
    return out / num_trees


def forecast_forest(panel: DataFrame, keys: Sequence[str] = (), y: str = "sales", t: str = "t",
                    num_trees: int = 100, max_depth: int | None = None, seed: int = 42) -> DataFrame:
    """Forecast of every validation and test day. ``keys=[]`` is the
    reference's single series; ``max_depth=None`` grows every tree until its
    leaves are pure. Train days without a value are left out; a key without
    train days gets no forecast."""
    keys = list(keys)
    rows = panel.select(*keys, "day", "split", t, F.col(y).cast("double").alias("_y"))

    def fit(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        tr = pdf[(pdf["split"] == "train") & pdf["_y"].notna()].sort_values(t)
        out = pdf[pdf["split"] != "train"].copy()
        if len(tr) == 0 or len(out) == 0:
            return out.assign(predicted=np.nan).iloc[0:0]
        tt = tr[t].to_numpy(dtype=float)
        yy = tr["_y"].to_numpy(dtype=float)
        leaves = grow(yy, bootstrap(len(yy), num_trees, seed, key), max_depth)
        out["predicted"] = predict(leaves, tt, out[t].to_numpy(dtype=float), num_trees)
        return out

    return prediction_frame(per_key(rows, keys, fit).withColumnRenamed("_y", y), MODEL, keys, actual=y)
