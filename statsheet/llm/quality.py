"""Quality rules: document statistics, fixed base rules, and boosted trees.

``statistics`` counts over each whole text.  The base rules fail short and
repetitive texts outright.  What they pass is judged by gradient-boosted trees
trained here on labelled documents: histogram splits, logistic loss, and
monotonic constraints, so that more symbols or more repetition never raises a
score.  The trees are flattened into numpy node arrays and score a batch of
documents in one vectorised descent.

Defined cases: a null text has no words, so it fails the base rules.  Labels
that are null, or whose document is missing, are not learned from; a repeated
label, or a repeated text with it, counts once.  Without labels of both kinds every document that
passes the base rules is kept.  Repeated rows are judged alike.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Out, prepare, rows_of, slices

LEAST_WORDS = 10
MOST_REPEATED = 20  # percent of the words
THRESHOLD = 0.5
#: Train on about this many labelled documents (drawn by a hash of the id).
SAMPLE = 12_000

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SYMBOL = re.compile(r"[#*$%&|<>]")
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_DIGIT = re.compile(r"[0-9]")
_MARK = re.compile(r"[!?;:|@\[\]{}()]")
_BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

#: Feature -> direction: 1 may only raise the score as it grows, -1 only lower it, 0 is free.
#: None is free here: with few labels a free feature (a length, say) would cost clean documents.
FEATURES = {
    "symbols_per_word": -1,
    "dup_lines_share": -1,
    "repeat_share": -1,
    "log_words": 1,
    "upper_share": -1,
    "digit_share": -1,
    "marks_per_word": -1,
}


def repeated_words(words: list[str], window: int = 5) -> int:
    """Words that lie in a window found twice or more, first ones included."""
    if len(words) <= window:
        return 0
    runs = list(zip(*(words[i:] for i in range(window))))
    if len(set(runs)) == len(runs):
        return 0
    often = {r for r, n in Counter(runs).items() if n > 1}
    total = end = 0
    for i, r in enumerate(runs):
        if r in often:
            total += i + window - max(i, end)
            end = i + window
    return total


def statistics(text: str | None) -> tuple[tuple[int, ...], list[float]]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words), features."""
    text = text or ""
    words = _WORD.findall(text)
    n = len(words)
    lines = [x for x in text.split("\n") if _WORD.search(x)]
    chars = sum(map(len, words))
    base = (n, chars, len(_SYMBOL.findall(text)), len(lines) - len(set(lines)), repeated_words(words))
    w, c = max(n, 1), max(chars, 1)
    return base, [
        base[2] / w,
        base[3] / max(len(lines), 1),
        base[4] / w,
        float(np.log1p(n)),
        len(_UPPER.findall(text)) / c,
        len(_DIGIT.findall(text)) / c,
        len(_MARK.findall(text)) / w,
    ]


def base_failed(base: tuple[int, ...]) -> bool:
    return base[0] < LEAST_WORDS or 100 * base[4] > MOST_REPEATED * base[0]


@dataclass
class Trees:
    """All trees as node arrays [tree, node]; a leaf points to itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    base: float
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of good quality for each row of features."""
        trees = np.arange(len(self.feature))[None, :]
        node = np.zeros((len(x), len(self.feature)), np.int32)
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            low = x[rows, self.feature[trees, node]] <= self.threshold[trees, node]
            node = np.where(low, self.left[trees, node], self.right[trees, node])
        return 1 / (1 + np.exp(-(self.base + self.value[trees, node].sum(axis=1))))


def _best_split(g: np.ndarray, h: np.ndarray, low: float, high: float, sign: int, l2: float, least: float) -> tuple[float, int, float, float]:
    """(gain, last bin of the left side, left value, right value) of a histogram."""
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    vl, vr = np.clip(-gl / (hl + l2), low, high), np.clip(-gr / (hr + l2), low, high)
    # Gain of the clipped values, since a bound may hold them off their best.
    gain = -(gl * vl + 0.5 * (hl + l2) * vl**2) - (gr * vr + 0.5 * (hr + l2) * vr**2)
    whole = np.clip(-g.sum() / (h.sum() + l2), low, high)
    gain += g.sum() * whole + 0.5 * (h.sum() + l2) * whole**2
    gain[(hl < least) | (hr < least) | (sign * (vr - vl) < 0)] = -np.inf
    k = int(np.argmax(gain)) if len(gain) else 0
    return (float(gain[k]), k, float(vl[k]), float(vr[k])) if len(gain) else (-np.inf, 0, 0.0, 0.0)


def train(x: np.ndarray, y: np.ndarray, directions: list[int], trees: int = 60, depth: int = 4, rate: float = 0.15, bins: int = 64, l2: float = 1.0, least: float = 2.0) -> Trees:
    """Boosted trees for 0/1 labels.  A split on a constrained feature must order
    its sides, and the middle of their values bounds all values below."""
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], axis=1)
    p = float(np.clip(y.mean(), 1e-6, 1 - 1e-6))
    base = float(np.log(p / (1 - p)))
    score = np.full(len(y), base)
    nodes = 2 ** (depth + 1) - 1
    shape = (trees, nodes)
    out = Trees(np.zeros(shape, np.int32), np.zeros(shape), np.tile(np.arange(nodes, dtype=np.int32), (trees, 1)), np.tile(np.arange(nodes, dtype=np.int32), (trees, 1)), np.zeros(shape), base, depth)
    for t in range(trees):
        q = 1 / (1 + np.exp(-score))
        g, h = q - y, q * (1 - q)
        where = np.zeros(len(y), np.int32)
        bounds = {0: (-np.inf, np.inf)}
        out.value[t, 0] = -g.sum() / (h.sum() + l2)
        for level in range(depth):
            for node in range(2**level - 1, 2 ** (level + 1) - 1):
                if node not in bounds:
                    continue
                own = np.flatnonzero(where == node)
                low, high = bounds[node]
                best = (1e-9, -1, 0, 0.0, 0.0)
                for f, e in enumerate(edges):
                    if not len(e):
                        continue
                    b = binned[own, f]
                    gain, k, vl, vr = _best_split(np.bincount(b, g[own], len(e) + 1), np.bincount(b, h[own], len(e) + 1), low, high, directions[f], l2, least)
                    if gain > best[0]:
                        best = (gain, f, k, vl, vr)
                _, f, k, vl, vr = best
                if f < 0:
                    continue
                a, b = 2 * node + 1, 2 * node + 2
                out.feature[t, node], out.threshold[t, node] = f, edges[f][k]
                out.left[t, node], out.right[t, node] = a, b
                out.value[t, a], out.value[t, b] = vl, vr
                mid = (vl + vr) / 2
                s = directions[f]
                bounds[a] = (mid if s < 0 else low, mid if s > 0 else high)
                bounds[b] = (mid if s > 0 else low, mid if s < 0 else high)
                where[own] = np.where(binned[own, f] <= k, a, b)
        out.value[t] *= rate
        score += out.value[t, where]
    return out


_STATS = "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, features array<double>, base_failed boolean, score double"
_STATS_PA = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in _BASE), ("features", pa.list_(pa.float64())), ("base_failed", pa.bool_()), ("score", pa.float64())])


def _scored(model: Trees | None, features: list[list[float]]) -> np.ndarray:
    return model.score(np.array(features, float).reshape(len(features), len(FEATURES))) if model is not None else np.ones(len(features))


def judge(docs: DataFrame, model: Trees | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Statistics, features, base verdict and score of each row; no shuffle."""
    spark = docs.sparkSession
    prepare(spark)
    shipped = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in rows_of(batches, "doc_id", "text"):
            ids, bases, features = [], [], []
            for doc_id, text in part:
                base, f = statistics(text)
                ids.append(doc_id)
                bases.append(base)
                features.append(f)
            if ids:
                out = Out(_STATS_PA)
                for i, b, f, s in zip(ids, bases, features, _scored(shipped.value, features)):
                    out.add(i, *b, f, base_failed(b), float(s))
                yield out.take()

    return docs.selectExpr(f"cast(`{id_col}` as bigint) doc_id", f"cast(`{text_col}` as string) text").mapInArrow(run, _STATS)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Trees | None:
    """Train on a bounded sample of labelled documents; None without both labels."""
    own = labels.selectExpr(f"cast(`{id_col}` as bigint) as label_doc", f"cast(`{label_col}` as int) as good").where("label_doc is not null and good in (0, 1)").distinct()
    n = own.count()
    if not n:
        return None
    if sample < n:
        own = own.where(F.pmod(F.xxhash64("label_doc"), F.lit(1 << 20)) < F.lit(-(-(sample << 20) // n)))
    # About ``sample`` rows of two numbers each: a bounded broadcast.
    chosen = docs.selectExpr(f"cast(`{id_col}` as bigint) doc_id", f"cast(`{text_col}` as string) text").join(F.broadcast(own), F.col("doc_id") == F.col("label_doc"))
    # The label travels as the id; copies of one row, however many, count once.
    both = chosen.selectExpr("cast(good as bigint) as doc_id", "text").distinct()
    rows = judge(both, None).select("doc_id", "features").collect()
    y = np.array([r["doc_id"] for r in rows], float)
    if len(set(y)) < 2:
        return None
    x = np.array([r["features"] for r in rows], float)
    order = np.lexsort((*x.T, y))  # the same trees whatever order the rows came in
    return train(x[order], y[order], list(FEATURES.values()))


def accept(docs: DataFrame, model: Trees | None, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that the rules and the trees keep."""
    spark = docs.sparkSession
    prepare(spark)
    shipped = spark.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            found = [statistics(t) for t in b.column(at).to_pylist()]
            if found:
                good = _scored(shipped.value, [f for _, f in found]) >= threshold
                yield b.filter(pa.array([bool(g) and not base_failed(x) for g, (x, _) in zip(good, found)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
