"""Periodic runs of words: repeated phrases, loops of boiled-down or generated text.

A run is a stretch of consecutive words with smallest period q (words q apart
are the same) and at least ``max(least, exponent * q)`` words, that no
neighbouring word extends without breaking the period.

* Harmonic grid.  In a run of period q the words that equal the word q further
  on form a stretch of at least ``g = max(least - q, (exponent - 1) * q)``.  So
  for every q, only the places 0, h, 2h, ... with ``h = g // 2`` are tried: the
  grid has about n log n points.  A point where the next few words differ from
  those q further on lies in no run.
* Each other point is extended both ways by longest common extensions (LCE).
* Difference-cover LCE.  Positions whose remainder modulo ``V`` is in ``COVER``
  are sampled; for any two positions some shift under V brings both onto samples.
  Only sampled suffixes are sorted: by their first V words, then by doubling
  (V words further on lies a sample of the same remainder), where suffixes that
  are alone already take no further part.  An LCE query compares the few words up
  to the synchronised samples and reads the rest as a range minimum over the
  neighbours' common prefixes, from a sparse table.  Leftward extensions use the
  same structure on the reversed words.

Words are exact (numbered by a dictionary), so no step rests on hashes.  A
document is handled whole inside a task; documents are taken in chunks of
``CHUNK`` words, so memory follows the longest document, at about 200 bytes a
word of it.  No shuffle.

Defined cases: a null or empty text has no words, no runs and an empty collapsed
text.  Repeated rows give repeated results; ids may be null.  Columns beside the
two named ones are not read.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Out, prepare, rows_of

V = 31
#: Every remainder modulo 31 is a difference of two of these.
COVER = np.array([1, 5, 11, 24, 25, 27])
CHUNK = 150_000  # words
GRID = 500_000  # grid points tried at a time
_CHECKED = 4  # words compared at a grid point before its extension is asked for

_IN_COVER = np.zeros(V, bool)
_IN_COVER[COVER] = True
#: _SHIFT[i % V, j % V]: the least shift that brings both positions onto samples.
_SHIFT = np.array([[next(s for s in range(V) if _IN_COVER[(i + s) % V] and _IN_COVER[(j + s) % V]) for j in range(V)] for i in range(V)])


def _groups(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order by the keys, first key first; for each place of that order: does a new group start)."""
    order = np.lexsort(keys[::-1])
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.logical_or.reduce([k[order[1:]] != k[order[:-1]] for k in keys])
    return order, new


class Extensions:
    """Longest common extensions to the right, over ``ids`` whose documents end
    in ids that occur nowhere else."""

    def __init__(self, ids: np.ndarray):
        n, top = len(ids), int(ids.max(initial=0)) + 1
        self.words = np.concatenate((ids, np.arange(top, top + 2 * V, dtype=ids.dtype)))
        place = np.arange(n + V)
        self.at = place[_IN_COVER[place % V]]  # sampled positions, ascending
        self.number = np.full(n + V, -1, np.int64)  # position -> sample
        self.number[self.at] = np.arange(len(self.at))
        self._sort()
        self._neighbours()

    def _refine(self, rank: np.ndarray, *keys: np.ndarray) -> np.ndarray:
        """Ranks by (rank, keys); a rank is the number of samples before its group,
        so a sample that is alone in its group keeps its rank and is left out."""
        count = np.bincount(rank, minlength=len(rank))
        tied = np.flatnonzero(count[rank] > 1)
        if not len(tied):
            return rank
        order, new = _groups(rank[tied], *(k[tied] for k in keys))
        old = rank[tied][order]
        first = np.ones(len(old), bool)
        first[1:] = old[1:] != old[:-1]
        run = np.arange(len(old))
        since = run - np.maximum.accumulate(np.where(first, run, 0))  # place within the old group
        out = rank.copy()
        out[tied[order]] = old + np.maximum.accumulate(np.where(new, run, 0)) - (run - since)
        return out

    def _sort(self) -> None:
        m = len(self.at)
        rank = np.zeros(m, np.int64)
        for t in range(0, V, 3):
            rank = self._refine(rank, *(self.words[self.at + s] for s in range(t, min(t + 3, V))))
        self.levels, step = [rank], V  # level k ranks by the first V * 2**k words
        while len(np.unique(rank)) < m:
            after = np.minimum(self.at + step, len(self.number) - 1)
            there = np.where(self.at + step < len(self.number), self.number[after], -1)
            rank = self._refine(rank, np.where(there >= 0, rank[there], -1))
            self.levels.append(rank)
            step *= 2
        self.rank = rank

    def _neighbours(self) -> None:
        """Common prefixes of neighbours in the order, and minima of 2**k of them."""
        order = np.argsort(self.rank)
        i, j = self.at[order[:-1]].copy(), self.at[order[1:]].copy()
        common = np.zeros(len(i), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            a, b = (np.where(x < len(self.number), self.number[np.minimum(x, len(self.number) - 1)], -1) for x in (i, j))
            step = np.where((a >= 0) & (b >= 0) & (self.levels[k][a] == self.levels[k][b]), V << k, 0)
            i, j, common = i + step, j + step, common + step
        table = [(common + self._few(i, j, np.full(len(i), V))).astype(np.int32)]
        while 2 << len(table) <= 2 * len(table[0]) and len(table[-1]) > 1 << (len(table) - 1):
            half = 1 << (len(table) - 1)
            table.append(np.minimum(table[-1][:-half], table[-1][half:]))
        self.table = table
        del self.levels

    def _few(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Equal words from i and j on, counted up to ``most`` (V or fewer)."""
        got = np.zeros(len(i), np.int64)
        live = np.flatnonzero(most > 0)
        last = len(self.words) - 1
        for t in range(V):
            live = live[(most[live] > t)]
            a, b = i[live] + t, j[live] + t
            live = live[(np.maximum(a, b) <= last) & (self.words[np.minimum(a, last)] == self.words[np.minimum(b, last)])]
            if not len(live):
                break
            got[live] += 1
        return got

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Equal words from the different positions i and j on."""
        shift = _SHIFT[i % V, j % V]
        out = self._few(i, j, shift)
        on = np.flatnonzero(out == shift)
        a, b = self.rank[self.number[i[on] + shift[on]]], self.rank[self.number[j[on] + shift[on]]]
        low, high = np.minimum(a, b), np.maximum(a, b)  # minimum of table[0][low:high]
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        for k in np.unique(level):
            of = np.flatnonzero(level == k)
            t = self.table[k]
            out[on[of]] += np.minimum(t[low[of]], t[high[of] - (1 << int(k))])
        return out


def _grid(sizes: np.ndarray, least: int, exponent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(document, place within it, period, step limit of checked words) points, in bounded lots."""
    most = np.where(sizes >= least, sizes // exponent, 0)
    doc = np.repeat(np.arange(len(sizes)), most)
    q = np.arange(len(doc)) - np.repeat(np.cumsum(most) - most, most) + 1
    g = np.maximum(least - q, (exponent - 1) * q)
    h = np.maximum(g // 2, 1)
    points = -(-(sizes[doc] - q) // h)
    ends = np.cumsum(points)
    at = 0
    while at < len(doc):
        to = max(int(np.searchsorted(ends, (ends[at - 1] if at else 0) + GRID, "right")), at + 1)
        n = points[at:to]
        k = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        yield np.repeat(doc[at:to], n), k * np.repeat(h[at:to], n), np.repeat(q[at:to], n), np.repeat((g - h + 1)[at:to], n)
        at = to


def runs_of(documents: list[np.ndarray], least: int = 24, exponent: int = 3) -> list[np.ndarray]:
    """For each document (word numbers) its runs as rows (start, length, period),
    by start, then period."""
    found: list[np.ndarray] = [np.empty((0, 3), np.int64)] * len(documents)
    sizes = np.array([len(d) for d in documents], np.int64)
    ids, starts = _joined(documents)
    docs, places, periods = [], [], []
    for doc, place, q, most in _grid(sizes, least, exponent):
        live = np.arange(len(doc))
        for t in range(_CHECKED):
            a = starts[doc[live]] + place[live] + t
            live = live[(most[live] <= t) | (ids[a] == ids[np.minimum(a + q[live], len(ids) - 1)])]
        docs.append(doc[live])
        places.append(place[live])
        periods.append(q[live])
    if not docs or not sum(map(len, docs)):
        return found
    doc, place, q = np.concatenate(docs), np.concatenate(places), np.concatenate(periods)
    # Only documents with points left are sorted.
    own, doc = np.unique(doc, return_inverse=True)
    ids, starts = _joined([documents[d] for d in own])
    right, left = Extensions(ids), Extensions(ids[::-1].copy())
    kept = []
    for at in range(0, len(doc), GRID):
        d, p, i = doc[at : at + GRID], q[at : at + GRID], starts[doc[at : at + GRID]] + place[at : at + GRID]
        start = i - left.common(len(ids) - i, len(ids) - i - p)
        length = i + p + right.common(i, i + p) - start
        good = length >= np.maximum(least, exponent * p)
        kept.append(np.stack((d, start - starts[d], length, p), axis=1)[good])
    run = np.concatenate(kept)
    # One stretch shows at multiples of its smallest period too: keep the smallest.
    order, _ = _groups(run[:, 0], run[:, 1], run[:, 2], run[:, 3])
    run = run[order]
    first = np.ones(len(run), bool)
    first[1:] = (run[1:, :3] != run[:-1, :3]).any(axis=1)
    run = run[first]
    run = run[np.lexsort((run[:, 3], run[:, 1], run[:, 0]))]
    edge = np.searchsorted(run[:, 0], np.arange(len(own) + 1))
    for k, d in enumerate(own):
        found[d] = run[edge[k] : edge[k + 1], 1:]
    return found


def _joined(documents: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All word numbers, each document between ids that occur nowhere else; the documents' starts."""
    sizes = np.array([len(d) for d in documents], np.int64)
    starts = 1 + np.cumsum(sizes + 1) - (sizes + 1)
    top = max((int(d.max(initial=0)) for d in documents), default=0) + 1
    ids = np.arange(top, top + int(sizes.sum()) + len(documents) + 1 + _CHECKED, dtype=np.int64)
    for s, d in zip(starts, documents):
        ids[s : s + len(d)] = d
    return ids, starts


def dropped_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of n words lie in some run after that run's first period."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edge[:n]) > 0


_FOUND = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
        ("collapsed", pa.binary()),
    ]
)


def find_runs(docs: DataFrame, least: int = 24, exponent: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period),
    collapsed (the words that no run repeats, joined by one space)."""
    if least < 1 or exponent < 2:
        raise ValueError("least is 1 or more, exponent 2 or more")
    prepare(docs.sparkSession)
    rows = docs.selectExpr(f"cast(`{id_col}` as bigint) doc_id", f"cast(cast(`{text_col}` as string) as binary) text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held, n = Out(_FOUND), [], 0
        for part in rows_of(batches, "doc_id", "text"):
            for doc_id, text in part:
                words = (text or b"").split()  # bytes split at \x20 and \x09-\x0D
                held.append((doc_id, words))
                n += len(words)
                if n >= CHUNK:
                    yield from _chunk(held, least, exponent, out)
                    held, n = [], 0
        yield from _chunk(held, least, exponent, out)
        yield out.take()

    found = rows.mapInArrow(run, "doc_id bigint, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed binary")
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))


def _chunk(held: list[tuple], least: int, exponent: int, out: Out) -> Iterator[pa.RecordBatch]:
    numbers = pa.array([w for _, words in held for w in words], pa.large_binary()).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum([len(words) for _, words in held])
    documents = np.split(numbers, ends[:-1]) if held else []
    for (doc_id, words), runs in zip(held, runs_of(documents, least, exponent)):
        if len(runs):
            kept = b" ".join([w for w, gone in zip(words, dropped_words(len(words), runs).tolist()) if not gone])
            listed = [dict(zip(("start", "length", "period"), r)) for r in runs.tolist()]
        else:
            kept, listed = b" ".join(words), []
        out.add(doc_id, len(words), listed, kept, size=len(kept))
        if out.full():
            yield out.take()
