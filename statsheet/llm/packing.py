"""Hierarchical packing of documents into windows of several context sizes.

Each partition packs its own documents as it reads them, so nothing is
shuffled and no key can be hot:

1. full windows of the longest size leave a long document at once; what is
   left of each document goes to the shortest tier that holds it;
2. every window of a tier is opened by that tier's largest remainder, and its
   gap is filled from the shorter tiers, best fit first;
3. a gap that nothing fits is closed by the head of a document of the shortest
   tier, whose rest is routed again, so windows are full;
4. the windows of a tier are dealt into step groups of equal size, the dearest
   first to the group with the least attention cost (sum of squared piece
   lengths).

A partition holds one buffer of documents at a time; what does not fill a
window waits for the next buffer, and what is left at the end of a partition
is cut into full windows of power-of-two sizes.

Defined cases: a null text counts as empty: one piece with the end id.
Repeated rows and ids are packed as separate documents.  A null id stays null.
An empty table gives no rows.
"""

from __future__ import annotations

import heapq
import struct
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import Out, prepare, rows_of
from .tokens import broadcast_vocabulary, encoder

TIERS = (256, 512, 1024, 2048)
BUFFER_TOKENS = 1 << 21
STEP = 8  # windows of a step group


class Packer:
    """``add`` documents by length, ``flush`` windows ``(size, [(doc, start, length)])``."""

    def __init__(self, tiers: tuple[int, ...] = TIERS):
        if not tiers or any(t & (t - 1) or t < 1 for t in tiers):
            raise ValueError("tiers must be powers of two")
        self.tiers = tuple(sorted(set(tiers)))
        #: For each tier its remainders (length, doc, start), ascending.
        self.waiting: list[list[tuple[int, int, int]]] = [[] for _ in self.tiers]
        self.done: list[tuple[int, list[tuple[int, int, int]]]] = []

    def route(self, length: int, doc: int, start: int) -> None:
        for t, rest in zip(self.tiers, self.waiting):
            if length <= t:
                insort(rest, (length, doc, start))
                return

    def add(self, doc: int, length: int) -> None:
        longest, start = self.tiers[-1], 0
        while length - start >= longest:
            self.done.append((longest, [(doc, start, longest)]))
            start += longest
        if start < length:
            self.route(length - start, doc, start)

    def _best_fit(self, gap: int, below: int) -> tuple[int, int, int] | None:
        """Take the longest remainder that fits, from the tiers up to ``below``."""
        best, where = None, 0
        for k in range(below, -1, -1):
            at = bisect_right(self.waiting[k], (gap, float("inf"), 0)) - 1
            if at >= 0 and (best is None or self.waiting[k][at][0] > best):
                best, where, place = self.waiting[k][at][0], k, at
            if best is not None:
                break  # a shorter tier holds nothing longer
        return None if best is None else self.waiting[where].pop(place)

    def flush(self, last: bool = False) -> list[tuple[int, list[tuple[int, int, int]]]]:
        """Finished windows.  Without ``last``, what fills no window waits."""
        for k in range(len(self.tiers) - 1, -1, -1):
            size = self.tiers[k]
            while self.waiting[k]:
                length, doc, start = self.waiting[k].pop()
                window, gap = [(doc, start, length)], size - length
                while gap:
                    found = self._best_fit(gap, k)
                    if found is None:
                        rest = next((w for w in self.waiting[: k + 1] if w), None)
                        if rest is None:
                            break
                        length, doc, start = rest.pop(0)
                        self.route(length - gap, doc, start + gap)
                        found = (gap, doc, start)
                    window.append((found[1], found[2], found[0]))
                    gap -= found[0]
                if not gap:
                    self.done.append((size, window))
                elif last:
                    self.done += powers_of_two(window)
                else:
                    for doc, start, length in window:
                        self.route(length, doc, start)
                    break  # nothing is left to fill this or a shorter window
            else:
                continue
            break
        out, self.done = self.done, []
        return out


def powers_of_two(window: list[tuple[int, int, int]]) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """Cut one unfilled window into full windows of falling powers of two."""
    left, out = list(reversed(window)), []
    total = sum(p[2] for p in window)
    while total:
        size = 1 << (total.bit_length() - 1)
        part, gap = [], size
        while gap:
            doc, start, length = left.pop()
            if length > gap:
                left.append((doc, start + gap, length - gap))
                length = gap
            part.append((doc, start, length))
            gap -= length
        out.append((size, part))
        total -= size
    return out


def step_groups(windows: list[tuple[int, list[tuple[int, int, int]]]], step: int = STEP) -> list[int]:
    """A group number for each window: groups hold up to ``step`` windows of one
    size, with costs as equal as dealing the dearest first makes them."""
    by_size: dict[int, list[int]] = {}
    for i, (size, _) in enumerate(windows):
        by_size.setdefault(size, []).append(i)
    group, base = [0] * len(windows), 0
    for size in sorted(by_size):
        own = sorted(by_size[size], key=lambda i: (-sum(p[2] ** 2 for p in windows[i][1]), i))
        n = -(-len(own) // step)
        heap = [(0, g, 0) for g in range(n)]
        for i in own:
            cost, g, held = heapq.heappop(heap)
            group[i] = base + g
            if held + 1 < step:
                heapq.heappush(heap, (cost + sum(p[2] ** 2 for p in windows[i][1]), g, held + 1))
        base += n
    return group


def pack(docs: DataFrame, vocabulary_path: str, end_id: int, tiers: tuple[int, ...] = TIERS, buffer_tokens: int = BUFFER_TOKENS, step: int = STEP, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: its document, place in it, window, place there, the
    window's size and step group, and with ``with_ids`` the ids themselves."""
    spark = docs.sparkSession
    prepare(spark)
    vocabulary = broadcast_vocabulary(spark, vocabulary_path)
    end = struct.pack("<I", end_id)
    names = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, window_size int, step_group bigint" + ", ids binary" * with_ids
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    schema = pa.schema([(n, kinds[k]) for n, k in (x.split() for x in names.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, packer, out = encoder(vocabulary), Packer(tiers), Out(schema)
        first = TaskContext.get().partitionId() << 33
        held: dict[int, tuple[int | None, bytes]] = {}
        number = windows_done = groups_done = tokens = 0

        def emit(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal windows_done, groups_done
            windows = packer.flush(last)
            groups = step_groups(windows, step)
            for (size, parts), group in zip(windows, groups):
                at = 0
                for doc, start, length in parts:
                    doc_id, ids = held[doc]
                    own = ids[4 * start : 4 * (start + length)]
                    row = (doc_id, start, length, zlib.crc32(own), len(ids) // 4, first + windows_done, at, size, first + groups_done + group)
                    out.add(*row, *((own,) if with_ids else ()), size=len(own) if with_ids else 0)
                    at += length
                windows_done += 1
                if out.full():
                    yield out.take()
            groups_done += max(groups, default=-1) + 1
            wait = {doc for rest in packer.waiting for _, doc, _ in rest}
            for doc in [d for d in held if d not in wait]:
                del held[doc]

        for rows in rows_of(batches, "doc_id", "text"):
            for doc_id, text in rows:
                ids = enc.ids(text or "") + end
                held[number] = (doc_id, ids)
                packer.add(number, len(ids) // 4)
                number += 1
                tokens += len(ids) // 4
                if tokens >= buffer_tokens:
                    yield from emit(False)
                    tokens = 0
        yield from emit(True)
        yield out.take()

    return docs.selectExpr(f"cast(`{id_col}` as bigint) doc_id", f"cast(`{text_col}` as string) text").mapInArrow(run, names)
