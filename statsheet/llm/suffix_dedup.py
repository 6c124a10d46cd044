"""Exact removal of repeated passages, with a sparse suffix array.

A byte goes if a string of ``length`` bytes that covers it also starts anywhere
else.  Sorting every suffix would write many times the input, so only suffixes
at *anchors* are sorted: the anchor of a string of ``length`` bytes is the place
in it where the hash of ``SEED`` bytes is least, so equal strings have equal
anchors at equal places, and about one byte in 75 is an anchor.

1. Each document gives its anchors: the seed (the suffix's leading bytes,
   hashed), the run of strings that share the anchor, and a hash of that whole
   run.  Anchors are range-partitioned by sampled splitters on seed, run hash
   and place, so that one very common passage is spread over many buckets.
   Buckets are sorted and neighbours are compared; the runs at a bucket's edges
   are settled with the edges of the buckets beside it.
2. Equal run hashes: every string of the run is repeated.
3. Equal seeds with different run hashes (where copies begin, end or differ):
   one run of each kind is opened into its single strings, whose hashes are
   range-partitioned, sorted and compared the same way.
4. The repeated strings of a document meet its text by a hash of id and text,
   and their union is cut out.

Runs are compared by a hash modulo 2**61 - 1, opened strings by that and 32 bits of an
independent one (93 bits in all); the bases are drawn anew for each job (see ``hashing``).  A document is known by a hash of id and text; should two different ones
share it, both are known by another.  Defined cases: a null text counts as empty; texts shorter than ``length`` lose nothing; overlaps and repeats within
one document count; strings never cross documents.  A repeated row is a second
document, so all its strings are repeated.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, prepare, rows_of, shared_folder, slices
from .hashing import FIXED_BASE, draw, hasher, mix, wrapping

LENGTH = 200
SEED = 50
_SEGMENT = 1 << 20  # string starts handled at once; bounds memory in long texts
_BITS = 12  # of a run's size and of its anchor's place; starts have the other 40
_ROWS = 200_000
_MOST_SHARED = 100_000  # of 10**12 documents about 30,000 are expected to share a uid


def _pack(start: np.ndarray, count: np.ndarray, place: np.ndarray) -> np.ndarray:
    return (start << (2 * _BITS)) | (count << _BITS) | place


def unpack(packed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first start, number of starts) of packed runs."""
    return packed >> (2 * _BITS), (packed >> _BITS) & ((1 << _BITS) - 1)


def _sliding_least(v: np.ndarray, width: int) -> np.ndarray:
    """Least value of every ``width`` neighbours, by block-wise running minima."""
    n = len(v) - width + 1
    blocks = np.concatenate((v, np.full(-len(v) % width, np.iinfo(np.uint64).max, np.uint64))).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def anchors(data: bytes, length: int = LENGTH, seed: int = SEED, base: int = FIXED_BASE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(seed hash, run hash, packed run) of every run of strings with one anchor."""
    found, seeds, hashes = [], wrapping(base), hasher(base)
    bits = np.uint64((_SEGMENT + length).bit_length())
    for at in range(0, max(len(data) - length + 1, 0), _SEGMENT):
        d = np.frombuffer(data, np.uint8, min(_SEGMENT + length - 1, len(data) - at), at)
        h = seeds.windows(seeds.prefix(d), seed)  # seeds that collide are told apart by their runs
        ordered = ((h >> bits) << bits) | np.arange(len(h), dtype=np.uint64)  # ties to the left
        place = (_sliding_least(ordered, length - seed + 1) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        last = np.append(first[1:], len(place)) - 1
        own = place[first]
        run = hashes.ranges(hashes.prefix(d), first, last + length) ^ mix(((last - first) * 4096 + own - first + 1).astype(np.uint64))
        found.append((h[own].view(np.int64), run.view(np.int64), _pack(first + at, last - first + 1, own - first)))
    if not found:
        return (np.empty(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*found))


def string_hashes(data: bytes, packed: np.ndarray, length: int = LENGTH, bases: tuple[int, int] = (FIXED_BASE, FIXED_BASE + 2)) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, other hash, packed single string) of every string of the runs; runs are read one segment at a time."""
    start, count = unpack(np.sort(packed))
    out = []
    for segment in np.unique(start // _SEGMENT):
        own = start // _SEGMENT == segment
        at = int(segment) * _SEGMENT
        d = np.frombuffer(data, np.uint8, min(2 * _SEGMENT + length, len(data) - at), at)
        s, c = start[own] - at, count[own]
        each = np.repeat(s - np.concatenate(([0], np.cumsum(c)[:-1])), c) + np.arange(c.sum())
        one, two = (h.ranges(h.prefix(d), each, each + length) for h in (hasher(bases[0]), wrapping(bases[1])))
        out.append((one.view(np.int64), (two >> np.uint64(32)).view(np.int64), _pack(each + at, np.ones_like(each), np.zeros_like(each))))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.empty(0, np.int64),) * 3


def removed(size: int, packed: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal removed runs."""
    if not len(packed):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    start, count = unpack(packed)
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate((start + count - 1 + length)[order])
    new = np.concatenate(([True], start[1:] > end[:-1]))
    first = np.flatnonzero(new)
    return start[first], np.minimum(end[np.append(first[1:], len(end)) - 1], size)


# ---- Spark ----------------------------------------------------------------------

_ROW = pa.schema([("key", pa.int64()), ("sub", pa.int64()), ("uid", pa.int64()), ("place", pa.int64())])
_ROW_SQL = "key bigint, sub bigint, uid bigint, place bigint"
_FLAGGED = pa.schema([*_ROW, ("bucket", pa.int32()), ("edge", pa.int8()), ("same", pa.bool_()), ("other", pa.bool_()), ("first", pa.bool_())])
_FLAGGED_SQL = _ROW_SQL + ", bucket int, edge tinyint, same boolean, other boolean, first boolean"


def _batches(parts: Iterator[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
    """Rows gathered to batches of a bounded size."""
    held, n = [], 0
    for part in parts:
        held.append(part)
        n += len(part[0])
        if n >= _ROWS:
            yield from _cut(held)
            held, n = [], 0
    if n:
        yield from _cut(held)


def _cut(held: list) -> Iterator[pa.RecordBatch]:
    columns = [np.concatenate(c) for c in zip(*held)]
    for i in range(0, len(columns[0]), _ROWS):
        yield pa.RecordBatch.from_arrays([pa.array(c[i : i + _ROWS]) for c in columns], schema=_ROW)


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Number of the run of equal rows that each row is in."""
    new = np.zeros(len(columns[0]), bool)
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.cumsum(new)


def _flag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one sorted bucket whose key has company or stands at an edge.

    ``same``: another row has the same key and sub.  ``other``: the key has
    other subs.  ``first``: of its key and sub.  ``edge``: 1 in the bucket's
    first key, 2 in its last.  A key that goes on over batches is carried; of a
    very long one, settled rows are let go while it lasts.
    """
    bucket = TaskContext.get().partitionId()
    columns = [np.empty(0, np.int64)] * 4
    began = False  # a first key has been seen and finished
    open_key = None  # (key, last sub, other) of a key whose earlier rows were let go

    def settle(c: list[np.ndarray], last: bool, state):
        """Flags of whole keys (the last one may go on: ``last`` is False then)."""
        nonlocal began
        key, sub, uid, place = c
        keys, pairs = _runs(key), _runs(key, sub)
        n_pair = np.bincount(pairs)[pairs]
        n_key = np.bincount(keys)[keys]
        same = n_pair > 1
        other = n_pair < n_key
        first = np.concatenate(([True], pairs[1:] != pairs[:-1]))
        if state is not None and key[0] == state[0]:
            head = keys == 0
            if sub[0] == state[1]:
                same |= pairs == 0
                first[0] = False
            other |= head & (state[2] | (sub != state[1]))
        edge = np.zeros(len(key), np.int8)
        if not began:
            edge[keys == 0] |= 1
        edge[keys == keys[-1]] |= 2 if last else 0
        return keys, same, other, first, edge

    def emit(c, keep, same, other, first, edge):
        c = [x[keep] for x in c]
        for i in range(0, len(c[0]), _ROWS):
            s = slice(i, i + _ROWS)
            yield pa.RecordBatch.from_arrays([*(pa.array(x[s]) for x in c), pa.array(np.full(len(c[0][s]), bucket, np.int32)), pa.array(edge[keep][s]), pa.array(same[keep][s]), pa.array(other[keep][s]), pa.array(first[keep][s])], schema=_FLAGGED)

    for b in batches:
        columns = [np.concatenate((x, b.column(i).to_numpy())) for i, x in enumerate(columns)]
        key = columns[0]
        if not len(key) or key[0] == key[-1] and len(key) < 5 * _ROWS:
            continue
        if key[0] != key[-1]:  # all but the last key are complete
            cut = int(np.searchsorted(key, key[-1]))
            done, columns = [x[:cut] for x in columns], [x[cut:] for x in columns]
            keys, same, other, first, edge = settle(done, False, open_key)
            open_key, began = None, True
            yield from emit(done, same | other | (edge > 0), same, other, first, edge)
        else:  # one key fills all: it has company, whatever follows
            cut = len(key) - 1
            done, columns = [x[:cut] for x in columns], [x[cut:] for x in columns]
            _, same, other, first, edge = settle(done, False, open_key)
            same[-1] |= done[1][-1] == columns[1][0]
            edge |= 2  # it may reach the bucket's end
            known = open_key is not None and open_key[2]
            open_key = (done[0][-1], done[1][-1], bool(known or other.any()))
            other[:] = True
            yield from emit(done, np.ones(cut, bool), same, other, first, edge)
    if len(columns[0]):
        _, same, other, first, edge = settle(columns, True, open_key)
        yield from emit(columns, same | other | (edge > 0), same, other, first, edge)


def _repeated(rows: DataFrame, folder: str) -> DataFrame:
    """Rows (key, sub, uid, place) whose key occurs again, with ``same``,
    ``other`` and ``first`` settled over bucket edges."""
    spark = rows.sparkSession
    order = ["key", "sub", "uid", "place"]
    rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_flag, _FLAGGED_SQL).write.parquet(folder)
    flagged = spark.read.schema(_FLAGGED_SQL).parquet(folder)
    # Of each bucket the first and the last row: a few numbers per bucket.
    ends = flagged.where("edge > 0").groupBy("bucket").agg(*(f(F.struct("key", "sub")).alias(n) for f, n in ((F.min, "low"), (F.max, "high")))).collect()
    ends = sorted((r["bucket"], tuple(r["low"]), tuple(r["high"])) for r in ends)
    shared = []  # (bucket, key, sub or null): at this edge the neighbour has the key (and the sub)
    for (b, _, high), (c, low, _) in zip(ends, ends[1:]):
        if high[0] == low[0]:
            shared += [(x, high[0], high[1] if high[1] == low[1] else None) for x in (b, c)]
    # At most two rows for each bucket, so small whatever the input.
    # The row of no bucket keeps the plan the same where no edge is shared.
    beside = F.broadcast(spark.createDataFrame([*shared, (-1, 0, None)], "bucket int, key bigint, at bigint").groupBy("bucket", "key").agg(F.collect_set("at").alias("at")))
    both = flagged.join(beside, ["bucket", "key"], "left")
    return both.select(*order, (F.col("same") | F.coalesce(F.array_contains("at", F.col("sub")), F.lit(False))).alias("same"), (F.col("other") | F.col("at").isNotNull()).alias("other"), "first")


def repeated_runs(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """(uid, place): runs of repeated strings of the documents (uid, text)."""
    if not 0 < seed < length or length - seed + 1 >= 1 << _BITS:
        raise ValueError("seed must be shorter than length, by less than 4096")
    prepare(docs.sparkSession)
    folder = shared_folder(docs.sparkSession, "suffixes")
    bases = (draw(), draw())

    def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each():
            for part in rows_of(batches, "uid", "text"):
                for uid, text in part:
                    key, run, place = anchors((text or "").encode(), length, seed, bases[0])
                    yield key, run, np.full(len(key), uid), place

        return _batches(each())

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each():
            for part in rows_of(batches, "uid", "text", "places"):
                for uid, text, places in part:
                    key, sub, place = string_hashes(text.encode(), np.array(places, np.int64), length, bases)
                    yield key, sub, np.full(len(key), uid), place

        return _batches(each())

    sorted_suffixes = _repeated(docs.where(F.octet_length("text") >= length).mapInArrow(suffixes, _ROW_SQL), f"{folder}/suffixes")
    whole = sorted_suffixes.where("same").select("uid", "place")
    opened = sorted_suffixes.where("first and other").groupBy("uid").agg(F.collect_set("place").alias("places"))
    texts = docs.join(opened, "uid")
    single = _repeated(texts.select("uid", "text", "places").mapInArrow(strings, _ROW_SQL), f"{folder}/strings")
    return whole.union(single.where("same").select("uid", "place"))


_CUT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans array<bigint>"
_CUT_PA = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("spans", pa.list_(pa.int64()))])


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, uid, text): ``doc`` holds the row, ``uid`` is a hash of its id and text.

    Rows that repeat id and text share a uid, and nothing else may: uids that different
    pairs share by chance (one pair in 2**64) are looked for, and give way to a second hash."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keyed = docs.select(F.struct("*").alias("doc"), F.xxhash64(F.col(id_col), text).alias("uid"), F.xxhash64(F.lit("other"), text, F.col(id_col)).alias("uid2"), text.alias("text"))
    both = keyed.groupBy("uid").agg(F.min("uid2").alias("low"), F.max("uid2").alias("high"))
    shared = [r["uid"] for r in both.where("low < high").select("uid").limit(_MOST_SHARED + 1).collect()]
    if len(shared) > _MOST_SHARED:
        raise RuntimeError("hashes of documents collide far more often than chance allows")
    uid = F.when(F.col("uid").isin(shared), F.col("uid2")).otherwise(F.col("uid")) if shared else F.col("uid")
    return keyed.select("doc", uid.alias("uid"), "text")


def _places(docs: DataFrame, length: int, seed: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    keyed = _keyed(docs, id_col, text_col)
    # Rows that repeat id and text share a uid; a set holds its runs once for all of them.
    runs = repeated_runs(keyed.select("uid", "text"), length, seed)
    return keyed, runs.groupBy("uid").agg(F.collect_set("place").alias("places"))


def _kept(data: bytes, places, length: int) -> tuple[bytes, np.ndarray, np.ndarray]:
    start, end = removed(len(data), np.array(places if places is not None else [], np.int64), length)
    edges = [0, *(x for pair in zip(start.tolist(), end.tolist()) for x in pair), len(data)]
    return b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])), start, end


def find_repeats(docs: DataFrame, length: int = LENGTH, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: byte counts, the removed spans (start, end, start,
    end, ...) and the SHA-256 of what stays."""
    keyed, places = _places(docs, length, seed, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in rows_of(batches, "doc_id", "text", "places"):
            rows = []
            for doc_id, text, runs in part:
                data = (text or "").encode()
                kept, start, end = _kept(data, runs, length)
                rows.append((doc_id, len(data), len(data) - len(kept), len(start), hashlib.sha256(kept).hexdigest(), np.stack((start, end), axis=1).ravel()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _CUT_PA)], schema=_CUT_PA)

    joined = keyed.select(F.col("doc").getField(id_col).cast("bigint").alias("doc_id"), "text", "uid").join(places, "uid", "left")
    return joined.select("doc_id", "text", "places").mapInArrow(run, _CUT)


def remove_repeats(docs: DataFrame, length: int = LENGTH, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the repeated passages cut out of the text.  A character of
    which a byte goes, goes whole; a null text stays null."""
    keyed, places = _places(docs, length, seed, id_col, text_col)
    joined = keyed.select("doc", "uid").join(places, "uid", "left").select("doc.*", F.col("places").alias(free_name(docs, "places")))
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts = [t if t is None or p is None else _kept(t.encode(), p, length)[0].decode(errors="ignore") for t, p in zip(b.column(at).to_pylist(), b.column(b.num_columns - 1).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if k == at else b.column(k) for k in range(b.num_columns - 1)], names=b.schema.names[:-1])

    return joined.mapInArrow(run, docs.schema)
