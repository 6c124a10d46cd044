"""Near-duplicate documents by HyperMinHash signatures, links verified exactly.

1. A document is the set of its word shingles (64-bit hashes, from a base drawn
   for each job, see ``hashing``).  Equal sets form a class; from here on one document stands for its class.
2. HyperMinHash: the hash range is cut into equal buckets, and a bucket keeps of
   its least hash the count of leading zeros and some mantissa bits, in 16 bits.
   An empty bucket borrows the register of a full one, so short documents have
   full signatures.  Registers are banded; band values are grouped with partial
   aggregation, and every class of a band is tied to its least member only.
3. Ties join classes into candidate groups (``components``).  Only their members'
   sets are made again, and shuffled to blocks of bounded size: a group's chunks,
   each with the same few landmarks.  Inside a block the collision-corrected
   estimate skips hopeless pairs, pairs already in one component are skipped too,
   and the rest are compared on full sets.
4. What a group's blocks leave apart from its largest component is compared, in
   further blocks, with the rest of its group.  So no link inside a group is
   lost, while a large group of mutual copies costs one pass.

A pair at the threshold shares no band with a probability under ``MISS``.

Defined cases: without words a document has an empty set and links with
nothing; with fewer words than a shingle the whole sequence is its one shingle.
Rows of one id are one node.  A row with a null id links with nothing, its
component is null, and it is kept.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Out, cut_lineage, prepare, rows_of, shared_folder, slices
from .components import components
from .hashing import FIXED_BASE, Hasher, draw, hasher, mix

MISS = 1e-6  # chance that a pair at the threshold shares no band
MOST_BANDS = 48
MANTISSA = 10  # bits of a register beside its 6 bits of leading zeros
CHUNK = 128  # classes of a block
LANDMARKS = 24
PAIR_CHUNK = 64  # of a block of the second round, on each side
_SURE = 6  # standard deviations that an estimate may be off

_SEPARATOR = re.compile(rb"[\x20\x09-\x0D]")
_PIECE = 1 << 20
_LONG = 1 << 21  # bytes; longer words are hashed part by part
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_IS_SEPARATOR = np.array([c == 32 or 9 <= c <= 13 for c in range(256)])


@dataclass(frozen=True)
class Rule:
    """Documents are linked at ``intersection / union >= percent / 100``."""

    words: int = 5
    percent: int = 80

    @property
    def bands(self) -> tuple[int, int]:
        """(bands, registers of a band): the longest bands that still meet MISS."""
        t = self.percent / 100
        for rows in range(16, 0, -1):
            n = math.ceil(math.log(MISS) / math.log1p(-(t**rows))) if t < 1 else 1
            if n <= MOST_BANDS:
                return n, rows
        raise ValueError("the threshold is too low for bands of one register")

    @property
    def registers(self) -> int:
        n, rows = self.bands
        return n * rows


def word_hashes(text: str, base: int = FIXED_BASE) -> np.ndarray:
    """A hash of each word, in order; long texts are read in pieces cut at separators."""
    hashes = hasher(base)
    data = text.encode("utf-8", "surrogatepass").translate(_LOWER)
    found, at = [], 0
    while at < len(data):
        end = min(at + _PIECE, len(data))
        if end < len(data):
            m = _SEPARATOR.search(data, end)
            end = m.start() if m else len(data)
        last = None
        if end - at > _LONG + _PIECE:  # the last word here is a very long one
            gaps = np.flatnonzero(_IS_SEPARATOR[np.frombuffer(data, np.uint8, _PIECE, at)])
            last, end = end, at + int(gaps[-1]) + 1 if len(gaps) else at
        b = np.frombuffer(data, np.uint8, end - at, at)
        gap = np.concatenate(([True], _IS_SEPARATOR[b], [True]))
        edge = np.flatnonzero(gap[1:] != gap[:-1])
        if len(edge):
            found.append(hashes.ranges(hashes.prefix(b), edge[::2], edge[1::2]))
        if last is not None:
            found.append(_long_word(data[end:last], hashes))
            end = last
        at = end
    return np.concatenate(found) if found else np.empty(0, np.uint64)


def _long_word(data: bytes, hashes: Hasher) -> np.ndarray:
    h = np.zeros(1, np.uint64)
    for at in range(0, len(data), _LONG):
        b = np.frombuffer(data, np.uint8, min(_LONG, len(data) - at), at)
        h = mix(h * np.uint64(0x2545F4914F6CDD1D) + hashes.ranges(hashes.prefix(b), np.array([0]), np.array([len(b)])))
    return h


def shingles(text: str | None, words: int, base: int = FIXED_BASE) -> np.ndarray:
    """Different shingles, ascending."""
    w = word_hashes(text or "", base)
    n = min(len(w), words)
    if not n:
        return w
    h = np.full(len(w) - n + 1, n, np.uint64)
    for j in range(n):
        h = mix(h * np.uint64(0x2545F4914F6CDD1D) + w[j : len(w) - n + 1 + j])
    return np.unique(h)


def _bucket_starts(registers: int) -> np.ndarray:
    return np.array([-(-(j << 64) // registers) for j in range(registers)], np.uint64)


def signature(shingle_set: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """HyperMinHash registers (leading zeros, mantissa) of a sorted, non-empty set."""
    first = np.searchsorted(shingle_set, starts)
    after = np.append(first[1:], len(shingle_set))
    full = np.flatnonzero(first < after)
    width = 64 - (len(starts) - 1).bit_length()  # bits of a value within a bucket, at most one more
    value = shingle_set[first[full]] - starts[full]
    low, high = np.frexp(value.astype(np.float64))  # value = low * 2**high, 0.5 <= low < 1
    zeros = np.clip(width + 1 - high, 0, 63).astype(np.uint16)
    # The mantissa from the integer itself: its bits below the leading one.
    bits = np.maximum(high.astype(np.int64) - 1 - MANTISSA, 0).astype(np.uint64)
    mantissa = ((value >> bits) & np.uint64((1 << MANTISSA) - 1)).astype(np.uint16)
    registers = np.empty(len(starts), np.uint16)
    registers[full] = (zeros << MANTISSA) | mantissa
    if len(full) < len(starts):
        empty = np.setdiff1d(np.arange(len(starts)), full, assume_unique=True)
        registers[empty] = registers[full[_lenders(len(starts))[np.ix_(empty, full)].argmin(axis=1)]]
    return registers


@lru_cache(maxsize=4)
def _lenders(registers: int) -> np.ndarray:
    """Fixed random ranks: an empty bucket borrows from the full one that ranks
    first for it, so each borrowed register agrees as often as the sets do."""
    return np.random.Generator(np.random.PCG64(registers)).integers(0, 1 << 32, (registers, registers), np.uint32)


def band_hashes(registers: np.ndarray, bands: int, rows: int) -> np.ndarray:
    r = registers.reshape(bands, rows).astype(np.uint64)
    h = np.arange(1, bands + 1, dtype=np.uint64)
    for j in range(rows):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + r[:, j])
    return h


def estimate(one: np.ndarray, others: np.ndarray, sizes: np.ndarray, size: int) -> np.ndarray:
    """Jaccard estimates from registers, corrected for chance collisions: two
    unrelated registers agree with a probability of about 0.17 * 2**-MANTISSA,
    times a factor of the set sizes (as published for HyperMinHash)."""
    m = others.shape[1]
    n, k = np.maximum(sizes, size) / m, np.minimum(sizes, size) / m
    chance = 0.169919487159739 * 2.0**-MANTISSA * 4 * n / (1 + n) ** 2 * np.where(k > 0, 1, 0)
    equal = (others == one).mean(axis=1)
    return (equal - chance) / (1 - chance)


class Sets:
    """Union-find over the members of one block, seeded with known components."""

    def __init__(self, seeds: list):
        self.parent = list(range(len(seeds)))
        first: dict = {}
        for i, s in enumerate(seeds):
            if s is not None:
                self.join(first.setdefault(s, i), i)

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, i: int, j: int) -> None:
        self.parent[self.root(i)] = self.root(j)


def links_of_block(sets: list[np.ndarray], seeds: list, rule: Rule, left: list[int] | None = None) -> Iterator[tuple[int, int]]:
    """Verified links that join the block's components.  ``left``: compare only
    these members with all (the others are done among themselves)."""
    starts = _bucket_starts(rule.registers)
    sizes = np.array([len(s) for s in sets])
    registers = np.stack([signature(s, starts) for s in sets])
    known = Sets(seeds)
    t, chosen = rule.percent / 100, set(left or ())
    for i in range(len(sets)) if left is None else left:
        own = np.minimum(sizes, sizes[i])
        spread = np.sqrt(t * (1 - t) / np.clip(own / 2, 1, rule.registers))
        hope = (estimate(registers[i], registers, sizes, int(sizes[i])) >= t - _SURE * spread) & (100 * own >= rule.percent * np.maximum(sizes, sizes[i]))
        order = np.flatnonzero(hope)
        for j in order[np.argsort(-(registers[order] == registers[i]).sum(axis=1), kind="stable")].tolist():
            if j == i or (j < i and (left is None or j in chosen)) or known.root(i) == known.root(j):
                continue
            a, b = sets[i], sets[j]
            at = np.minimum(np.searchsorted(a, b), len(a) - 1)
            both = int((a[at] == b).sum())
            if 100 * both >= rule.percent * (len(a) + len(b) - both):
                known.join(i, j)
                yield i, j


# ---- Spark ----------------------------------------------------------------------

_SIGNED = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_key", pa.binary()), ("bands", pa.list_(pa.int64()))])
_LINK = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _signed(rows: DataFrame, rule: Rule, base: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, out = _bucket_starts(rule.registers), Out(_SIGNED)
        for part in rows_of(batches, "doc_id", "text"):
            for doc_id, text in part:
                s = shingles(text, rule.words, base)
                if len(s):
                    out.add(doc_id, len(s), hashlib.blake2b(s.tobytes(), digest_size=16).digest(), band_hashes(signature(s, starts), *rule.bands).view(np.int64), size=400)
                else:
                    out.add(doc_id, 0, None, None)
                if out.full():
                    yield out.take()
        yield out.take()

    return rows.mapInArrow(run, "doc_id bigint, n_shingles bigint, set_key binary, bands array<bigint>")


def _with_sets(rows: DataFrame, rule: Rule, base: int) -> DataFrame:
    """Replace ``text`` by ``shingles`` (the sorted set as bytes)."""
    at = rows.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in slices(batches):
            sets = pa.array([shingles(t, rule.words, base).tobytes() for t in c.column(at).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([sets if k == at else c.column(k) for k in range(c.num_columns)], names=["shingles" if k == at else n for k, n in enumerate(c.schema.names)])

    return rows.mapInArrow(run, ", ".join(f"{'shingles binary' if n == 'text' else f'{n} {k}'}" for n, k in rows.dtypes))


def _in_blocks(rows: DataFrame, keys: list[str], rule: Rule) -> DataFrame:
    """Links found in each block; rows hold keys, node, component, is_left, shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Out(_LINK)
        stream = (r for part in rows_of(batches, *keys, "node", "component", "is_left", "shingles") for r in part)
        for _, block in groupby(stream, key=lambda r: r[: len(keys)]):
            own: dict[tuple, list] = {}
            for *_, node, component, is_left, data in block:
                own.setdefault((node, data), [component, False])[1] |= bool(is_left)
            if len(own) < 2:
                continue
            nodes = [n for n, _ in own]
            left = [i for i, (_, x) in enumerate(own.values()) if x]
            sets = [np.frombuffer(d, np.uint64) for _, d in own]
            for i, j in links_of_block(sets, [c for c, _ in own.values()], rule, None if len(left) == len(own) else left):
                out.add(nodes[i], nodes[j])
            if out.full():
                yield out.take()
        yield out.take()

    placed = rows.select(*keys, "node", "component", "is_left", "shingles").repartition(*keys).sortWithinPartitions(*keys)
    return placed.mapInArrow(run, "a bigint, b bigint")


def _chunk(column: str, size: str, most: int, salt: int):
    """(chunk of a member, number of chunks) in a group of ``size`` members."""
    n = F.ceil(F.col(size) / most).cast("int")
    return F.pmod(F.xxhash64(column, F.lit(salt)), n).cast("int"), n


def link_documents(docs: DataFrame, rule: Rule = Rule(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (least id
    reachable over links), kept (it stands for its component)."""
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.selectExpr(f"cast(`{id_col}` as bigint) doc_id", f"cast(`{text_col}` as string) text")

    # 1. Sets, classes of equal sets.
    folder, base = shared_folder(spark, "near-dedup"), draw()
    _signed(rows, rule, base).write.parquet(f"{folder}/signed")
    signed = spark.read.parquet(f"{folder}/signed")
    able = signed.where("n_shingles > 0 and doc_id is not null")
    classes = cut_lineage(able.groupBy("set_key", "n_shingles").agg(F.min("doc_id").alias("node")).select("set_key", F.col("node")))

    # 2. Bands: each class is tied to the least class of its bucket.
    banded = able.join(classes.select(F.col("node").alias("doc_id"), F.col("set_key").alias("own_key")), "doc_id").where("set_key = own_key").select(F.col("doc_id").alias("node"), F.explode("bands").alias("band"))
    buckets = banded.groupBy("band").agg(F.min("node").alias("least"), F.max("node").alias("most")).where("least < most").select("band", "least")
    ties = banded.join(buckets, "band").where("node <> least").select("node", "least")
    groups = components(ties)

    # 3. Blocks of each candidate group.
    sizes = groups.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    chunk, chunks = _chunk("node", "size", CHUNK, 1)
    member = groups.join(sizes, "component").select("node", F.col("component").alias("grp"), chunk.alias("chunk"), chunks.alias("chunks"), "size")
    # Merge join at every size: broadcasting the members would hold only for small tables.
    texts = _with_sets(rows.join(member.hint("merge"), F.col("doc_id") == F.col("node")).select("node", "grp", "chunk", "chunks", "size", "text"), rule, base)
    texts.write.parquet(f"{folder}/members")
    members = spark.read.parquet(f"{folder}/members")
    landmark = (F.col("chunks") > 1) & (F.pmod(F.xxhash64("node", F.lit(2)), F.col("size")) < LANDMARKS)
    blocks = members.withColumn("chunk", F.explode(F.when(landmark, F.sequence(F.lit(0), F.col("chunks") - 1)).otherwise(F.array("chunk"))))
    first = cut_lineage(_in_blocks(blocks.withColumns({"component": F.lit(None).cast("bigint"), "is_left": F.lit(True)}), ["grp", "chunk"], rule))

    # 4. In groups of several chunks, the rest against all.
    parts = components(first)
    large = members.where("chunks > 1").select("node", "grp", "size").distinct()
    of = cut_lineage(large.join(parts, "node", "left").select("node", "grp", "size", F.coalesce("component", "node").alias("component")))
    counts = of.groupBy("grp", "component").agg(F.count(F.lit(1)).alias("n"))
    main = counts.groupBy("grp").agg(F.max(F.struct("n", "component")).alias("top"), F.sum("n").alias("all"), F.max("n").alias("most")).where("all > most").select("grp", F.col("top.component").alias("main"), (F.col("all") - F.col("most")).alias("rest"))
    told = of.join(main, "grp").withColumn("outside", F.col("component") != F.col("main"))
    left_chunk, left_chunks = _chunk("node", "rest", PAIR_CHUNK, 3)
    right_chunk, right_chunks = _chunk("node", "size", PAIR_CHUNK, 4)
    sides = told.select(
        "node",
        "component",
        F.explode(
            F.concat(
                F.when(F.col("outside"), F.transform(F.sequence(F.lit(0), right_chunks - 1), lambda c: F.struct(F.col("grp"), left_chunk.alias("left"), c.alias("right"), F.lit(True).alias("is_left")))).otherwise(F.array()),
                F.transform(F.sequence(F.lit(0), left_chunks - 1), lambda c: F.struct(F.col("grp"), c.alias("left"), right_chunk.alias("right"), F.lit(False).alias("is_left"))),
            )
        ).alias("side"),
    ).select("node", "component", "side.*")
    second = _in_blocks(members.select("node", "shingles").join(sides, "node"), ["grp", "left", "right"], rule)
    of_node = components(parts.select(F.col("node").alias("a"), F.col("component").alias("b")).union(second))

    # Every row's class, its node, its component.
    found = signed.join(classes, "set_key", "left").join(of_node, "node", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "node", "doc_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def one_of_each(docs: DataFrame, rule: Rule = Rule(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component: the row of its least id
    (of rows that repeat that id, the one whose text hashes least).  Rows with a
    null id all stay."""
    linked = link_documents(docs, rule, id_col, text_col)
    dropped = linked.where("not kept").select(F.col("doc_id").alias("dropped")).distinct()
    # Rows travel as one column each, so their names meet no others.
    named = docs.select(F.struct("*").alias("doc"), F.col(id_col).cast("bigint").alias("own"), F.xxhash64(text_col).alias("order"))
    left = named.where("own is not null").join(dropped, F.col("own") == F.col("dropped"), "left_anti")
    first = left.withColumn("place", F.row_number().over(Window.partitionBy("own").orderBy("order"))).where("place = 1")
    return first.select("doc.*").union(docs.where(F.col(id_col).isNull()))
