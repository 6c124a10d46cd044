"""Exact top-k inner products with a pivot-distance index.

Vectors become integers (``floor(scale * x)``).  They are classed by the power of
two of their length, scaled by that power into the unit ball, and one more component
puts each on the unit sphere, so within a class the largest inner product with a
query is the least Euclidean distance to it.  Each vector is keyed by its class, its
nearest pivot and its distance from it; an annulus holds the vectors of one class
and pivot within a range of distances.  A few very long vectors are a class of
their own and do not blunt the bounds of the others.

A query first looks at its most promising annuli until they hold k vectors; the k-th
score found bounds anything better.  Then it expands, in order of their bounds,
the annuli which the triangle inequality cannot rule out, and stops at the first
that it can.  Both steps are one join of packed queries with packed vectors on the
annulus and one matrix product per pair of packs: in floating point where that is
exact, else in 64-bit integers, else in Python integers.

Pivots and the annuli's limits come from a bounded sample, in numbers that follow the
table's size; every vector is indexed.  Annuli with many vectors (copies, too)
are cut into blocks by a hash of id and place, so no task holds an unbounded annulus.

Defined cases: vectors that are null, or hold null or non-finite components, take no
part, nor do rows with a null id; every finite vector does.  A result whose score
leaves the long range is an error.  Shorter vectors count as padded with zeros.  Rows
that repeat a query's id are one query (the least vector, by its components as
given), and never its own candidates; other repeated rows are candidates as often as
they occur.  Fewer than k candidates give fewer rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Out, cut_lineage, prepare, rows_of

SAMPLE = 4096
RING = 512  # vectors of an annulus, about, while there are fewer than MOST_RINGS
MOST_RINGS = 4096  # of a class
BLOCK = 2048  # vectors of a block
PACK = 256  # queries of a pack
_SLACK = 1e-7  # of coefficients in floating point; they are of the order of 1
_LOW, _HIGH = -(1 << 63), (1 << 63) - 1


# ---- exact integers -------------------------------------------------------------------


def packed(vector: list[float]) -> bytes:
    """Components as given: 4 bytes each where that loses nothing, else 8 and a mark."""
    x = np.array(vector, float)
    with np.errstate(over="ignore"):
        short = x.astype(np.float32)
    return short.tobytes() if (short == x).all() else x.tobytes() + b"8"


def given(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.float64, len(data) // 8) if len(data) % 4 else np.frombuffer(data, np.float32).astype(float)


def floored(rows: list[bytes], dim: int, scale: int) -> np.ndarray:
    """``floor(scale * x)`` as doubles; infinite where only a Python integer holds it."""
    out = np.zeros((len(rows), dim))
    for row, b in zip(out, rows):
        x = given(b)
        row[: len(x)] = x
    with np.errstate(over="ignore"):
        return np.floor(scale * out)


def exact(data: bytes, dim: int, scale: int) -> list[int]:
    """The same as Python integers."""
    x = [int(c) * scale if abs(c) >= 2**53 else math.floor(scale * c) for c in given(data).tolist()]
    return x + [0] * (dim - len(x))


def unit(data: bytes, dim: int, scale: int) -> tuple[int, np.ndarray]:
    """(e, y): the integers are y * 2**e, with 1/2 <= |y| < 1 or so; (0, zeros) for the zero vector."""
    x = floored([data], dim, scale)[0]
    more = 0
    if not np.isfinite(x).all():
        wide = exact(data, dim, scale)
        more = max(abs(c) for c in wide).bit_length() - 60
        x = np.array([float(c >> more) for c in wide])
    top = math.frexp(float(np.abs(x).max(initial=0)))[1]
    y = np.ldexp(x, -top)
    e = math.frexp(math.sqrt(float(y @ y)))[1]
    return (top + e + more, np.ldexp(y, -e)) if y.any() else (0, y)


def products(q_rows: list[bytes], v_rows: list[bytes], dim: int, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places of queries, their exact scores with all vectors), by the cheapest exact arithmetic."""
    q, v = floored(q_rows, dim, scale), floored(v_rows, dim, scale)
    with np.errstate(over="ignore", invalid="ignore"):
        reach = np.sqrt((q**2).sum(axis=1)) * math.sqrt((v**2).sum(axis=1).max(initial=0))
        fits = (np.abs(q).max(axis=1, initial=0) < 2**62) & (np.abs(v).max(initial=0) < 2**62)
    # All partial sums are bounded by the lengths' product: exact below 2**53, and in 64 bits below 2**63.
    near = np.flatnonzero(reach < 2**52)
    if len(near):
        yield near, (q[near] @ v.T).astype(np.int64)
    middle = np.flatnonzero((reach >= 2**52) & (reach < 2**62) & fits)
    if len(middle):
        yield middle, q[middle].astype(np.int64) @ v.astype(np.int64).T
    far = np.flatnonzero(~(reach < 2**62) | ~((reach < 2**52) | fits))
    if len(far):
        wide = np.array([exact(b, dim, scale) for b in v_rows], object).reshape(len(v_rows), dim)
        for i in far.tolist():
            yield np.array([i]), (wide @ np.array(exact(q_rows[i], dim, scale), object)).reshape(1, -1)


# ---- the index ----------------------------------------------------------------------------


@dataclass
class Space:
    """The pivots on the unit sphere, the limits of their annuli, and the annuli."""

    dim: int
    scale: int
    pivots: np.ndarray  # [pivot, dim + 1]
    limits: list[np.ndarray]  # inner limits of each pivot's annuli
    classes: np.ndarray | None = None  # of each non-empty annulus: its class,
    of_pivot: np.ndarray | None = None  # its pivot,
    counts: np.ndarray | None = None  # its vectors,
    low: np.ndarray | None = None  # their least and largest distance from the pivot
    high: np.ndarray | None = None

    def lifted(self, rows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(classes, points on the sphere)."""
        found = [unit(b, self.dim, self.scale) for b in rows]
        y = np.stack([y for _, y in found])
        rest = np.sqrt(np.maximum(1 - np.einsum("ij,ij->i", y, y), 0))
        return np.array([e for e, _ in found]), np.concatenate((y, rest[:, None]), axis=1)

    def distances(self, points: np.ndarray) -> np.ndarray:
        d = np.einsum("ij,ij->i", points, points)[:, None] + np.einsum("ij,ij->i", self.pivots, self.pivots)[None] - 2 * points @ self.pivots.T
        return np.sqrt(np.maximum(d, 0))

    def place(self, rows: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(class, pivot, annulus, distance) of each vector."""
        classes, points = self.lifted(rows)
        d = self.distances(points)
        pivot = d.argmin(axis=1)
        own = d[np.arange(len(rows)), pivot]
        return classes, pivot, np.array([np.searchsorted(self.limits[p], r) for p, r in zip(pivot, own)], np.int64), own

    def bounds(self, query: bytes) -> tuple[np.ndarray, np.ndarray]:
        """For one query the annuli from the most promising on, and the most that a score in each can be."""
        e, u = unit(query, self.dim, self.scale)
        d = self.distances(np.append(u, 0.0)[None])[0][self.of_pivot]
        least = np.maximum(np.maximum(d - self.high, self.low - d) - _SLACK, 0)
        # |u - y|**2 = 1 + |u|**2 - 2 u.y on the sphere, and a score is u.y * 2**(e + class).
        most = (1 + float(u @ u) - least**2) / 2 + _SLACK
        with np.errstate(over="ignore"):
            most = np.ldexp(most, e + self.classes)
        order = np.lexsort((np.abs(d - (self.low + self.high) / 2), -most))
        return order, most[order]


def choose(sample: list[bytes], dim: int, scale: int, rings: int) -> Space:
    """Pivots far from each other, and limits that cut the sample evenly: about ``rings`` annuli."""
    space = Space(dim, scale, np.zeros((0, dim + 1)), [])
    _, x = space.lifted(sample)
    pivots = max(1, round(math.sqrt(rings)))
    annuli = -(-rings // pivots)
    chosen = [0]
    nearest = ((x - x[0]) ** 2).sum(axis=1)
    while len(chosen) < min(pivots, len(x)) and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, ((x - x[chosen[-1]]) ** 2).sum(axis=1))
    space.pivots = x[chosen]
    d = space.distances(x)
    own = d.argmin(axis=1)
    for p in range(len(chosen)):
        r = d[own == p, p]
        space.limits.append(np.unique(np.quantile(r, np.linspace(0, 1, annuli + 1)[1:-1])) if len(r) else np.empty(0))
    return space


# ---- Spark ----------------------------------------------------------------------------------

_PACKED = pa.schema([("vec_id", pa.int64()), ("vector", pa.binary())])


def _taking_part(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    rows = vectors.selectExpr(f"cast(`{id_col}` as bigint) vec_id", f"cast(`{vector_col}` as array<double>) vector")
    return rows.where("vec_id is not null and vector is not null and forall(vector, x -> x is not null and abs(x) < double('infinity'))")


def _pack_rows(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Out(_PACKED)
        for part in rows_of(batches, "vec_id", "vector"):
            for vec_id, v in part:
                data = packed(v)
                out.add(vec_id, data, size=len(data))
                if out.full():
                    yield out.take()
        yield out.take()

    return rows.mapInArrow(run, "vec_id bigint, vector binary")


_PLACED = pa.schema([("vec_id", pa.int64()), ("vector", pa.binary()), ("class", pa.int32()), ("pivot", pa.int32()), ("annulus", pa.int32()), ("distance", pa.float64()), ("place", pa.int64())])


def _place(rows: DataFrame, space: Space) -> DataFrame:
    shipped = rows.sparkSession.sparkContext.broadcast(space)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s, n = shipped.value, 0
        for b in batches:
            for i in range(0, b.num_rows, 4096):
                c = b.slice(i, 4096)
                found = s.place(c.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([c.column(0), c.column(1), *(pa.array(x, f.type) for x, f in zip(found, list(_PLACED)[2:6])), pa.array(np.arange(n, n + c.num_rows))], schema=_PLACED)
                n += c.num_rows

    return rows.mapInArrow(run, "vec_id bigint, vector binary, class int, pivot int, annulus int, distance double, place bigint")


def _packs(rows: DataFrame, keys: list[str], most: int) -> DataFrame:
    """Ids and vectors of the rows of each key, side by side, at most ``most`` in a row."""
    schema = pa.schema([("number", pa.int32()), ("ids", pa.binary()), ("vectors", pa.list_(pa.binary()))])

    def row(key: tuple, own: list[tuple]) -> pa.RecordBatch:
        ids = np.array([r[-2] for r in own], np.int64).tobytes()
        return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int32()), pa.array([ids]), pa.array([[r[-1] for r in own]], pa.list_(pa.binary()))], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = (r for part in rows_of(batches, *keys, "vec_id", "vector") for r in part)
        for key, own in groupby(stream, key=lambda r: r[: len(keys)]):
            held = []
            for r in own:
                held.append(r)
                if len(held) == most:
                    yield row(key, held)
                    held = []
            if held:
                yield row(key, held)

    return rows.select(*keys, "vec_id", "vector").repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "number int, ids binary, vectors array<binary>")


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, ties to the smaller id."""
    if len(ids) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        own = np.flatnonzero(scores >= least)
    else:
        own = np.arange(len(ids))
    order = sorted(own.tolist(), key=lambda i: (-scores[i], ids[i])) if scores.dtype == object else own[np.lexsort((ids[own], -scores[own]))].tolist()
    return np.array(order[:k], np.int64)


_HIT = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()), ("under", pa.bool_())])


def _scores(queries: DataFrame, blocks: DataFrame, space: Space, k: int) -> DataFrame:
    """For each pair of packs on one annulus, each query's best rows.  ``under``: the
    score is less than any long, which matters only if nothing better is found."""
    dim, scale = space.dim, space.scale

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Out(_HIT)
        for part in rows_of(batches, "q_ids", "q_vectors", "ids", "vectors"):
            for q_ids, q_vectors, ids, vectors in part:
                q_ids, ids = np.frombuffer(q_ids, np.int64), np.frombuffer(ids, np.int64)
                for places, scores in products(q_vectors, vectors, dim, scale):
                    for i, s in zip(places.tolist(), scores):
                        own = int(q_ids[i])
                        other = np.flatnonzero(ids != own)
                        for j in other[best(ids[other], s[other], k)].tolist():
                            if s[j] > _HIGH:
                                raise OverflowError(f"the score of {own} and {ids[j]} is {s[j]}, beyond a long")
                            out.add(own, int(ids[j]), max(int(s[j]), _LOW), bool(s[j] < _LOW))
                if out.full():
                    yield out.take()
        yield out.take()

    packs = queries.select("number", F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"))
    return packs.join(blocks, "number").select("q_ids", "q_vectors", "ids", "vectors").mapInArrow(run, "query_id bigint, vec_id bigint, score bigint, under boolean")


def _top(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "under", "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


_VISIT = pa.schema([("number", pa.int32()), ("vec_id", pa.int64()), ("vector", pa.binary())])


def _visits(queries: DataFrame, space: Space, k: int, later: bool) -> DataFrame:
    """(annulus number, query) rows of the first step, or with ``later`` (and a
    column ``least``, the k-th score so far or null) of the second."""
    shipped = queries.sparkSession.sparkContext.broadcast(space)
    columns = ["vec_id", "vector", *(["least"] if later else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s, out = shipped.value, Out(_VISIT)
        for part in rows_of(batches, *columns):
            for vec_id, vector, *least in part:
                order, most = s.bounds(vector)
                # The query itself is among the vectors, hence one more.
                first = min(int(np.searchsorted(np.cumsum(s.counts[order]), k + 1)) + 1, len(order))
                if later:
                    open_ = np.ones(len(order) - first, bool) if least[0] is None else most[first:] + np.abs(most[first:]) * _SLACK >= least[0]
                    chosen = order[first:][open_]
                else:
                    chosen = order[:first]
                for number in chosen.tolist():
                    out.add(number, vec_id, vector, size=len(vector))
                    if out.full():
                        yield out.take()
        yield out.take()

    return queries.select(*columns).mapInArrow(run, "number int, vec_id bigint, vector binary")


@dataclass
class Index:
    """The indexed vectors: ``placed`` with class, pivot, annulus and distance, ``blocks`` packed by annulus."""

    space: Space
    placed: DataFrame
    blocks: DataFrame


def build(rows: DataFrame, scale: int, sample: int = SAMPLE, ring: int = RING) -> Index | None:
    """Index of (vec_id, packed vector); None without vectors."""
    spark = rows.sparkSession
    # A bounded draw by hash; its size is the parameter ``sample``.
    drawn = [r["vector"] for r in rows.orderBy(F.xxhash64("vec_id"), "vec_id", "vector").limit(sample).select("vector").collect()]
    if not drawn:
        return None
    size = F.octet_length("vector")
    n, dim = rows.agg(F.count(F.lit(1)), F.max(F.when(size % 4 == 0, size / 4).otherwise((size - 1) / 8)).cast("int")).first()
    space = choose(drawn, dim, scale, max(1, min(MOST_RINGS, round(n / ring))))
    placed = cut_lineage(_place(rows, space))
    # At most MOST_RINGS rows for each class, of which there are as many as powers of two.
    rings = sorted(tuple(r) for r in placed.groupBy("class", "pivot", "annulus").agg(F.count(F.lit(1)), F.min("distance"), F.max("distance")).collect())
    space.classes, space.of_pivot, space.counts, space.low, space.high = (np.array([r[i] for r in rings]) for i in (0, 1, 3, 4, 5))
    names = spark.createDataFrame([(*r[:3], i, -(-r[3] // BLOCK)) for i, r in enumerate(rings)], "class int, pivot int, annulus int, number int, blocks int")
    numbered = placed.join(F.broadcast(names), ["class", "pivot", "annulus"]).withColumn("block", F.pmod(F.xxhash64("vec_id", "place"), F.col("blocks")).cast("int"))
    return Index(space, placed, cut_lineage(_packs(numbered, ["number", "block"], 2 * BLOCK)))


def visited_share(vectors: DataFrame, queries_where, k: int = 10, scale: int = 1024, id_col: str = "vec_id", vector_col: str = "embedding", ring: int = RING) -> float:
    """The share of all (query, vector) pairs that a search scores: what the bounds leave."""
    return _search(vectors, queries_where, k, scale, id_col, vector_col, SAMPLE, ring)[1]()


def search(vectors: DataFrame, queries_where, k: int = 10, scale: int = 1024, id_col: str = "vec_id", vector_col: str = "embedding", sample: int = SAMPLE, ring: int = RING) -> DataFrame:
    """The k best other rows of each query: query_id, rank, vec_id, score.

    ``queries_where`` is a condition on ``vec_id`` that names the query rows."""
    return _search(vectors, queries_where, k, scale, id_col, vector_col, sample, ring)[0]


def _search(vectors, queries_where, k, scale, id_col, vector_col, sample, ring):
    spark = vectors.sparkSession
    prepare(spark)
    taking = _taking_part(vectors, id_col, vector_col)
    index = build(cut_lineage(_pack_rows(taking)), scale, sample, ring)
    if index is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint"), lambda: 0.0
    space = index.space
    queries = cut_lineage(_pack_rows(taking.where(queries_where).groupBy("vec_id").agg(F.min("vector").alias("vector"))))
    n = queries.count()
    packs = max(1, -(-n // PACK))

    def step(visits: DataFrame) -> DataFrame:
        return _scores(_packs(visits.withColumn("pack", F.pmod(F.xxhash64("vec_id"), F.lit(packs)).cast("int")), ["number", "pack"], 2 * PACK), index.blocks, space, k)

    early = _visits(queries, space, k, later=False)
    first = cut_lineage(_top(step(early), k).drop("rank"))
    kth = first.groupBy("query_id").agg(F.min("score").alias("low"), F.count(F.lit(1)).alias("n")).select(F.col("query_id").alias("vec_id"), F.when(F.col("n") >= k, F.col("low")).alias("least"))
    late = _visits(queries.join(kth, "vec_id", "left"), space, k, later=True)
    top = _top(first.union(step(late)), k)
    score = F.when(F.col("under"), F.raise_error(F.lit("a score is beyond a long")).cast("bigint")).otherwise(F.col("score"))

    def share() -> float:
        of = {r["number"]: r["count"] for r in early.union(late).groupBy("number").count().collect()}
        return sum(int(space.counts[i]) * c for i, c in of.items()) / (n * int(space.counts.sum())) if n else 0.0

    return top.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", score.alias("score")), share
