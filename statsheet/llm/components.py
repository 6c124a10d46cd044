"""Connected components of links, by alternating large and small stars.

Every round replaces a node's links by links to its least neighbour; after
O(log**2) rounds each node is linked to the least node of its component.  The
large star finds least neighbours by partial aggregation and joins them back;
the small star is one running window over a node's smaller neighbours, in
constant memory.  The links of each
round are written to the shared folder and never leave the executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from .common import shared_folder

#: Links of one part of a round's table: small tables need few tasks.
_PART = 200_000


def _large(e: DataFrame, folder: str, n: int) -> DataFrame:
    """Link each larger neighbour of a node to the least of the node and its neighbours.

    The least neighbours are written first: read back, they join the links as a
    plain table, so Spark can broadcast them while they are few and otherwise
    split the partition of a node with very many links."""
    both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")).coalesce(_parts(2 * n)).write.parquet(folder)
    least = e.sparkSession.read.schema("a bigint, m bigint").parquet(folder)
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small(down: DataFrame) -> DataFrame:
    """Link a node's smaller neighbours, and the node, to the least of them.  ``a > b`` in each row."""
    w = Window.partitionBy("a").orderBy("b")
    own = down.select("a", "b", F.first("b").over(w).alias("m"), F.lag("b").over(w).alias("before")).where("before is null or before < b")
    # The row of the least neighbour gives the node's own link, the others theirs.
    return own.select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))


def _parts(n: int) -> int:
    return max(1, -(-n // _PART))


def _written(e: DataFrame, folder: str, n: int | None) -> tuple[DataFrame, tuple[int, int, int]]:
    """The links read back, and their count and checksums."""
    seen = Observation()
    out = e if n is None else e.coalesce(_parts(n))
    out.observe(seen, F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"), F.sum(F.xxhash64("b", "a") % 1_000_003).alias("s")).write.parquet(folder)
    got = seen.get
    return e.sparkSession.read.schema("a bigint, b bigint").parquet(folder), (got["n"], got["x"], got["s"])


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (two bigint columns);
    the component is its least node.  Null ends, loops and repeats are ignored."""
    a, b = (F.col(c) for c in links.columns)
    folder = shared_folder(links.sparkSession, "components")
    start = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where(a.isNotNull() & b.isNotNull() & (a != b))
    e, before = _written(_small(start), f"{folder}/0", None)
    turn = 0
    while before[0]:
        turn += 1
        e, after = _written(_small(_large(e, f"{folder}/least-{turn}", before[0])), f"{folder}/{turn}", before[0])
        if after == before:
            break
        before = after
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
