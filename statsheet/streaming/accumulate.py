"""Accumulating snapshots into history (G1).

Published snapshot files hold only the newest period; history is built by
keeping, per key (entity, period), the row from the newest fetch.  The same
upsert runs as a batch call or inside Structured Streaming's
``foreachBatch`` over a landing folder (``Trigger.AvailableNow``), and a
replayed batch gives the same history.

Each upsert touches only the period partitions present in the batch:

1. the batch and the history rows of its periods are combined and reduced
   with ``max_by(row, (fetched_at, tiebreak))`` per key (partial
   aggregation, so a hot key does not gather in one task);
2. the result is written to a staging folder under the shared checkpoint
   directory (Spark cannot overwrite a path it is reading);
3. the staged partitions replace the history's with dynamic partition
   overwrite, so untouched periods stay as they are.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dictionary import value_counts
from ..session import checkpoint_dir


#: Files of one period in one write: a hot period is spread over that many tasks.
FILES_PER_PERIOD = 8


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the one with the greatest ``order`` tuple; rows that tie
    on it are decided by a hash of the whole row."""
    row = F.struct(*df.columns)
    best = df.groupBy(*keys).agg(F.max_by(row, F.struct(*order, F.xxhash64(*df.columns).alias("_tie"))).alias("_r"))
    return best.select("_r.*")


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


def upsert(
    batch: DataFrame, history_path: str, keys: list[str], order: list[str], partition_col: str, checkpoints: str | None = None,
    dictionary_path: str | None = None, dimensions: list[str] | None = None,
) -> None:
    """Merge one batch of snapshot rows into the history table.  ``checkpoints``
    is the shared folder for staging (else ``spark.checkpoint.dir``).

    With ``dictionary_path`` the values of ``dimensions`` are counted beside it, by
    period, so that only the touched periods are counted anew
    (``operators.dictionary.read_dictionary`` sums them up)."""
    spark = batch.sparkSession
    if batch.isEmpty():
        return
    combined = batch
    if _exists(spark, history_path):
        touched = batch.select(partition_col).distinct()
        # Read with the batch's schema so the partition column keeps its type
        # (no partition type inference).
        old = spark.read.schema(batch.schema).parquet(history_path).join(touched, partition_col, "left_semi")
        combined = old.unionByName(batch.select(*old.columns))
    merged = latest_per_key(combined, keys, order)
    staging = f"{checkpoint_dir(spark, checkpoints).rstrip('/')}/statsheet-staging-{uuid.uuid4().hex}"
    placed = merged.repartition(F.col(partition_col), F.pmod(F.xxhash64(*keys), F.lit(FILES_PER_PERIOD)))
    placed.write.partitionBy(partition_col).parquet(staging)
    staged = spark.read.schema(merged.schema).parquet(staging).select(*merged.columns)
    staged.repartition(F.col(partition_col), F.pmod(F.xxhash64(*keys), F.lit(FILES_PER_PERIOD))).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(partition_col).parquet(history_path)
    if dictionary_path:
        counts = value_counts(staged, {d: F.col(f"`{d}`") for d in dimensions or []}, (partition_col,))
        counts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_col).parquet(dictionary_path)
    _delete(spark, staging)


def _delete(spark: SparkSession, path: str) -> None:
    """Remove a folder of our own making."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def accumulate_stream(
    spark: SparkSession,
    landing: str,
    schema: str,
    history_path: str,
    keys: list[str],
    order: list[str],
    partition_col: str,
    query_checkpoint: str | None = None,
):
    """Run the upsert over every file in ``landing`` not yet seen, then stop.

    The stream's own checkpoint records which files were processed, so a rerun
    picks up only new snapshots, in another process too: by default it lies in
    the shared checkpoint folder under a digest of the history's path.
    """
    name = hashlib.sha256(history_path.encode()).hexdigest()[:24]
    ckpt = query_checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/statsheet-accumulate-{name}"
    stream = spark.readStream.schema(schema).parquet(landing)
    q = (
        stream.writeStream.foreachBatch(lambda df, _id: upsert(df, history_path, keys, order, partition_col))
        .option("checkpointLocation", ckpt)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return q
