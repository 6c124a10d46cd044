"""File-level index of a silver table (S9): zone maps and Bloom filters as tables.

``write_indexed`` stores a dataset in files of narrow period ranges, with Parquet's
own Bloom filters on its ids inside the files, and beside it two small tables:

* ``zones``: of each file its rows and the least and greatest period;
* ``blooms``: of each file and id column a Bloom filter, one row for each 64-bit word
  that has a bit set, sorted by word.

``matching_files`` answers which files can hold a period range and given ids: the zones
by comparing bounds, the filters by looking up the few words that an id's bits
lie in.  ``read_where`` reads those files only, with the same conditions pushed into
the scan, where row-group statistics and Parquet's Bloom filters go on.  A file
that holds a match is always among them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import silver_path

#: Bits of an id's mark in a filter.
HASHES = 4


def _marks(value: Column, words: int) -> Column:
    """The (word, bit) places of an id's text in a filter of ``words`` words."""
    places = F.array(*[F.pmod(F.xxhash64(value, F.lit(i)), F.lit(words * 64)) for i in range(HASHES)])
    return F.transform(places, lambda p: F.struct(F.shiftright(p, 6).alias("word"), F.expr("1L").alias("one"), (p % 64).cast("int").alias("bit")))


def _index_path(silver_root: str, dataset_id: str, part: str) -> str:
    return f"{silver_root.rstrip('/')}/index/{part}/dataset_id={dataset_id}"


def write_indexed(df: DataFrame, silver_root: str, dataset_id: str, period: str, ids: list[str], files: int, words: int = 1 << 14) -> None:
    """Store ``df`` in about ``files`` files by ``period`` and index them.

    ``words`` sizes each file's filters: 64 bits each, some 10 bits for each different id of
    a file (the default holds 100,000) keep one file in a hundred too many."""
    spark = df.sparkSession
    path = silver_path(silver_root, dataset_id)
    writer = df.repartitionByRange(files, F.col(f"`{period}`")).sortWithinPartitions(F.col(f"`{period}`")).write.mode("overwrite").option("compression", "snappy")
    for i in ids:
        writer = writer.option(f"parquet.bloom.filter.enabled#{i}", "true")
    writer.parquet(path)
    stored = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("file"), F.col(f"`{period}`").alias("period"), *[F.col(f"`{i}`").cast("string").alias(f"id{k}") for k, i in enumerate(ids)])
    stored.groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.min("period").alias("low"), F.max("period").alias("high"), F.count_if(F.col("period").isNull()).alias("undated")).coalesce(1).write.mode("overwrite").parquet(_index_path(silver_root, dataset_id, "zones"))
    marked = F.explode(F.concat(*[F.transform(_marks(F.col(f"id{k}"), words), lambda m, k=k: F.struct(F.lit(i).alias("column"), m["word"].alias("word"), m["bit"].alias("bit"))) for k, i in enumerate(ids)])) if ids else None
    if marked is not None:
        bits = stored.select("file", marked.alias("m")).groupBy("file", "m.column", "m.word").agg(F.bit_or(F.expr("shiftleft(1L, m.bit)")).alias("bits"))
        bits.withColumn("words", F.lit(words)).repartitionByRange("column", "word").sortWithinPartitions("column", "word").write.mode("overwrite").parquet(_index_path(silver_root, dataset_id, "blooms"))


def matching_files(spark: SparkSession, silver_root: str, dataset_id: str, start=None, end=None, ids: dict[str, list] | None = None) -> list[str]:
    """The files that can hold a row within the (inclusive) range and, for each id
    column asked for, one of its values; in order."""
    files = spark.read.parquet(_index_path(silver_root, dataset_id, "zones"))
    if start is not None:
        files = files.where(F.col("high") >= F.lit(start))
    if end is not None:
        files = files.where(F.col("low") <= F.lit(end))
    files = files.select("file")
    for column, values in (ids or {}).items():
        blooms = spark.read.parquet(_index_path(silver_root, dataset_id, "blooms")).where(F.col("column") == column)
        words = blooms.agg(F.max("words")).first()[0]
        if words is None:
            continue  # no filter on this column
        asked = spark.createDataFrame([(str(v),) for v in {*values}], "value string")
        marks = asked.select("value", F.explode(_marks(F.col("value"), words)).alias("m")).select("value", "m.word", F.expr("shiftleft(1L, m.bit)").alias("mark")).groupBy("value", "word").agg(F.bit_or("mark").alias("mark"))
        needed = marks.groupBy("value").agg(F.count(F.lit(1)).alias("needed"))
        hit = marks.join(blooms, "word").where(F.col("bits").bitwiseAND(F.col("mark")) == F.col("mark")).groupBy("file", "value").agg(F.count(F.lit(1)).alias("n"))
        files = files.join(hit.join(needed, "value").where("n = needed").select("file"), "file", "left_semi")
    return sorted(r["file"] for r in files.collect())


def read_where(spark: SparkSession, silver_root: str, dataset_id: str, period: str, start=None, end=None, ids: dict[str, list] | None = None) -> DataFrame:
    """The rows of the range with the ids asked for, from the files that can hold them."""
    path = silver_path(silver_root, dataset_id)
    schema = spark.read.parquet(path).schema
    files = matching_files(spark, silver_root, dataset_id, start, end, ids)
    df = spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
    if start is not None:
        df = df.where(F.col(f"`{period}`") >= F.lit(start))
    if end is not None:
        df = df.where(F.col(f"`{period}`") <= F.lit(end))
    for column, values in (ids or {}).items():
        df = df.where(F.col(f"`{column}`").cast("string").isin([str(v) for v in values]) if isinstance(values[0], str) else F.col(f"`{column}`").isin(list(values)))
    return df
