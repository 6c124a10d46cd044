"""Reading source tables.

A spec names either a table under a catalogue root (``<root>/<table>.parquet``)
or an explicit path.  Parquet is read as is (its schema is the contract);
CSV is read with an all-text schema built from the header, never inferred,
and goes through the same coercion as any text cell.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..spec import Spec


def source_path(spec: Spec, root: str | None) -> str:
    if spec.path:
        return spec.path
    if not spec.table:
        raise ValueError(f"dataset {spec.id!r} names neither a table nor a path")
    if root is None:
        raise ValueError(f"dataset {spec.id!r} needs a catalogue root for table {spec.table!r}")
    ext = {"parquet": "parquet", "csv": "csv"}.get(spec.format, spec.format)
    return f"{root.rstrip('/')}/{spec.table}.{ext}"


def read_csv_text(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """CSV with every column as text.  The header names come from ``columns``
    when given (metadata), else from the file's header line."""
    # Names are matched by each file's header, not by position: a file whose
    # header differs is an error rather than a silent shift of its columns.
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE").option("multiLine", False).option("enforceSchema", False)
    if columns is not None:
        schema = StructType([StructField(c, StringType(), True) for c in columns])
        return reader.schema(schema).csv(path)
    header = spark.read.text(path).limit(1).collect()
    if not header:
        return spark.createDataFrame([], StructType([]))
    import csv

    names = next(csv.reader([header[0][0]]))
    schema = StructType([StructField(n, StringType(), True) for n in names])
    return reader.schema(schema).csv(path)


def read_source(
    spark: SparkSession, spec: Spec, root: str | None = None, start_iso: str | None = None, end_iso: str | None = None
) -> DataFrame:
    """The spec's source table.  Period bounds reach the workbook decoder
    (row skip while reading); Parquet gets them as pushed filters later."""
    path = source_path(spec, root)
    if spec.format == "parquet":
        return spark.read.parquet(path)
    if spec.format == "csv":
        return read_csv_text(spark, path)
    if spec.format == "xlsx":
        from .workbook import read_sheet

        return read_sheet(spark, path, spec, start_iso=start_iso, end_iso=end_iso)
    raise ValueError(f"unsupported format {spec.format!r}")


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


def silver_path(silver_root: str, dataset_id: str) -> str:
    return f"{silver_root.rstrip('/')}/dataset_id={dataset_id}"


def write_silver(
    df: DataFrame, silver_root: str, dataset_id: str, mode: str = "overwrite", cluster_by: str | None = None
) -> None:
    """Store one dataset's parsed table (source headers) as snappy Parquet.

    Each dataset has its own folder ``dataset_id=<id>`` under the silver
    root, so datasets with different columns never share a schema and one
    dataset's rewrite leaves the others untouched.  ``cluster_by`` (the
    period column) sorts rows within each task before writing, so every
    row group covers a narrow period range and the min/max statistics let
    period ranges and the newest-day bound of ``latest`` skip row groups.
    """
    if cluster_by and cluster_by in df.columns:
        df = df.sortWithinPartitions(F.col(f"`{cluster_by}`"))
    df.write.mode(mode).option("compression", "snappy").parquet(silver_path(silver_root, dataset_id))


def read_silver(spark: SparkSession, silver_root: str, dataset_id: str) -> DataFrame:
    return spark.read.parquet(silver_path(silver_root, dataset_id))


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str) -> DataFrame:
    """A catalogue table over ``path``, dealt into ``buckets`` by ``key`` and sorted by it.

    Two tables with the same number of buckets join on their keys without an exchange:
    ``operators.lookups.pair_entities`` on them shuffles nothing, however often it is
    run.  The number of buckets follows the larger table, at some 256 MB each."""
    placed = df.repartition(buckets, F.col(f"`{key}`"))
    placed.write.bucketBy(buckets, key).sortBy(key).mode("overwrite").option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)
