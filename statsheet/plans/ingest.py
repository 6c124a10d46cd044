"""Batch ingest of many workbooks.

    files ──decode (one task per file)──▶ bronze grid (Parquet, written once)
          ──per dataset: header promotion, layout──▶ silver table per dataset

The bronze write cuts the lineage: every later step reads files from the
shared store, so a lost executor costs a re-read, not a re-decode of every
workbook.  Paths must be on storage all executors share.  The loop over
datasets is a loop over specs (metadata, a few dozen at most); each step is
an ordinary Spark job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.coerce import clean_string, to_double
from ..functions.periods import period_iso_col
from ..operators.dictionary import dictionary_of, dictionary_path
from ..operators.reshape import shape_source
from ..sources.tables import read_silver, write_silver  # noqa: F401  (read_silver re-exported)
from ..sources.workbook import read_workbooks
from ..spec import get_spec

STATUS_CHARS = 200


def write_bronze(spark: SparkSession, files: dict[str, str], bronze_path: str) -> DataFrame:
    """Decode every file once (all sheets the specs need) and write the grid."""
    sheets = sorted({get_spec(d).sheet for d in files if get_spec(d).sheet})
    grid = read_workbooks(spark, sorted(set(files.values())), sheets)
    grid.write.mode("overwrite").parquet(bronze_path)
    return spark.read.parquet(bronze_path)


def parsed_table(bronze: DataFrame, source: str, spec) -> DataFrame:
    """One dataset's parsed table (source headers) from the bronze grid."""
    from ..operators.reshape import promote_header

    sheet_rows = bronze.filter((F.col("source") == source) & (F.col("sheet") == spec.sheet) & F.col("error").isNull())
    return promote_header(sheet_rows.select("row_idx", "cells"), spec.header_row, spec.data_start_row, keep_row_idx=True)


def ingest(spark: SparkSession, files: dict[str, str], bronze_path: str, silver_root: str, max_concurrency: int = 2) -> DataFrame:
    """Parse and store every dataset; returns ``(dataset_id, status)``.

    ``files`` maps dataset id → workbook path.  Unknown ids raise before any
    work.  Datasets are written by up to ``max_concurrency`` concurrent Spark
    jobs (driver threads submitting jobs; the scheduler shares the cluster).
    A failing dataset records its error (first 200 characters) and the
    others go on.
    """
    if max_concurrency < 1:
        raise ValueError("max_concurrency must be >= 1")
    specs = {d: get_spec(d) for d in files}  # raises on unknown ids
    resolved = {d: _qualified(spark, p) for d, p in files.items()}
    bronze = write_bronze(spark, resolved, bronze_path)
    errors = _failed(spark, bronze, resolved, specs)

    def one(did: str) -> tuple[str, str]:
        spec = specs[did]
        src = resolved[did]
        if did in errors:
            return did, ("error: " + errors[did])[:STATUS_CHARS]
        try:
            table = parsed_table(bronze, src, spec)
            period = spec.period_column if spec.layout == "wide" and not spec.snapshot else None
            write_silver(typed(shape_source(table, spec), spec), silver_root, did, cluster_by=period)
            stored = read_silver(spark, silver_root, did)
            dictionary_of(stored, spec).write.mode("overwrite").parquet(dictionary_path(silver_root, did))
            return did, "ok"
        except Exception as e:  # one dataset's failure must not stop the others
            return did, (f"error: {type(e).__name__}: {e}")[:STATUS_CHARS]

    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=max_concurrency) as pool:
        status = list(pool.map(one, list(specs)))
    return spark.createDataFrame(status, "dataset_id string, status string")


def _failed(spark: SparkSession, bronze: DataFrame, files: dict[str, str], specs: dict) -> dict[str, str]:
    """Dataset -> the error of its file or sheet.  The datasets are joined to the
    error rows, so one row per dataset comes back however many errors there are."""
    asked = spark.createDataFrame([(d, files[d], specs[d].sheet) for d in files], "dataset_id string, source string, own_sheet string")
    bad = bronze.filter(F.col("error").isNotNull()).select("source", "sheet", "error")
    hit = asked.join(bad, "source").where("sheet is null or sheet = own_sheet")
    return {r["dataset_id"]: r["e"] for r in hit.groupBy("dataset_id").agg(F.min("error").alias("e")).collect()}


def typed(table: DataFrame, spec) -> DataFrame:
    """Silver types by the spec (P3..P5): measures as double, a period declared
    as a date as DATE (so ranges on it reach the Parquet scan), other declared
    columns as stripped text.  Columns that the spec does not name stay."""
    out = {}
    for c in spec.columns:
        if c.source not in table.columns or not isinstance(table.schema[c.source].dataType, StringType):
            continue
        col = F.col(f"`{c.source}`")
        if c.role == "measure":
            out[c.source] = to_double(col, StringType())
        elif c.source == spec.period_column and c.dtype == "date":
            out[c.source] = F.to_date(F.try_to_timestamp(period_iso_col(col, "string"), F.lit("yyyy-MM-dd")))
        else:
            out[c.source] = clean_string(col, StringType())
    return table.withColumns(out) if out else table


def _qualified(spark: SparkSession, path: str) -> str:
    """The path as the binaryFile source reports it (scheme-qualified)."""
    if "://" in path or path.startswith("file:"):
        return path
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.makeQualified(hadoop_path).toString()
