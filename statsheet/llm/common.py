"""Helpers shared by the operators: tables, shared folders, Arrow batches."""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..session import ship_package

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it; without one, an error."""
    root = spark.conf.get(_CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(_CHECKPOINT_KEY, None)
    if not root:
        raise RuntimeError(f"{_CHECKPOINT_KEY} is not set; the job needs a folder that all executors share")
    return root


def free_name(df: DataFrame, stem: str) -> str:
    """A name like ``stem`` that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared root (created by whoever writes it)."""
    return posixpath.join(shared_root(spark), f"{label}-{uuid.uuid4().hex}")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder: survives lost executors."""
    spark = df.sparkSession
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(shared_root(spark))
    return df.checkpoint(eager=True)


def prepare(spark: SparkSession) -> None:
    """Ship the package to the executors (once per application)."""
    ship_package(spark)


def file_system(uri: str):
    """(pyarrow file system, path) of a folder URI or plain path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def put_file(uri: str, chunks: Iterable[bytes]) -> int:
    """Write a file under a private name, then rename: a retried or doubled
    task replaces the whole file and never leaves half of one.  Returns the
    bytes written.  The folder must exist (``make_folder``)."""
    fsys, path = file_system(uri)
    part = f"{path}.{uuid.uuid4().hex}.part"
    n = 0
    with fsys.open_output_stream(part, compression=None) as out:
        for c in chunks:
            out.write(c)
            n += len(c)
    fsys.move(part, path)
    return n


def make_folder(uri: str) -> None:
    fsys, path = file_system(uri)
    fsys.create_dir(path, recursive=True)


def rows_of(batches: Iterable[pa.RecordBatch], *columns: str) -> Iterator[Iterator[tuple]]:
    """The rows as tuples of Python values, in runs of bounded length."""
    for b in slices(batches):
        yield zip(*(b.column(b.schema.get_field_index(c)).to_pylist() for c in columns))


def slices(batches: Iterable[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Cut batches, so that only so many rows are Python values at a time."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


class Out:
    """Collects output columns and cuts them into Arrow batches of bounded size."""

    def __init__(self, schema: pa.Schema, rows: int = 20_000, size: int = 8_000_000):
        self.schema, self.rows, self.size = schema, rows, size
        self.columns: list[list] = [[] for _ in schema]
        self.held = 0

    def add(self, *values, size: int = 0) -> None:
        for c, v in zip(self.columns, values):
            c.append(v)
        self.held += size

    def full(self) -> bool:
        return len(self.columns[0]) >= self.rows or self.held >= self.size

    def take(self) -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(self.columns, self.schema)], schema=self.schema)
        self.columns, self.held = [[] for _ in self.schema], 0
        return batch
