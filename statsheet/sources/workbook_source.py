"""Workbooks as a Spark data source: one partition for each (file, sheet).

``read_grid`` gives the grid of ``sources.workbook`` with a ``period`` column.
Partitions are planned from the files' zip directories alone (their end, and the
list of sheets), so two sheets of one file are two tasks, and each task reads of its
file only the parts that its sheet needs.  Rows stream out in Arrow batches.

Filters that Spark pushes down work where they save most: equality on ``sheet`` and
``source`` drops partitions before any task starts, and bounds on ``period`` drop data
rows while a sheet is read.  Spark applies all of them again, so they need only be safe.

A file that cannot be opened, or a sheet that fails half way, is one row with ``error`` (rows
before the failure are kept, as in the batch reader).  Paths are files, or folders searched for
``.xlsx``, on any file system that ``pyarrow.fs`` opens.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from ..session import ship_package
from .workbook import BATCH_ROWS, WorkbookError, _Book, _problem, within_periods

NAME = "statsheet_workbook"
#: ``kind`` is the same in all rows.  Spark keeps what one query pushed into the source for the
#: next query over the same DataFrame, unless that pushes filters itself; so every query does, on ``kind``.
SCHEMA = "source string, sheet string, row_idx long, cells array<string>, error string, period string, kind string"
_KIND = "cells"
_ARROW = pa.schema([("source", pa.string()), ("sheet", pa.string()), ("row_idx", pa.int64()), ("cells", pa.list_(pa.string())), ("error", pa.string()), ("period", pa.string()), ("kind", pa.string())])


def _opened(uri: str):
    """(file system, path) of a URI or plain path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def _files(uri: str) -> list[tuple[str, int]]:
    """(URI as given or found, size) of a file or of the workbooks in a folder."""
    from pyarrow import fs

    system, path = _opened(uri)
    info = system.get_file_info(path)
    if info.type == fs.FileType.File:
        return [(uri, info.size)]
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(uri)
    found = system.get_file_info(fs.FileSelector(path, recursive=True))
    prefix = uri[: len(uri) - len(path)] if uri.endswith(path) else ""
    return sorted((prefix + f.path, f.size) for f in found if f.type == fs.FileType.File and f.path.lower().endswith(".xlsx"))


@dataclass
class SheetPartition(InputPartition):
    source: str
    sheet: str | None
    error: str | None = None


class SheetReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.paths: list[str] = json.loads(options["paths"])
        self.sheets: list[str] | None = json.loads(options.get("sheets", "null"))
        self.column = options.get("period")
        self.header_row = int(options.get("header_row", "1"))
        self.data_start_row = int(options["data_start_row"]) if "data_start_row" in options else None
        self.low = self.high = None
        self.only: dict[str, set[str]] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if name in ("sheet", "source") and isinstance(f, (EqualTo, In)):
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.only[name] = self.only[name] & values if name in self.only else values
            elif name == "period" and self.column:
                if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
                    self.low = max(self.low or "", f.value)
                if isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
                    self.high = min(self.high or f.value, f.value)
            yield f  # Spark applies it too

    def partitions(self) -> list[SheetPartition]:
        out = []
        for uri in self.paths:
            for source, size in _files(uri):
                if source not in self.only.get("source", {source}):
                    continue
                try:
                    if not size:
                        raise WorkbookError("empty workbook body")
                    sheets = self.sheets
                    if sheets is None:
                        system, path = _opened(source)
                        with system.open_input_file(path) as f:
                            sheets = list(_Book(f).sheets)
                except Exception as e:  # whatever one file holds, the others go on
                    out.append(SheetPartition(source, None, _problem(e)))
                    continue
                out += [SheetPartition(source, s) for s in sheets if s in self.only.get("sheet", {s})]
        return out or [SheetPartition("", None)]

    def read(self, partition: SheetPartition) -> Iterator[pa.RecordBatch]:
        if not partition.source:
            return
        if partition.error is not None:
            yield _batch([(partition.source, None, None, None, partition.error, None)])
            return
        rows: list[tuple] = []
        try:
            system, path = _opened(partition.source)
            with system.open_input_file(path) as f:
                for number, cells, period in self._rows(_Book(f), partition.sheet):
                    rows.append((partition.source, partition.sheet, number, cells, None, period))
                    if len(rows) >= BATCH_ROWS:
                        yield _batch(rows)
                        rows = []
        except Exception as e:
            rows.append((partition.source, partition.sheet, None, None, _problem(e), None))
        if rows:
            yield _batch(rows)

    def _rows(self, book: _Book, sheet: str) -> Iterator[tuple[int, list, str | None]]:
        """A sheet's rows with the period of each data row, without those outside the pushed bounds."""
        from ..functions.coerce import normalize_header

        skip = {"header_row": self.header_row, "data_start_row": self.data_start_row, "column": self.column, "start": self.low, "end": self.high} if self.column else None
        start, place = self.data_start_row or self.header_row + 1, None
        for number, cells in within_periods(book.rows(sheet), skip):
            period = None
            if self.column and number == self.header_row:
                titles = [str(normalize_header(c)).lower() for c in cells]
                place = titles.index(self.column.strip().lower()) if self.column.strip().lower() in titles else None
            elif place is not None and number >= start and place < len(cells) and cells[place]:
                text = cells[place].strip()
                period = (text[:10] if text[4:8:3] == "--" else text) or None
            yield number, cells, period


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((*zip(*rows), [_KIND] * len(rows)), _ARROW)], schema=_ARROW)


class WorkbookSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> SheetReader:
        return SheetReader(dict(self.options))


def read_grid(
    spark: SparkSession, paths: str | list[str], sheets: list[str] | None = None, period: str | None = None, header_row: int = 1, data_start_row: int | None = None
) -> DataFrame:
    """The cells of every sheet: source, sheet, row_idx, cells, error, period.

    ``period`` names the column of the sheets' header whose ISO text fills ``period`` in data
    rows; without it, it is null.  With ``sheets`` given, files are not opened for planning.
    Turns on the session's filter pushdown into Python sources."""
    ship_package(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WorkbookSource)
    options = {"paths": json.dumps([paths] if isinstance(paths, str) else paths), "header_row": header_row}
    if sheets is not None:
        options["sheets"] = json.dumps(sheets)
    if period is not None:
        options["period"] = period
    if data_start_row is not None:
        options["data_start_row"] = data_start_row
    return spark.read.format(NAME).options(**options).load().where(F.col("kind") == _KIND).drop("kind")
