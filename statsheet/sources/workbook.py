"""Workbook ingest (S1, S6): ``.xlsx`` files → raw grid rows.

Files are read with the ``binaryFile`` source (one row per file) and decoded
inside ``mapInPandas``: the task opens the zip container, reads shared
strings and cell styles, and streams each sheet's XML with ``iterparse``,
yielding rows in Arrow batches, so a task holds one file's bytes, its shared
strings and one batch.  Scale comes from many files (one file is one
task's work); a single huge sheet is one task.

Output grid schema::

    source string, sheet string, row_idx long, cells array<string>, error string

Cells are rendered as text at decode: numbers in shortest form (whole
numbers without ``.0``), dates as ISO ``YYYY-MM-DD`` (with a time when not
midnight), booleans as ``TRUE``/``FALSE``.  The usual coercion turns them
back into typed values.  A file that cannot be decoded, or lacks a requested
sheet, yields one row with ``error`` set instead of failing the job; the
strict readers raise on it.
"""

from __future__ import annotations

import datetime as _dt
import io
import re
import zipfile
from collections.abc import Iterator
from decimal import Decimal, InvalidOperation
from functools import cached_property
from typing import BinaryIO
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

GRID_SCHEMA = "source string, sheet string, row_idx long, cells array<string>, error string"
BATCH_ROWS = 5_000

_NS = {
    "m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main",
    "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships",
    "rel": "http://schemas.openxmlformats.org/package/2006/relationships",
}
_M = "{" + _NS["m"] + "}"
# Built-in number formats that are dates or times.
BUILTIN_DATE_FORMATS = frozenset({14, 15, 16, 17, 18, 19, 20, 21, 22, 27, 30, 36, 45, 46, 47, 50, 57})
_EXCEL_EPOCH = _dt.datetime(1899, 12, 30)
_EPOCH_1904 = _dt.datetime(1904, 1, 1)
_CELL_REF = re.compile(r"^([A-Z]+)([0-9]+)$")


class WorkbookError(ValueError):
    """A workbook could not be read."""


def _col_index(letters: str) -> int:
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _is_date_format(code: str) -> bool:
    stripped = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", code)
    return bool(re.search(r"[dmyhs]", stripped, re.IGNORECASE)) and "General" not in code


def _text(el) -> str:
    return "".join(t.text or "" for t in el.iter(_M + "t"))


def _whole(text: str) -> str | None:
    """The digits of a whole number as they are stored (an id may be longer
    than a double is exact); None for anything else."""
    try:
        d = Decimal(text)
    except InvalidOperation:
        return None
    return format(d.to_integral_value(), "f") if d.is_finite() and d == d.to_integral_value() and d.adjusted() < 400 else None


def _render_number(v: str, is_date: bool, epoch: _dt.datetime = _EXCEL_EPOCH) -> str:
    try:
        f = float(v)
    except ValueError:
        return v
    if is_date:
        try:
            ts = (epoch + _dt.timedelta(days=f, microseconds=500_000)).replace(microsecond=0)
        except (OverflowError, ValueError):  # no day that a date can hold: the number stays
            return _whole(v) or repr(f)
        return ts.strftime("%Y-%m-%d") if ts.time() == _dt.time(0) else ts.strftime("%Y-%m-%d %H:%M:%S")
    return _whole(v) or repr(f)


class _Book:
    def __init__(self, body: bytes | BinaryIO):
        """A workbook's bytes, or an open file, of which only the parts asked for are read."""
        if not body:
            raise WorkbookError("empty workbook body")
        try:
            self.zf = zipfile.ZipFile(io.BytesIO(body) if isinstance(body, bytes) else body)
            wb = ET.fromstring(self.zf.read("xl/workbook.xml"))
        except (zipfile.BadZipFile, KeyError, ET.ParseError, OSError) as e:
            raise WorkbookError(f"could not open workbook (corrupt or truncated): {e}") from e
        rels = {}
        try:
            for r in ET.fromstring(self.zf.read("xl/_rels/workbook.xml.rels")).iter("{" + _NS["rel"] + "}Relationship"):
                rels[r.get("Id")] = r.get("Target")
        except KeyError:
            pass
        flag = (p.get("date1904") for p in wb.iter(_M + "workbookPr"))
        self.epoch = _EPOCH_1904 if next(flag, None) in ("1", "true") else _EXCEL_EPOCH
        self.sheets: dict[str, str] = {}
        for s in wb.iter(_M + "sheet"):
            target = rels.get(s.get("{" + _NS["r"] + "}id"), "")
            target = target.lstrip("/")
            if not target.startswith("xl/"):
                target = "xl/" + target
            self.sheets[s.get("name")] = target

    @cached_property
    def shared(self) -> list[str]:
        return self._shared_strings()

    @cached_property
    def date_styles(self) -> set[int]:
        return self._date_styles()

    def _shared_strings(self) -> list[str]:
        try:
            root = ET.fromstring(self.zf.read("xl/sharedStrings.xml"))
        except KeyError:
            return []
        return [_text(si) for si in root.iter(_M + "si")]

    def _date_styles(self) -> set[int]:
        try:
            root = ET.fromstring(self.zf.read("xl/styles.xml"))
        except KeyError:
            return set()
        custom = {}
        fmts = root.find(_M + "numFmts")
        if fmts is not None:
            for f in fmts.iter(_M + "numFmt"):
                custom[int(f.get("numFmtId"))] = f.get("formatCode") or ""
        out = set()
        xfs = root.find(_M + "cellXfs")
        if xfs is not None:
            for i, xf in enumerate(xfs.iter(_M + "xf")):
                fid = int(xf.get("numFmtId") or 0)
                if fid in BUILTIN_DATE_FORMATS or (fid in custom and _is_date_format(custom[fid])):
                    out.add(i)
        return out

    def rows(self, sheet: str) -> Iterator[tuple[int, list[str | None]]]:
        if sheet not in self.sheets:
            raise WorkbookError(f"sheet {sheet!r} not found in workbook")
        last = 0
        with self.zf.open(self.sheets[sheet]) as fh:
            table = None
            for event, el in ET.iterparse(fh, events=("start", "end")):
                if event == "start":
                    table = el if el.tag == _M + "sheetData" else table
                    continue
                if el.tag != _M + "row":
                    continue
                last = r = int(el.get("r") or last + 1)  # rows may leave out their number
                cells: dict[int, str | None] = {}
                for pos, c in enumerate(el.iter(_M + "c")):
                    ref = c.get("r")
                    m = _CELL_REF.match(ref) if ref else None
                    idx = _col_index(m.group(1)) if m else pos
                    t = c.get("t", "n")
                    v = c.find(_M + "v")
                    if t == "s":
                        val = self.shared[int(v.text)] if v is not None and v.text is not None else None
                    elif t == "inlineStr":
                        is_ = c.find(_M + "is")
                        val = _text(is_) if is_ is not None else None
                    elif t == "b":
                        val = None if v is None else ("TRUE" if v.text == "1" else "FALSE")
                    elif t in ("str", "e", "d"):
                        val = v.text if v is not None else None
                    else:
                        style = int(c.get("s") or 0)
                        val = None if v is None or v.text is None else _render_number(v.text, style in self.date_styles, self.epoch)
                    if val == "":
                        val = None
                    cells[idx] = val
                el.clear()
                if table is not None:
                    table.remove(el)  # an emptied row would stay a child of the sheet
                width = max(cells) + 1 if cells else 0
                yield r, [cells.get(i) for i in range(width)]


def within_periods(rows: Iterator[tuple[int, list]], skip: dict | None) -> Iterator[tuple[int, list]]:
    """A sheet's rows without the data rows outside a period range.

    ``skip`` holds header_row, data_start_row, column, start and end (ISO).
    The header row says where the period stands; without such a column every
    row passes.  A data row without a period does not."""
    from ..functions.coerce import normalize_header

    low, high = ((skip or {}).get(k) or "" for k in ("start", "end"))
    if not (low or high):
        yield from rows
        return
    name, head = skip["column"].strip().lower(), skip["header_row"]
    data = skip.get("data_start_row") or head + 1
    place: int | None = None
    for number, cells in rows:
        if number == head:
            titles = [str(normalize_header(c)).lower() for c in cells]
            place = titles.index(name) if name in titles else None
        elif place is not None and number >= data:
            period = (cells[place] or "").strip() if place < len(cells) else ""
            day = period[:10] if period[4:8:3] == "--" else period
            if not day or day < low or (high and day > high):
                continue
        yield number, cells


def _problem(e: Exception) -> str:
    return (str(e) if isinstance(e, WorkbookError) else f"could not decode: {type(e).__name__}: {e}")[:500]


def decode_workbooks(
    batches: Iterator[pd.DataFrame], sheets: list[str] | None = None, skip: dict | None = None
) -> Iterator[pd.DataFrame]:
    """``mapInPandas`` body: binaryFile rows → grid rows (or error rows)."""

    def flush(buf):
        return pd.DataFrame(buf, columns=["source", "sheet", "row_idx", "cells", "error"])

    for pdf in batches:
        for path, body in zip(pdf["path"], pdf["content"]):
            buf: list[tuple] = []
            try:
                book = _Book(bytes(body) if body is not None else b"")
            except Exception as e:  # whatever one file holds, the others go on
                yield flush([(path, None, None, None, _problem(e))])
                continue
            for sheet in sheets if sheets is not None else list(book.sheets):
                try:
                    for r, cells in within_periods(book.rows(sheet), skip):
                        buf.append((path, sheet, r, cells, None))
                        if len(buf) >= BATCH_ROWS:
                            yield flush(buf)
                            buf = []
                except Exception as e:
                    buf.append((path, sheet, None, None, _problem(e)))
            if buf:
                yield flush(buf)


def empty_files(spark: SparkSession, paths: str | list[str]) -> list[str]:
    """Zero-length files under ``paths`` (file listing only, no data read).

    Spark's file scan makes no split for an empty file, so such files never
    reach a task; they are reported from the listing instead.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    out: list[str] = []
    for p in [paths] if isinstance(paths, str) else paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        statuses = fs.globStatus(path) or []
        stack = list(statuses)
        while stack:
            st = stack.pop()
            if st.isDirectory():
                stack.extend(fs.listStatus(st.getPath()))
            elif st.getLen() == 0 and not st.getPath().getName().startswith((".", "_")):
                out.append(st.getPath().toString())
    return sorted(out)


def read_workbooks(
    spark: SparkSession, paths: str | list[str], sheets: list[str] | None = None, skip: dict | None = None
) -> DataFrame:
    """S1 over many files: the grid of every (file, sheet), error rows included.

    ``skip`` optionally drops data rows outside a period range while decoding
    (see :func:`within_periods`); the caller still applies the exact filter.
    """
    from ..session import ship_package

    ship_package(spark)
    files = spark.read.format("binaryFile").load(paths)
    grid = files.select("path", "content").mapInPandas(lambda it: decode_workbooks(it, sheets, skip), GRID_SCHEMA)
    empties = empty_files(spark, paths)
    if empties:
        rows = [(p, None, None, None, "empty workbook body") for p in empties]
        grid = grid.unionByName(spark.createDataFrame(rows, GRID_SCHEMA))
    return grid


def errors(grid: DataFrame) -> DataFrame:
    """``(source, sheet, error)`` rows of files or sheets that failed."""
    return grid.filter(F.col("error").isNotNull()).select("source", "sheet", "error")


def read_sheet(
    spark: SparkSession, path: str, spec, strict: bool = True, start_iso: str | None = None, end_iso: str | None = None
) -> DataFrame:
    """One sheet of one workbook as a table with its header promoted (S1..S5).

    Meant for one file; batch ingest of many files goes through
    ``plans.ingest``, which writes the decoded grid once to a bronze table.
    The header row is read with one bounded job.  In strict mode a decode
    error raises :class:`WorkbookError`; otherwise a sheet with an error has no
    rows, rather than those before the error.
    """
    from ..operators.reshape import promote_header

    if spec.sheet is None:
        raise WorkbookError(f"dataset {spec.id!r} declares no sheet")
    skip = None
    if (start_iso or end_iso) and spec.period_column and spec.layout == "wide" and not spec.snapshot:
        skip = {"header_row": spec.header_row, "data_start_row": spec.data_start_row, "column": spec.period_column,
                "start": start_iso, "end": end_iso}
    grid = read_workbooks(spark, path, [spec.sheet], skip)
    if strict:
        bad = errors(grid).limit(1).collect()
        if bad:
            raise WorkbookError(bad[0]["error"])
    else:
        grid = grid.join(errors(grid).select("source", "sheet").distinct(), ["source"], "left_anti")
    # row_idx is kept: it is the sheet's row order (usable as the spec's order_by).
    return promote_header(
        grid.filter(F.col("error").isNull()).select("row_idx", "cells"), spec.header_row, spec.data_start_row, keep_row_idx=True
    )
