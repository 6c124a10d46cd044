"""Sheet reshaping (R1..R6, S2..S5).

Transposed sheets (periods across the header) are melted with one
``Expand``; snapshot sheets take their period from the first header; raw
grids of text cells get their header promoted.  Header handling is metadata:
the header row of a sheet is one row, read once, and becomes column names.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..functions.coerce import disambiguate, normalize_header, normalize_header_col
from ..functions.periods import header_period, is_iso_date, is_period_header
from ..spec import Spec

MELT_POSITION = "_melt_col"


def melt_transposed(
    df: DataFrame, entity_alias: str, keep: list[str] | None = None, start_iso: str | None = None, end_iso: str | None = None
) -> DataFrame:
    """R1..R3: first column = entity; ``Mon YYYY``/date headers melted.

    Other columns are dropped, rows with a null entity are dropped, null
    values are kept.  ``period`` is the ISO month end of the header (C2) and
    ``_melt_col`` the header position, so the declared order of the melted
    table is (header position, row order) like a column-major melt.
    With no period-like header the table is returned unchanged (R3).
    ``keep`` names extra columns to carry (e.g. a row-order column).
    ``start_iso`` / ``end_iso`` select the period columns inside the range
    from the header text alone, so columns outside it are never read.
    """
    cols = df.columns
    if not cols:
        return df
    entity = cols[0]
    period_cols = [c for c in cols[1:] if is_period_header(c)]
    if not period_cols:
        return df
    inside = [c for c in period_cols if (start_iso or "") <= header_period(c) and (not end_iso or header_period(c) <= end_iso)]
    # A range that no header meets gives no rows: one column stands for the schema.
    period_cols = inside or period_cols[:1]
    types = {f.name: f.dataType for f in df.schema.fields}
    numeric = all(isinstance(types[c], NumericType) for c in period_cols)
    vtype = "double" if numeric else "string"
    extra = set(keep or ())
    keep = [c for c in cols[1:] if (c.startswith("_") or c == "row_idx" or c in extra) and c not in period_cols]
    base = df.withColumnRenamed(entity, entity_alias).dropna(subset=[entity_alias])
    # Period headers are dates or "Mon YYYY", so every melted period is an
    # ISO date: emit it typed (DATE), which lets range filters and the
    # newest-day pre-pass of ``latest`` compare dates.
    isos = [header_period(c) for c in period_cols]
    typed = all(is_iso_date(p) for p in isos)
    cells = [
        F.struct(
            (F.lit(_dt.date.fromisoformat(p)) if typed else F.lit(p)).alias("p"),
            qcol(c).cast(vtype).alias("v"),
            F.lit(i).alias("i"),
        ).alias(f"_m{i}")
        for i, (c, p) in enumerate(zip(period_cols, isos))
    ]
    wide = base.select(entity_alias, *keep, *cells)
    long = wide.unpivot([entity_alias, *keep], [f"_m{i}" for i in range(len(period_cols))], "_hdr", "_cell")
    if not inside:
        long = long.where(F.lit(False))
    return long.select(
        entity_alias,
        F.col("_cell.p").alias("period"),
        F.col("_cell.v").alias("value"),
        *keep,
        F.col("_cell.i").alias(MELT_POSITION),
    )


def snapshot_header(df: DataFrame, spec: Spec) -> DataFrame:
    """The first column's header is the period of the whole sheet.

    Column 0 is renamed to the spec's entity column and a literal period
    column is added (unless the sheet already has one).
    """
    if not df.columns:
        return df
    first = df.columns[0]
    period_src = spec.period_column or "period"
    period_val = header_period(first)
    entity_src = next((c.source for c in spec.columns if c.role in ("dimension", "id") and c.source != period_src), None)
    out = df.withColumnRenamed(first, entity_src) if entity_src and entity_src != first else df
    if period_src not in out.columns:
        out = out.withColumn(period_src, F.lit(period_val))
    return out


def qcol(name: str):
    """A column by its exact name (dots and spaces are not paths)."""
    return F.col("`" + name.replace("`", "``") + "`")


def drop_blank_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """Drop rows whose key columns are all null; absent keys are ignored."""
    present = [k for k in keys if k in df.columns]
    if not present:
        return df
    return df.filter(_any_not_null(present))


def _any_not_null(names: list[str]):
    cond = None
    for n in names:
        c = qcol(n).isNotNull()
        cond = c if cond is None else (cond | c)
    return cond


def shape_source(raw: DataFrame, spec: Spec, start_iso: str | None = None, end_iso: str | None = None) -> DataFrame:
    """Layout step between the source read and the projection."""
    out = raw
    if spec.layout == "transposed":
        entity = spec.entity_alias or spec.dimension_columns()[0].source
        out = melt_transposed(out, entity, keep=list(spec.order_by), start_iso=start_iso, end_iso=end_iso)
    elif spec.snapshot:
        out = snapshot_header(out, spec)
    # Q15 fixed: the injected snapshot period is not a key of the blank test.
    injected = {spec.period_column} if spec.snapshot else set()
    keys = [c.source for c in spec.dimension_columns() if c.source not in injected]
    return drop_blank_rows(out, keys)


# ---- raw grids (S2..S5) -------------------------------------------------------


def grid_header(grid: DataFrame, header_row: int) -> list[str]:
    """Names of one sheet's header row: normalised (S4), disambiguated.

    Reads one row.  Raises when the sheet has no such row.
    """
    if header_row < 1:
        raise ValueError(f"header_row must be 1-indexed (>= 1), got {header_row}")
    row = grid.filter(F.col("row_idx") == header_row).select("cells").first()
    if row is None:
        raise ValueError(f"header row {header_row} is not present in the sheet")
    return disambiguate([normalize_header(c) for c in (row[0] or [])])


def promote_header(
    grid: DataFrame,
    header_row: int,
    data_start_row: int | None = None,
    max_rows: int | None = None,
    keep_row_idx: bool = False,
) -> DataFrame:
    """A one-sheet grid ``(row_idx, cells array<string>)`` → table.

    Data rows start at ``data_start_row`` (default header + 1); fully blank
    rows are dropped; ``max_rows`` keeps the first n data rows by row index.
    """
    start = data_start_row if data_start_row is not None else header_row + 1
    if start < header_row + 1:
        raise ValueError(f"data_start_row ({start}) must be > header_row ({header_row})")
    names = grid_header(grid, header_row)
    data = grid.filter(F.col("row_idx") >= start)
    if max_rows is not None:
        data = data.orderBy("row_idx").limit(max_rows)
    cols = [F.get(F.col("cells"), i).alias(n) for i, n in enumerate(names)]
    out = data.select(*cols, "row_idx").filter(_any_not_null(names))
    return out if keep_row_idx else out.drop("row_idx")


def header_names_table(grid: DataFrame, header_row: int) -> DataFrame:
    """S4, S5 for many sheets at once: ``(source, sheet, col_idx, name)``."""
    cells = grid.filter(F.col("row_idx") == header_row).select("source", "sheet", F.posexplode("cells").alias("col_idx", "raw"))
    return header_names(cells, ["source", "sheet"])


def header_names(cells: DataFrame, sheet: list[str]) -> DataFrame:
    """Names of header cells ``(*sheet, col_idx, raw)``, as ``(*sheet, col_idx, name)``.

    Blank headers become ``Unnamed: i``; the k-th repeat of a name within a
    sheet gets ``.k``.  Windows are per (sheet, name), i.e. a handful of rows.
    """
    norm = normalize_header_col(F.col("raw"))
    named = cells.withColumn(
        "base", F.when(F.col("raw").isNull() | (norm == ""), F.concat(F.lit("Unnamed: "), F.col("col_idx").cast("string"))).otherwise(norm)
    )
    w = Window.partitionBy(*sheet, "base").orderBy("col_idx")
    k = F.row_number().over(w) - 1
    return named.select(*sheet, "col_idx", F.when(k == 0, F.col("base")).otherwise(F.concat(F.col("base"), F.lit("."), k.cast("string"))).alias("name"))
