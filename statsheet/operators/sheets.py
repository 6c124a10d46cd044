"""Many sheets in one plan (S2, S4, S5, S11; R1, R4, R7).

A bronze grid holds the cells of any number of workbooks: ``source, sheet, row_idx,
cells``.  A *layout* says which dataset each sheet belongs to and where its header stands:
``dataset_id, source, sheet, header_row, data_start_row``.  From these two tables
one plan promotes all headers at once and reads every dataset's observations, without
a loop over sheets or datasets:

    grid ⋈ layout → header names of each sheet (a table) ⋈ data rows
         ⋈ columns of each dataset → observations

The grid is scanned once for headers (one row of each sheet) and once for rows.
Dataset columns are as small as the number of specs and broadcast.  So are headers
of up to ``FEW_SHEETS`` sheets: dealt out by so few keys, all rows of a sheet or
dataset would be sorted in one task.  Headers of more sheets are joined by sheet.
Sheets may have their columns in any order, since cells are found by name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.coerce import clean_string, to_double
from ..functions.periods import header_period_col, period_iso_col
from ..spec import Spec
from .reshape import header_names

SHEET = ("dataset_id", "source", "sheet")
#: Sheets whose headers one task may hold.
FEW_SHEETS = 1000
_ISO = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_COLUMNS = "array<struct<key: string, source: string, unit: string, place: int>>"


def sheet_headers(grid: DataFrame, layout: DataFrame) -> DataFrame:
    """(dataset_id, source, sheet, names): each sheet's normalised header, in order."""
    at = layout.select(*SHEET, "header_row")
    cells = grid.join(at, ["source", "sheet"]).where(F.col("row_idx") == F.col("header_row")).select(*SHEET, F.posexplode("cells").alias("col_idx", "raw"))
    named = header_names(cells, list(SHEET))
    return named.groupBy(*SHEET).agg(F.transform(F.sort_array(F.collect_list(F.struct("col_idx", "name"))), lambda c: c["name"]).alias("names"))


def sheet_rows(grid: DataFrame, layout: DataFrame) -> DataFrame:
    """(dataset_id, source, sheet, row_idx, names, cells): the data rows under the
    headers, fully blank ones left out."""
    start = F.coalesce(F.col("data_start_row"), F.col("header_row") + 1).alias("data_start")
    heads = sheet_headers(grid, layout).join(layout.select(*SHEET, start), list(SHEET))
    if layout.limit(FEW_SHEETS + 1).count() <= FEW_SHEETS:
        heads = F.broadcast(heads)
    rows = grid.select("source", "sheet", "row_idx", "cells").join(heads, ["source", "sheet"]).where(F.col("row_idx") >= F.col("data_start"))
    own = F.slice("cells", F.lit(1), F.size("names"))
    return rows.where(F.exists(own, lambda c: c.isNotNull())).select(*SHEET, "row_idx", "names", "cells")


def cell(name: Column | str) -> Column:
    """A row's cell under a header; null where the sheet has no such column."""
    return F.get("cells", F.array_position("names", F.lit(name) if isinstance(name, str) else name).cast("int") - 1)


def spec_table(spark: SparkSession, specs: list[Spec]) -> DataFrame:
    """What the plan needs of each dataset, as rows."""

    def columns(cs) -> list[tuple]:
        return [(c.key, c.source, c.unit, i) for i, c in enumerate(cs)]

    rows = []
    for s in specs:
        dims = [c for c in (*s.dimension_columns(), *s.id_columns()) if c.source != s.period_column]
        kind = "transposed" if s.layout == "transposed" else "snapshot" if s.snapshot else "wide"
        # In these layouts the first column is the entity, whatever its header says.
        first = None if kind == "wide" else (s.entity_alias if kind == "transposed" and s.entity_alias else dims[0].source if dims else None)
        rows.append((s.id, kind, s.period_column, first, columns(dims), columns(s.measure_columns())))
    return spark.createDataFrame(rows, f"dataset_id string, kind string, period_source string, first_source string, dims {_COLUMNS}, measures {_COLUMNS}")


def observations_of_sheets(grid: DataFrame, layout: DataFrame, specs: list[Spec]) -> DataFrame:
    """Every dataset's observations: dataset_id, source, sheet, row_idx, place (of the
    measure, or of the melted column), period, measure, value, unit, dimensions (a map).

    Wide sheets take the period from its column; snapshot sheets take it from their first
    header, each its own; transposed sheets have one for each period header.
    Rows without any dimension go, as do cells without a number.
    """
    rows = sheet_rows(grid, layout).join(F.broadcast(spec_table(grid.sparkSession, specs)), "dataset_id")
    entity = F.col("first_source")

    def value_of(source: Column) -> Column:
        return F.when(source == entity, F.get("cells", F.lit(0))).otherwise(F.get("cells", F.array_position("names", source).cast("int") - 1))

    entries = F.transform("dims", lambda d: F.struct(d["key"], clean_string(value_of(d["source"]), StringType()).alias("value")))
    dims = F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))
    any_dim = F.exists("dims", lambda d: value_of(d["source"]).isNotNull())
    own_period = F.when(F.col("kind") == "snapshot", header_period_col(F.get("names", F.lit(0)))).when(F.col("kind") == "wide", period_iso_col(cell(F.col("period_source")), "string"))
    keyed = rows.where(any_dim | (own_period.isNotNull() & (F.col("kind") == "wide"))).withColumns({"dimensions": dims, "own_period": own_period})

    by_measure = F.transform("measures", lambda m: F.struct(m["place"], F.col("own_period").alias("period"), m["key"].alias("measure"), value_of(m["source"]).alias("text"), m["unit"]))
    melted = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size("names") - 1, F.lit(1))),
        lambda i: F.struct(
            (i - 1).alias("place"), header_period_col(F.get("names", i)).alias("period"), F.get("measures", F.lit(0))["key"].alias("measure"),
            F.get("cells", i).alias("text"), F.get("measures", F.lit(0))["unit"].alias("unit"),
        ),
    )
    melted = F.filter(melted, lambda m: m["period"].rlike(_ISO))
    long = keyed.select(*SHEET, "row_idx", "dimensions", F.explode(F.when(F.col("kind") == "transposed", melted).otherwise(by_measure)).alias("m"))
    return long.select(
        *SHEET, "row_idx", F.col("m.place").alias("place"), F.col("m.period").alias("period"), F.col("m.measure").alias("measure"), to_double(F.col("m.text"), StringType()).alias("value"),
        F.col("m.unit").alias("unit"), "dimensions",
    ).where("value is not null")
