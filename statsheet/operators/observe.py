"""Wide rows → observations (R7, R8), and result shapes (K1..K3).

One observation per (row × requested measure) with a non-null, non-NaN
value.  The unpivot is a single ``Expand`` over a struct per measure
(value, unit, position), so it stays in one whole-stage-codegen span and
never materialises a wide intermediate.

Flat form columns: ``period, measure, value, unit, <dimensions>, <ids>``
plus the hidden order columns ``_o*`` and ``_midx`` that define the declared
row order (row order, then measure order).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..spec import Spec
from .project import MEASURE_INDEX, ord_columns

OBS_HEAD = ("period", "measure", "value", "unit")


def order_columns(spec: Spec) -> list[str]:
    return ord_columns(spec) + [MEASURE_INDEX]


def row_order(obs: DataFrame, spec: Spec) -> list[Column]:
    """Ascending key of the declared row order.

    With a default sort (L5) the sheet's rows are ordered by that measure,
    descending with nulls last, before the spec's ``order_by`` columns; the
    key encodes it as (is null, minus value) so that it sorts ascending,
    also inside structs (``max_by`` keys).  Then measure position.
    """
    keys: list[Column] = []
    if spec.default_sort and "_sortv" in obs.columns:
        keys += [F.col("_sortv").isNull().cast("int"), -F.col("_sortv")]
    return keys + [F.col(c) for c in order_columns(spec)]


def order_exprs(obs: DataFrame, spec: Spec, descending: bool = False) -> list[Column]:
    return [k.desc() if descending else k.asc() for k in row_order(obs, spec)]


def observations(keyed: DataFrame, spec: Spec, measures: list[str]) -> DataFrame:
    """Keyed table (see ``project``) → flat observations."""
    pkey = spec.period_key
    dims = [k for k in spec.emitted_dimension_keys() if k in keyed.columns]
    ords = ord_columns(spec) + [c for c in keyed.columns if c.startswith("_") and c not in ord_columns(spec)]
    units = {c.key: c.unit for c in spec.measure_columns()}
    period = F.col(pkey).cast("string") if pkey and pkey in keyed.columns else F.lit(None).cast("string")
    ids = [period.alias("period")] + [F.col(d).cast("string").alias(d) for d in dims] + [F.col(o) for o in ords]
    cells = [
        F.struct(
            F.col(m).cast("double").alias("v"),
            F.lit(i).alias("i"),
        ).alias(m)
        for i, m in enumerate(measures)
    ]
    wide = keyed.select(*ids, *cells)
    id_names = ["period", *dims, *ords]
    long = wide.unpivot(id_names, list(measures), "measure", "_cell")
    return long.select(
        "period",
        "measure",
        F.col("_cell.v").alias("value"),
        # By position: a measure without a unit among others is null here.
        F.get(F.array(*[F.lit(units.get(m)).cast("string") for m in measures]), F.col("_cell.i")).alias("unit"),
        *dims,
        *ords,
        F.col("_cell.i").alias(MEASURE_INDEX),
    ).filter(F.col("value").isNotNull() & ~F.isnan("value"))


def records(obs: DataFrame) -> DataFrame:
    """K1: drop the hidden order columns."""
    return obs.select(*[c for c in obs.columns if not c.startswith("_")])


def with_dimension_map(obs: DataFrame, spec: Spec) -> DataFrame:
    """Uniform schema: ``period, measure, value, unit, dimensions map``.

    Null dimensions are omitted from the map (Q4 fixed).
    """
    dims = [k for k in spec.emitted_dimension_keys() if k in obs.columns]
    m = F.map_from_arrays(F.array(*[F.lit(d) for d in dims]), F.array(*[F.col(d) for d in dims])) if dims else F.create_map()
    m = F.map_filter(m, lambda k, v: v.isNotNull())
    hidden = [c for c in obs.columns if c.startswith("_")]
    return obs.select(*OBS_HEAD, m.alias("dimensions"), *hidden)


def csv_columns(spec: Spec, obs: DataFrame) -> list[str]:
    """K3 column order: period, measure, value, unit, then declared dimensions."""
    dims = [k for k in spec.emitted_dimension_keys() if k in obs.columns]
    return [*OBS_HEAD, *dims]


def write_csv(obs: DataFrame, spec: Spec, path: str, mode: str = "error") -> None:
    """K3 as a distributed sink: one header per part file."""
    records(obs).select(*csv_columns(spec, obs)).write.mode(mode).option("header", True).csv(path)


def csv_lines(obs: DataFrame, spec: Spec) -> DataFrame:
    """K3 as rows: one CSV line per observation in declared order, without the
    header (its names are ``csv_columns``)."""
    cols = csv_columns(spec, obs)
    return obs.orderBy(*order_exprs(obs, spec)).select(F.to_csv(F.struct(*cols), {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "emptyValue": "", "nullValue": ""}).alias("csv"))


def to_csv_text(obs: DataFrame, spec: Spec) -> str:
    """K3 as text, for a result that the caller has limited."""
    import csv
    import io

    cols = csv_columns(spec, obs)
    rows = obs.orderBy(*order_exprs(obs, spec)).select(*cols).collect()
    if not rows:
        return ""
    buf = io.StringIO()
    w = csv.writer(buf, lineterminator="\n")
    w.writerow(cols)
    w.writerows(["" if v is None else v for v in r] for r in rows)
    return buf.getvalue()
