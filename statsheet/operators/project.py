"""Alias projection and type coercion (P1..P8).

``project`` turns a source table (source headers) into a keyed table: one
column per curated key, in spec order, with types coerced, plus the row-order
columns ``_o0.._oN`` taken from the spec's ``order_by``.  Only requested
measures are projected, so unused measure columns never leave the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, StringType, TimestampNTZType, TimestampType

from ..functions.coerce import clean_string, integral_check, to_double
from ..functions.periods import period_iso_col
from ..spec import Spec

ORD_PREFIX = "_o"
MEASURE_INDEX = "_midx"


def ord_columns(spec: Spec) -> list[str]:
    return [f"{ORD_PREFIX}{i}" for i in range(len(spec.order_by))]


def check_drift(df: DataFrame, spec: Spec) -> None:
    """Every curated source column must be present (metadata only)."""
    present = set(df.columns)
    missing = [c.source for c in spec.columns if c.source not in present]
    if missing:
        more = "..." if len(missing) > 5 else ""
        raise ValueError(
            f"Dataset {spec.id!r} expected columns that are not in the source: {missing[:5]}{more}. "
            f"Saw (first 6): {list(df.columns)[:6]}. The source may have changed shape."
        )
    missing_ord = [c for c in spec.order_by if c not in present]
    if missing_ord:
        raise ValueError(f"Dataset {spec.id!r}: order_by columns missing from source: {missing_ord}")


def _simple_type(dt) -> str:
    if isinstance(dt, DateType):
        return "date"
    if isinstance(dt, TimestampNTZType):
        return "timestamp_ntz"
    if isinstance(dt, TimestampType):
        return "timestamp"
    return dt.simpleString()


def _integral_flags(df: DataFrame, spec: Spec) -> dict[str, bool]:
    """Decide P4 for fractional numeric text columns without a declared flag.

    One aggregate over those columns only (usually none): integer types and
    columns with ``integral`` set in the spec need no job.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    pending = [
        c
        for c in spec.columns
        if c.role != "measure"
        and c.dtype in ("string", "str")
        and c.integral is None
        and isinstance(types.get(c.source), NumericType)
        and types[c.source].typeName() not in ("byte", "short", "integer", "long")
    ]
    if not pending:
        return {}
    row = df.agg(*[integral_check(F.col(c.source)).alias(c.key) for c in pending]).first()
    return {c.key: bool(row[c.key]) for c in pending}


def key_expressions(df: DataFrame, spec: Spec, measures: list[str] | None = None) -> dict[str, Column]:
    """Coerced expression of every kept key over the source columns (P1, P3..P7).

    Filters are written against these expressions on the source table, so
    Catalyst sees the raw columns and can push the predicates into the scan.
    """
    check_drift(df, spec)
    types = {f.name: f.dataType for f in df.schema.fields}
    wanted = set(measures) if measures is not None else {c.key for c in spec.measure_columns()}
    flags = _integral_flags(df, spec)
    out: dict[str, Column] = {}
    for c in spec.columns:
        if c.role == "measure" and c.key not in wanted:
            continue
        src = F.col(c.source)
        st = types[c.source]
        if c.role == "measure" or c.dtype in ("float", "number", "int", "integer"):
            expr = to_double(src, st)
        elif c.dtype in ("date", "period"):
            expr = period_iso_col(src, _simple_type(st))
        elif c.dtype in ("string", "str"):
            integral = c.integral if c.integral is not None else flags.get(c.key)
            if spec.clean_text and isinstance(st, StringType):
                expr = src
            else:
                expr = clean_string(src, st, integral)
        else:
            expr = src.cast("string") if c.role != "measure" else to_double(src, st)
        out[c.key] = expr
    return out


def project(
    df: DataFrame,
    spec: Spec,
    measures: list[str] | None = None,
    exprs: dict[str, Column] | None = None,
    extra: dict[str, Column] | None = None,
) -> DataFrame:
    """P1 + coercion: keyed, typed columns in spec order plus order columns
    (and any hidden ``extra`` columns, whose names start with ``_``)."""
    exprs = exprs if exprs is not None else key_expressions(df, spec, measures)
    cols = [e.alias(k) for k, e in exprs.items()]
    cols += [F.col(o).alias(f"{ORD_PREFIX}{i}") for i, o in enumerate(spec.order_by)]
    cols += [e.alias(k) for k, e in (extra or {}).items()]
    return df.select(*cols)


def period_source_type(df: DataFrame, spec: Spec) -> str | None:
    if not spec.period_column or spec.period_column not in df.columns:
        return None
    return _simple_type(df.schema[spec.period_column].dataType)
