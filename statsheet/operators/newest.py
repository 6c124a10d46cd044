"""Narrowing ``latest`` to the newest rows before the observation plan.

``latest`` needs, per measure, only the rows of its newest period(s).  When
the period column is a date or timestamp (so the ISO period text orders like
the stored value), one aggregate over the filtered source table — a value
count and the newest day per requested measure, all primitive buffers, so a
plain ``HashAggregate`` with no Expand and a one-row result — gives:

* how many measures have values, which decides the 'period' / 'tail'
  branch (Q2) without another pass;
* a lower bound on the stored period column.  Rows older than the bound
  cannot be in the answer, and the bound is a plain range predicate on the
  raw column, so Parquet row groups wholly older than it are skipped.

The result is exact: the narrowed table keeps every row the full plan would
return; the usual operators then run on it.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..spec import Spec
from .filters import _typed_literal
from .project import period_source_type

_DATE_KINDS = ("date", "timestamp", "timestamp_ntz")


@dataclass
class Newest:
    mode: str  # 'period' or 'tail'
    present: list[str]  # measures with at least one value
    lower: str | None  # ISO day: rows before it are not needed
    upper: str | None  # ISO day: rows after it are not needed (period mode)


def _valid(e: Column) -> Column:
    return e.isNotNull() & ~F.isnan(e)


def newest_bounds(raw: DataFrame, spec: Spec, exprs: dict[str, Column], measures: list[str], n: int, mode: str) -> Newest | None:
    """One aggregate job (plus, for n > 1 in period mode, one distinct-days
    job bounded by n rows).  None when the period column is not a date."""
    kind = period_source_type(raw, spec)
    if kind not in _DATE_KINDS:
        return None
    day = F.to_date(F.col(spec.period_column))
    if n == 1:
        fast = _newest_day_fast(raw, spec, exprs, measures, mode, day)
        if fast is not None:
            return fast
    aggs = []
    for i, m in enumerate(measures):
        v = _valid(exprs[m].cast("double"))
        aggs.append(F.count(F.when(v, F.lit(1))).alias(f"c{i}"))
        aggs.append(F.max(F.when(v, day)).alias(f"d{i}"))
    row = raw.agg(*aggs).first()
    present = [m for i, m in enumerate(measures) if row[f"c{i}"] > 0]
    newest = {m: row[f"d{i}"] for i, m in enumerate(measures)}
    if mode == "auto":
        mode = "period" if len(present) == 1 else "tail"
    if not present:
        return Newest(mode, present, None, None)
    days = [newest[m] for m in present]
    if mode == "period":
        known = [d for d in days if d is not None]
        if not known:
            return Newest(mode, present, None, None)  # no period at all: keep everything (Q3)
        top = max(known)
        if n == 1:
            return Newest(mode, present, top.isoformat(), top.isoformat())
        any_valid = None
        for m in present:
            v = _valid(exprs[m].cast("double"))
            any_valid = v if any_valid is None else (any_valid | v)
        newest_days = raw.filter(any_valid & day.isNotNull()).select(day.alias("d")).distinct().orderBy(F.col("d").desc()).limit(n)
        return Newest(mode, present, newest_days.agg(F.min("d")).first()[0].isoformat(), top.isoformat())
    if any(d is None for d in days):
        return Newest(mode, present, None, None)  # a measure with only null periods: its tail is not bounded by day
    if n == 1:
        return Newest(mode, present, min(days).isoformat(), None)
    return Newest(mode, present, _tail_day_bound(raw, exprs, present, day, n), None)


def _tail_day_bound(raw: DataFrame, exprs: dict[str, Column], present: list[str], day: Column, n: int) -> str | None:
    """Day bound for the tail of n rows per measure (n > 1).

    A measure with values on at least n distinct days has at least n rows on
    its n newest days, so its tail lies on or after the n-th newest of them.
    One aggregate gives a row per day with a value count per measure (partial
    aggregation; the result has one row per distinct day), then the n newest
    days per measure are picked from that small table.  No bound when some
    measure has fewer than n dated days.
    """
    counts = [F.count(F.when(_valid(exprs[m].cast("double")), F.lit(1))).alias(f"c{i}") for i, m in enumerate(present)]
    daily = raw.filter(day.isNotNull()).groupBy(day.alias("d")).agg(*counts)
    per = daily.select(
        "d", F.explode(F.array(*[F.struct(F.lit(i).alias("m"), F.col(f"c{i}").alias("c")) for i in range(len(present))])).alias("x")
    ).filter(F.col("x.c") > 0)
    from pyspark.sql import Window

    ranked = per.withColumn("r", F.row_number().over(Window.partitionBy("x.m").orderBy(F.col("d").desc()))).filter(F.col("r") <= n)
    rows = ranked.groupBy("x.m").agg(F.count(F.lit(1)).alias("k"), F.min("d").alias("lo")).collect()
    if len(rows) < len(present) or any(r["k"] < n for r in rows):
        return None
    return min(r["lo"] for r in rows).isoformat()


def _newest_day_fast(raw: DataFrame, spec: Spec, exprs: dict[str, Column], measures: list[str], mode: str, day: Column) -> Newest | None:
    """Common case of n = 1: the newest day D of the period column alone (a
    one-column aggregate), then the value counts per measure on rows of day
    D only (a range filter pushed to the scan).  When every requested
    measure has a value on D, each measure's newest period is D: the branch
    and the bounds follow without reading the measure columns of older
    rows.  Otherwise None (the general pre-pass decides)."""
    top = raw.agg(F.max(day).alias("d")).first()["d"]
    if top is None:
        return None
    on_top = narrow(raw, spec, Newest("period", [], top.isoformat(), top.isoformat()))
    row = on_top.agg(*[F.count(F.when(_valid(exprs[m].cast("double")), F.lit(1))).alias(f"c{i}") for i, m in enumerate(measures)]).first()
    if not all(row[f"c{i}"] > 0 for i in range(len(measures))):
        return None
    resolved = mode if mode != "auto" else ("period" if len(measures) == 1 else "tail")
    return Newest(resolved, list(measures), top.isoformat(), top.isoformat() if resolved == "period" else None)


def narrow(raw: DataFrame, spec: Spec, bounds: Newest) -> DataFrame:
    """Apply the day bounds on the stored period column (pushed to the scan)."""
    kind = period_source_type(raw, spec)
    col = F.col(spec.period_column)
    out = raw
    if bounds.lower:
        out = out.filter(col >= _typed_literal(bounds.lower, kind))
    if bounds.upper:
        nxt = (_dt.date.fromisoformat(bounds.upper) + _dt.timedelta(days=1)).isoformat()
        out = out.filter(col < _typed_literal(nxt, kind) if kind != "date" else col <= _typed_literal(bounds.upper, kind))
    return out
