"""Dimension filters and the period range (F1..F5, F7, F9..F11).

Every filter is resolved on the driver to a literal predicate (aliases
translated, bounds expanded) and written against the source columns, so
Catalyst pushes equality, IN and range predicates into the Parquet scan.
Only the case-insensitive substring filter (F4) stays above the scan.
"""

from __future__ import annotations

import datetime as _dt
import re
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..functions.periods import checked_bound, period_iso_col
from ..functions.similarity import best_match
from ..spec import Spec

_CANON_INT = re.compile(r"^(0|-?[1-9][0-9]{0,17})$")
#: Longer lists of values are joined instead of written into the predicate.
LONG_LIST = 20_000
#: How close (one less the share of edits) a value must be to be suggested.
CLOSE = 0.6


def wildcard(v: str) -> str | None:
    """What a contains-match looks for (F4): the text without its marks; None
    for a plain value.  Marks are ``*`` at either end and ``~`` anywhere."""
    marked = "~" in v or "*" in (v[:1], v[-1:])
    return v.translate({ord("*"): None, ord("~"): None}).strip() if marked else None


def check_filter_keys(spec: Spec, filters: dict[str, Any]) -> None:
    """keys must be dimensions or ids; suggest the closest one."""
    valid = sorted(spec.filterable_keys())
    for k in filters:
        if k not in valid:
            near = best_match(k, valid, cutoff=60)
            raise ValueError(f"{k!r} is no filter of {spec.id!r}." + (f" Did you mean {near!r}?" if near else "") + f" Filters: {', '.join(valid)}.")


def _integral_source(df: DataFrame, spec: Spec, key: str) -> str | None:
    c = spec.column(key)
    if c is None or c.source not in df.columns:
        return None
    dt = df.schema[c.source].dataType
    if isinstance(dt, NumericType) and dt.typeName() in ("byte", "short", "integer", "long"):
        return c.source
    return None


def filter_condition(df: DataFrame, spec: Spec, key: str, value: Any, expr: Column) -> Column:
    """Predicate for one filter entry over the source table.

    ``expr`` is the coerced expression of ``key`` (see ``key_expressions``).
    Lists are OR (F2), a scalar is equality after alias translation (F1, F5),
    and a wildcard on a permissive column is a case-insensitive substring
    match (F4).  Integer source columns compare as numbers when the value is
    canonical integer text, which is the same test and reaches the scan.
    """
    col_spec = spec.column(key)
    permissive = bool(col_spec and col_spec.permissive)
    int_src = _integral_source(df, spec, key)
    if isinstance(value, (list, tuple)):
        if not value:
            raise ValueError(f"Filter {key!r} has an empty list; pass at least one value or omit it")
        resolved = [spec.translate(key, str(v).strip()) for v in value]
        if int_src and all(_CANON_INT.match(r) for r in resolved):
            return F.col(int_src).isin([int(r) for r in resolved])
        return expr.cast("string").isin(resolved)
    v = str(value).strip()
    needle = wildcard(v) if permissive else None
    if needle is not None:
        if not needle:
            raise ValueError(f"filter {key!r} has only wildcard marks; write some text with them, such as 'acme*'")
        return F.upper(expr.cast("string")).contains(needle.upper())
    resolved = spec.translate(key, v)
    if int_src and _CANON_INT.match(resolved):
        return F.col(int_src) == int(resolved)
    # Used in Filter only, where null counts as false; a bare comparison on
    # the source column is what Catalyst pushes into the scan.
    return expr.cast("string") == F.lit(resolved)


def apply_filters(df: DataFrame, spec: Spec, filters: dict[str, Any], exprs: dict[str, Column]) -> DataFrame:
    """all filter entries AND-ed, applied to the source table."""
    if not filters:
        return df
    check_filter_keys(spec, filters)
    out = df
    for k, v in filters.items():
        if isinstance(v, (list, tuple)) and len(v) > LONG_LIST:
            out = _in_list(out, spec, k, v, exprs[k])
        else:
            out = out.filter(filter_condition(df, spec, k, v, exprs[k]))
    return out


def _in_list(df: DataFrame, spec: Spec, key: str, values: list | tuple, expr: Column) -> DataFrame:
    """F2 for long lists: a left-semi join with the table of their different values.

    Spark broadcasts the table while it is small by its own size check; else it joins
    by key, with a Bloom filter of the values at run time where that pays.  Whole
    numbers on an integer column are joined as numbers, so the column is read as stored."""
    resolved = sorted({spec.translate(key, str(v).strip()) for v in values})
    int_src = _integral_source(df, spec, key)
    if int_src and all(_CANON_INT.match(r) for r in resolved):
        wanted, kind, own = [int(r) for r in resolved], "long", F.col(int_src).cast("long")
    else:
        wanted, kind, own = resolved, "string", expr.cast("string")
    name = "wanted"
    while name in df.columns:
        name += "_"
    table = df.sparkSession.createDataFrame([(w,) for w in wanted], f"`{name}` {kind}")
    return df.join(table, own == F.col(f"`{name}`"), "left_semi")


# ---- period range (F7, F8) --------------------------------------------------


def expand_bounds(start: str | None, end: str | None) -> tuple[str | None, str | None]:
    """Expand and check caller bounds; start after end is an error (Q8 fixed)."""
    s = checked_bound(start, "start") if start else None
    e = checked_bound(end, "end") if end else None
    if s and e and s > e:
        raise ValueError(f"start_period {start!r} is after end_period {end!r}")
    return s, e


def _typed_literal(iso: str, kind: str) -> Column:
    if kind == "date":
        return F.expr(f"DATE '{iso}'")
    if kind == "timestamp_ntz":
        return F.expr(f"TIMESTAMP_NTZ '{iso} 00:00:00'")
    return F.expr(f"TIMESTAMP '{iso} 00:00:00'")


def period_condition(df: DataFrame, spec: Spec, start_iso: str | None, end_iso: str | None) -> Column | None:
    """Inclusive ISO range on the raw period column; nulls fail.

    Dates and timestamps compare as typed values (``ts < end + 1 day``) so the
    predicate is a plain range on the stored column and is pushed to Parquet;
    text periods compare as normalised ISO text.
    """
    if not spec.period_column or not (start_iso or end_iso):
        return None
    from .project import period_source_type

    kind = period_source_type(df, spec)
    col = F.col(spec.period_column)
    conds: list[Column] = []
    if kind in ("date", "timestamp", "timestamp_ntz"):
        if start_iso:
            conds.append(col >= _typed_literal(start_iso, kind))
        if end_iso:
            nxt = _dt.date.fromisoformat(end_iso) + _dt.timedelta(days=1) if end_iso < "9999-12-31" else None
            if kind == "date":
                conds.append(col <= _typed_literal(end_iso, kind))
            elif nxt is not None:
                conds.append(col < _typed_literal(nxt.isoformat(), kind))
            else:
                conds.append(col.isNotNull())
    else:
        iso = period_iso_col(col, kind or "string")
        if start_iso:
            conds.append(iso >= F.lit(start_iso))
        if end_iso:
            conds.append(iso <= F.lit(end_iso))
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out


def apply_period_range(df: DataFrame, spec: Spec, start_iso: str | None, end_iso: str | None) -> DataFrame:
    cond = period_condition(df, spec, start_iso, end_iso)
    return df if cond is None else df.filter(cond)


# ---- data-dependent checks (F10, F11), run only when asked -----------------


def _unlisted(spec: Spec, key: str, value: Any) -> list[str]:
    """Plain values of a permissive column with aliases that are neither."""
    known, col = spec.dimension_values.get(key), spec.column(key)
    if col is None or not col.permissive or known is None or not known.values:
        return []
    several = isinstance(value, (list, tuple))
    items = [str(v).strip() for v in (value if several else [value])]
    return [v for v in items if known.canonical(v) is None and (several or wildcard(v) is None)]


def close_values(df: DataFrame, expr: Column, value: str, n: int = 3) -> list[str]:
    """The ``n`` distinct values nearest to ``value`` by edits, best first.  They
    are scored where they are; only these ``n`` reach the driver."""
    v = F.trim(expr.cast("string"))
    longer = F.greatest(F.length("v"), F.lit(max(len(value), 1)))
    score = 1 - F.levenshtein(F.lower("v"), F.lit(value.lower())) / longer
    rows = df.select(v.alias("v")).where("v <> ''").distinct().select("v", score.alias("s")).where(F.col("s") >= CLOSE)
    return [r["v"] for r in rows.orderBy(F.desc("s"), "v").limit(n).collect()]


def validate_permissive_values(df: DataFrame, spec: Spec, filters: dict[str, Any], exprs: dict[str, Column], dictionary: DataFrame | None = None) -> None:
    """a plain value on a permissive column with an alias map must be an
    alias, a canonical value, or present in the unfiltered data.

    One job per checked key, which looks for those values only; the source's
    own values are searched for a suggestion when one is missing.  With a
    ``dictionary`` (key, value, n) the data themselves are not read.
    """
    for key, value in filters.items():
        asked = {v: {v, spec.translate(key, v)} for v in _unlisted(spec, key, value)}
        if not asked:
            continue
        wanted = sorted(set().union(*asked.values()))
        held, text = (df, exprs[key].cast("string")) if dictionary is None else (dictionary.where(F.col("key") == key), F.col("value"))
        present = {r["v"] for r in held.select(text.alias("v")).where(F.col("v").isin(wanted)).distinct().collect()}
        for v, forms in asked.items():
            if forms & present:
                continue
            aliases = sorted(spec.dimension_values[key].values)
            near = best_match(v, aliases, cutoff=70)
            hints = ([near] if near else []) + close_values(held, text, v)
            raise ValueError(
                f"{v!r} is no value of {key!r} in {spec.id!r}."
                + (f" Did you mean {' or '.join(map(repr, dict.fromkeys(hints)))}?" if hints else "")
                + f" Aliases: {', '.join(aliases[:10])}; a name as the source writes it, or one with '*' at its end, works too."
            )


def empty_result_hint(df: DataFrame, spec: Spec, key: str, value: str, expr: Column) -> str | None:
    """why an equality filter matched nothing.

    A year is answered with the years that the column covers (one min/max
    aggregate), never with another year as a suggestion.  Any other value is
    answered with up to three close values.
    """
    s = F.trim(expr.cast("string"))
    if value.isascii() and value.isdigit() and len(value) == 4:
        years = df.where(s.rlike(r"^[0-9]{4}$")).agg(F.min(s).alias("first"), F.max(s).alias("last")).first()
        if years["first"] is not None:
            place = "before the first" if value < years["first"] else "after the last" if value > years["last"] else "inside, but without rows"
            return f"No rows for {key}={value}: {key} runs from {years['first']} to {years['last']}, and {value} is {place}."
    near = close_values(df, expr, value)
    return f"No rows for {key}={value!r}. Close values: {', '.join(map(repr, near))}." if near else None


def missing_value_hint(dictionary: DataFrame, spec: Spec, filters: dict[str, Any]) -> str | None:
    """F11 from a dictionary alone: the hint for the first equality filter on a free-form
    dimension whose value the data do not hold."""
    for key, value in filters.items():
        col = spec.column(key)
        known = {c.key for c in spec.dimension_columns()} - {spec.period_key}
        if col is None or key not in known or col.permissive or spec.dimension_values.get(key) or isinstance(value, (list, tuple)):
            continue
        v, held = str(value).strip(), dictionary.where(F.col("key") == key)
        if held.where(F.col("value") == v).isEmpty():
            hint = empty_result_hint(held, spec, key, v, F.col("value"))
            if hint:
                return hint
    return None
