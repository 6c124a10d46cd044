"""Public calls: ``get_data``, ``latest``, ``top_n``, ``describe_dataset``,
``list_curated`` (K5..K7, L4, L7).

Each call validates its arguments on the driver (metadata only), then builds
one lazy plan from the source table:

    scan → period range + dimension filters (pushed into the scan)
         → projection/coercion of the requested keys only
         → Expand (observations) → latest / top-n / limit

and returns a :class:`Result` holding the observations DataFrame and a
one-row summary DataFrame.  Nothing is collected unless a data-dependent
decision needs a bounded answer (``operators.newest`` for ``latest``, the
integral-id check in ``operators.project``).
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.coerce import to_double
from ..functions.periods import validate_period_arg
from ..operators.newest import narrow, newest_bounds
from ..operators.filters import apply_filters, apply_period_range, check_filter_keys, expand_bounds, missing_value_hint, validate_permissive_values
from ..operators.observe import csv_lines, observations, records, to_csv_text, with_dimension_map
from ..operators.project import key_expressions, period_source_type, project
from ..operators.ranking import latest as latest_op
from ..operators.ranking import limit_rows, top_n as top_n_op
from ..operators.reshape import shape_source
from ..operators.summary import series_chunked, series_nested, series_partitioned, series_stats, summary_row
from ..sources.tables import read_source
from ..spec import Spec, get_spec, list_ids, load_all, parse_filters

FORMATS = ("records", "series", "csv")


@dataclass
class Result:
    spec: Spec
    observations: DataFrame  # flat, with hidden order columns
    summary: DataFrame  # one row
    fmt: str = "records"
    limit: int | None = None
    #: The keyed rows and measures that the observations are, all of them, expanded from.
    wide: tuple[DataFrame, list[str]] | None = None

    @property
    def records(self) -> DataFrame:
        return records(self.observations)

    def with_map(self) -> DataFrame:
        return records(with_dimension_map(self.observations, self.spec))

    def series(self) -> DataFrame:
        """K2, flat: observations range-partitioned by (measure, order), so that
        no series is ever gathered into a single row or task."""
        return records(series_partitioned(self.observations, self.spec))

    def chunked_series(self, rows: int = 10_000, folder: str | None = None) -> DataFrame:
        """K2, nested, of any length: rows of at most ``rows`` observations, numbered in each measure."""
        return series_chunked(self.observations, self.spec, rows, folder, self.wide)

    def nested_series(self) -> DataFrame:
        """K2, nested: one row per measure with all its observations.  For a
        result that the caller has limited, since a series becomes one row."""
        if self.limit is None:
            raise ValueError("nested series gather each measure in one row; pass a limit, or use chunked_series() or series()")
        return series_nested(self.observations, self.spec)

    def series_stats(self) -> DataFrame:
        return series_stats(self.observations, self.spec)

    def csv_text(self) -> str:
        """K3 as one text with its header, for a limited result."""
        if self.limit is None:
            raise ValueError("csv_text() gathers the result; pass a limit, or use operators.observe.write_csv")
        return to_csv_text(self.observations, self.spec)

    def output(self) -> DataFrame:
        """The result in the format asked for."""
        if self.fmt == "series":
            return self.series()
        return csv_lines(self.observations, self.spec) if self.fmt == "csv" else self.records


def _check_format(fmt: str | None) -> str:
    """A known format in any case; None is records."""
    known = "records" if fmt is None else str(fmt).strip().lower()
    if known not in FORMATS:
        from ..functions.similarity import best_match

        near = best_match(known, list(FORMATS), cutoff=60)
        raise ValueError(f"format must be one of {', '.join(FORMATS)}." + (f" Did you mean {near!r}?" if near else ""))
    return known


def _check_positive(name: str, v: int | None) -> int | None:
    if v is None:
        return None
    if isinstance(v, bool) or not isinstance(v, int) or v < 1:
        raise ValueError(f"{name} must be an integer >= 1")
    return v


def build_observations(
    spark: SparkSession,
    spec: Spec,
    *,
    root: str | None,
    filters: dict[str, Any],
    measure_keys: list[str],
    start_iso: str | None,
    end_iso: str | None,
    validate: bool = False,
    dictionary: DataFrame | None = None,
    source: DataFrame | None = None,
    last_n: int | None = None,
    mode: str = "auto",
) -> tuple[DataFrame, str, bool, DataFrame]:
    """The lazy observation plan of one query (3.1 steps 8..12).

    With ``last_n`` the filtered source is first narrowed to the newest
    rows (see ``operators.newest``); the returned mode is the resolved
    'period' / 'tail' branch, or the caller's when it could not be resolved.
    The third value tells whether periods come from a date/timestamp column
    (from the schema already read, so the source is listed once); the last
    is the keyed wide table the observations are expanded from.
    """
    raw = source if source is not None else read_source(spark, spec, root, start_iso, end_iso)
    # The newest-day pre-pass pays off only when the period is a stored
    # column (its bound can skip row groups); a period made by the layout
    # step (melt, snapshot header) would only recompute that step.
    stored_period = bool(spec.period_column) and spec.period_column in raw.columns
    raw = shape_source(raw, spec, start_iso, end_iso)
    exprs = key_expressions(raw, spec, measure_keys)
    if validate and filters:
        validate_permissive_values(raw, spec, filters, exprs, dictionary)
    filtered = apply_period_range(raw, spec, start_iso, end_iso)
    filtered = apply_filters(filtered, spec, filters, exprs)
    if last_n and stored_period:
        bounds = newest_bounds(filtered, spec, exprs, measure_keys, last_n, mode)
        if bounds is not None:
            filtered = narrow(filtered, spec, bounds)
            mode = bounds.mode
            if mode == "period" and bounds.lower and bounds.upper:
                # The scan now holds exactly the newest n periods: nothing
                # left for the period step to remove.
                mode = "narrowed"
    extra = {}
    if spec.default_sort:
        # The sort measure rides along as a hidden column, even when it
        # is not one of the requested measures.
        src = spec.column(spec.default_sort).source
        extra["_sortv"] = to_double(F.col(src), raw.schema[src].dataType)
    keyed = project(filtered, spec, exprs=exprs, extra=extra)
    dated = period_source_type(raw, spec) in ("date", "timestamp", "timestamp_ntz")
    return observations(keyed, spec, measure_keys), mode, dated, keyed


def get_data(
    spark: SparkSession,
    dataset_id: str,
    filters: dict[str, Any] | str | None = None,
    measures: str | list[str] | None = None,
    start_period: str | int | None = None,
    end_period: str | int | None = None,
    fmt: str | None = "records",
    *,
    root: str | None = None,
    limit: int | None = None,
    last_n: int | None = None,
    mode: str = "auto",
    validate: bool = False,
    source: DataFrame | None = None,
    hints: bool = False,
    dictionary: DataFrame | None = None,
) -> Result:
    """K6: one dataset, filtered and shaped; see module docs for the plan.

    ``validate=True`` checks plain values on permissive dimensions against
    the aliases and the data (F10); ``hints=True`` runs one ``isEmpty`` job
    and, when the result is empty, raises with a hint for the equality
    filter that emptied it (F11).  With ``dictionary`` (key, value, n; see
    ``operators.dictionary``) both read that table before any data.
    """
    spec = get_spec(dataset_id)
    fmt = _check_format(fmt)
    limit = _check_positive("limit", limit)
    last_n = _check_positive("last_n", last_n)
    if mode not in ("auto", "period", "tail"):
        raise ValueError("mode must be 'auto', 'period' or 'tail'")
    start = validate_period_arg(start_period, "start_period")
    end = validate_period_arg(end_period, "end_period")
    flt = parse_filters(filters)
    check_filter_keys(spec, flt)
    measure_keys = spec.resolve_measures(measures)
    start_iso, end_iso = expand_bounds(start, end)
    if (start or end) and not spec.period_column:
        raise ValueError(f"dataset {spec.id!r} has no period column; omit start_period/end_period")
    obs, mode, dated, keyed = build_observations(
        spark, spec, root=root, filters=flt, measure_keys=measure_keys, start_iso=start_iso, end_iso=end_iso,
        validate=validate, source=source, last_n=last_n, mode=mode, dictionary=dictionary,
    )
    if hints and flt and dictionary is not None:
        hint = missing_value_hint(dictionary, spec, flt)
        if hint:
            raise ValueError(hint)
    if hints and flt and obs.isEmpty():
        _raise_empty_hint(spark, spec, flt, source, root, start_iso, end_iso)
    if last_n and mode != "narrowed":
        obs = latest_op(obs, spec, measure_keys, last_n, mode)
    query = json.dumps(
        {"dataset_id": spec.id, "filters": flt, "measures": measures, "start_period": start, "end_period": end, "format": fmt},
        default=str,
        sort_keys=True,
    )
    summary = summary_row(
        obs, spec, limit=limit, start_period=start, end_period=end, query=query,
        measures=measure_keys, period_is_date=dated, keyed=None if last_n else keyed,
    )
    if limit:
        obs = limit_rows(obs, spec, limit)
    wide = None if limit or last_n else (keyed, measure_keys)
    return Result(spec=spec, observations=obs, summary=summary, fmt=fmt, limit=limit, wide=wide)


def _raise_empty_hint(spark, spec, flt, source, root, start_iso, end_iso) -> None:
    """find the first equality filter (free-form, not permissive, no
    alias map) after which nothing is left, and raise with its hint."""
    from ..operators.filters import empty_result_hint, filter_condition

    raw = shape_source(source if source is not None else read_source(spark, spec, root, start_iso, end_iso), spec)
    exprs = key_expressions(raw, spec)
    current = apply_period_range(raw, spec, start_iso, end_iso)
    for k, v in flt.items():
        nxt = current.filter(filter_condition(raw, spec, k, v, exprs[k]))
        col = spec.column(k)
        free_form = col is not None and not col.permissive and not spec.dimension_values.get(k)
        if free_form and not isinstance(v, (list, tuple)) and nxt.isEmpty() and not current.isEmpty():
            hint = empty_result_hint(current, spec, k, str(v).strip(), exprs[k])
            if hint:
                raise ValueError(hint)
        current = nxt


def latest(
    spark: SparkSession,
    dataset_id: str,
    filters: dict[str, Any] | str | None = None,
    measures: str | list[str] | None = None,
    *,
    root: str | None = None,
    limit: int | None = 50,
    last_n: int = 1,
    mode: str = "auto",
    fmt: str | None = "records",
    source: DataFrame | None = None,
    validate: bool = False,
    hints: bool = False,
) -> Result:
    """L4: newest observations, then the default limit of 50.  ``validate`` and
    ``hints`` as in :func:`get_data`."""
    return get_data(
        spark, dataset_id, filters, measures, fmt=fmt, root=root, limit=limit, last_n=last_n, mode=mode, source=source,
        validate=validate, hints=hints,
    )


def top_n(
    spark: SparkSession,
    dataset_id: str,
    measure: str,
    n: int = 10,
    filters: dict[str, Any] | str | None = None,
    direction: str = "desc",
    start_period: str | int | None = None,
    end_period: str | int | None = None,
    *,
    root: str | None = None,
    source: DataFrame | None = None,
    validate: bool = False,
    hints: bool = False,
) -> Result:
    """L1 on one measure.  The summary describes the whole slice (Q17);
    ``validate`` and ``hints`` as in :func:`get_data`."""
    if not isinstance(measure, str) or not measure.strip():
        raise ValueError("measure is required")
    _check_positive("n", n)
    res = get_data(spark, dataset_id, filters, measure, start_period, end_period, root=root, source=source, validate=validate, hints=hints)
    top = top_n_op(res.observations, res.spec, n, direction)
    summary = res.summary.withColumn("row_count", F.least(F.col("row_count"), F.lit(n)).cast("long"))
    return Result(spec=res.spec, observations=top, summary=summary, limit=n)


# ---- metadata calls (driver-side spec tables) -------------------------------


def describe_dataset(spark: SparkSession, dataset_id: str, *, root: str | None = None, source: DataFrame | None = None) -> DataFrame:
    """K5: one row: id, name, description, dimensions[], measures[], framework,
    source and download URL.  With the data at hand (``root`` or ``source``) the
    first and last period too, by one min/max aggregate over the period alone."""
    spec = get_spec(dataset_id)
    coverage = (None, None)
    if spec.period_key and (root is not None or source is not None):
        raw = shape_source(source if source is not None else read_source(spark, spec, root), spec)
        period = key_expressions(raw, spec, [])[spec.period_key].cast("string")
        coverage = tuple(raw.agg(F.min(period), F.max(period)).first())
    col_t = "array<struct<key:string,source_column:string,description:string,unit:string,role:string>>"

    def cols(cs):
        return [(c.key, c.source, c.description, c.unit, c.role) for c in cs]

    fw = spec.framework
    row = (
        spec.id,
        spec.name,
        spec.description,
        spec.update_frequency,
        spec.period_key,
        cols(spec.dimension_columns() + spec.id_columns()),
        cols(spec.measure_columns()),
        (fw.basis, fw.break_date, fw.break_reason, fw.historical_dataset) if fw else None,
        coverage if any(coverage) else None,
        spec.source_url,
        spec.download_url,
    )
    schema = (
        f"id string, name string, description string, update_frequency string, period_key string, "
        f"dimensions {col_t}, measures {col_t}, "
        "framework struct<basis:string,break_date:string,break_reason:string,historical_dataset:string>, "
        "period_coverage struct<first:string,last:string>, source_url string, download_url string"
    )
    return spark.createDataFrame([row], schema)


def catalogue(spark: SparkSession) -> DataFrame:
    """K7: one row per dataset spec."""
    rows = [
        (s.id, s.name, s.description, s.update_frequency, True, list(s.search_keywords))
        for s in load_all().values()
    ]
    return spark.createDataFrame(
        rows, "id string, name string, description string, update_frequency string, is_curated boolean, keywords array<string>"
    )


def list_curated(spark: SparkSession) -> DataFrame:
    """Dataset ids, sorted."""
    return spark.createDataFrame([(i,) for i in list_ids()], "id string").orderBy("id")
