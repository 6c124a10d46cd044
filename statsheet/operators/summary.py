"""Summary row and series (A1..A4, A7, K2, K4).

The summary is one aggregate over the slice before the limit: count, unit
consensus, first and last period.  Spark runs it as partial + final hash
aggregation, so its cost is one pass with a one-row shuffle.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir, ship_package
from ..spec import Spec
from .observe import OBS_HEAD, observations, row_order


#: Observations of a stored row group, about: what a task that reads chunks holds at once.
ROWS_READ = 64_000


def _ord_struct(obs: DataFrame, spec: Spec) -> Column:
    return F.struct(*row_order(obs, spec))


def summary_aggs(limit: int | None = None, units: list[str | None] | None = None, period_is_date: bool = False) -> list[Column]:
    """Aggregates of the summary row over an observation slice.

    All buffers are fixed-width so the plan stays a hash aggregate (no sort
    of the input): units are spec constants per measure position, so the
    set of positions present (at most the measure count) gives the unit
    consensus; ISO periods of date sources aggregate as dates.
    """
    n = F.count(F.lit(1))
    row_count = F.least(n, F.lit(limit)) if limit else n
    truncated = F.when(n > F.lit(limit), n) if limit else F.lit(None).cast("long")
    if units is not None:
        table = F.array(*[F.lit(u).cast("string") for u in units])
        present = F.array_distinct(
            F.filter(F.transform(F.collect_set("_midx"), lambda i: F.element_at(table, i + 1)), lambda u: u.isNotNull() & (u != ""))
        )
        unit = F.when(F.size(present) == 1, F.element_at(present, 1))
    else:
        unit_ok = F.col("unit").isNotNull() & (F.col("unit") != "")
        unit = F.when(F.count_distinct(F.when(unit_ok, F.col("unit"))) == 1, F.max(F.when(unit_ok, F.col("unit"))))
    if period_is_date:
        first = F.date_format(F.min(F.to_date("period")), "yyyy-MM-dd")
        last = F.date_format(F.max(F.to_date("period")), "yyyy-MM-dd")
    else:
        first, last = F.min("period"), F.max("period")
    return [
        row_count.cast("long").alias("row_count"),
        truncated.cast("long").alias("truncated_at"),
        unit.alias("unit"),
        first.alias("first_period"),
        last.alias("last_period"),
    ]


def summary_aggs_wide(keyed: DataFrame, spec: Spec, measures: list[str], limit: int | None, period_is_date: bool) -> list[Column]:
    """The summary aggregates straight from the keyed (wide) table.

    Same values as :func:`summary_aggs` over the observations, without the
    per-measure row expansion: each source row contributes its number of
    valid measure cells, the measures present decide the unit, and periods
    count where at least one cell is valid.  Fixed-width buffers only.
    """
    valid = [F.col(m).isNotNull() & ~F.isnan(F.col(m)) for m in measures]
    cells = sum((v.cast("long") for v in valid[1:]), valid[0].cast("long")) if valid else F.lit(0).cast("long")
    any_valid = valid[0] if valid else F.lit(False)
    for v in valid[1:]:
        any_valid = any_valid | v
    n = F.coalesce(F.sum(cells), F.lit(0)).cast("long")
    unit_of = {c.key: c.unit for c in spec.measure_columns()}
    present_units = F.array_distinct(
        F.filter(
            F.array(*[F.when(F.max(v.cast("int")) == 1, F.lit(unit_of.get(m)).cast("string")) for m, v in zip(measures, valid)]),
            lambda u: u.isNotNull() & (u != ""),
        )
    )
    unit = F.when(F.size(present_units) == 1, F.element_at(present_units, 1))
    pkey = spec.period_key
    if pkey and pkey in keyed.columns:
        p = F.when(any_valid, F.col(pkey))
        if period_is_date:
            first, last = F.date_format(F.min(F.to_date(p)), "yyyy-MM-dd"), F.date_format(F.max(F.to_date(p)), "yyyy-MM-dd")
        else:
            first, last = F.min(p), F.max(p)
    else:
        first = last = F.lit(None).cast("string")
    row_count = F.least(n, F.lit(limit)) if limit else n
    truncated = F.when(n > F.lit(limit), n) if limit else F.lit(None).cast("long")
    return [
        row_count.cast("long").alias("row_count"),
        truncated.cast("long").alias("truncated_at"),
        unit.alias("unit"),
        first.cast("string").alias("first_period"),
        last.cast("string").alias("last_period"),
    ]


def summary_row(
    obs: DataFrame,
    spec: Spec,
    *,
    limit: int | None = None,
    start_period: str | None = None,
    end_period: str | None = None,
    query: str | None = None,
    stale: bool = False,
    stale_reason: str | None = None,
    download_url: str | None = None,
    measures: list[str] | None = None,
    period_is_date: bool = False,
    keyed: DataFrame | None = None,
) -> DataFrame:
    """K4: one row describing the slice (before the limit) and the response.

    ``period_start`` / ``period_end`` echo the caller's bounds when given,
    else the first/last period of the slice (Q20).
    """
    if keyed is not None and measures:
        # No step between the source rows and the observations: aggregate
        # the wide rows directly (no row expansion).
        agg = keyed.agg(*summary_aggs_wide(keyed, spec, measures, limit, period_is_date))
    else:
        units = None
        if measures is not None and "_midx" in obs.columns:
            # _midx is the position in the requested measure list.
            unit_of = {c.key: c.unit for c in spec.measure_columns()}
            units = [unit_of.get(m) for m in measures]
        agg = obs.agg(*summary_aggs(limit, units, period_is_date))
    fw = spec.framework
    framework = (
        F.struct(
            F.lit(fw.basis).cast("string").alias("basis"),
            F.lit(fw.break_date).cast("string").alias("break_date"),
            F.lit(fw.break_reason).cast("string").alias("break_reason"),
            F.lit(fw.historical_dataset).cast("string").alias("historical_dataset"),
        )
        if fw
        else F.lit(None).cast("struct<basis:string,break_date:string,break_reason:string,historical_dataset:string>")
    )
    return agg.select(
        F.lit(spec.id).alias("dataset_id"),
        F.lit(spec.name).alias("dataset_name"),
        F.lit(query).cast("string").alias("query"),
        (F.lit(start_period) if start_period else F.col("first_period")).cast("string").alias("period_start"),
        (F.lit(end_period) if end_period else F.col("last_period")).cast("string").alias("period_end"),
        "unit",
        "row_count",
        "truncated_at",
        framework.alias("framework"),
        F.lit(stale).alias("stale"),
        F.lit(stale_reason).cast("string").alias("stale_reason"),
        F.lit(spec.source_url).cast("string").alias("source_url"),
        F.lit(download_url).cast("string").alias("download_url"),
        F.lit(spec.attribution).cast("string").alias("attribution"),
        F.lit(_dt.datetime.now(_dt.timezone.utc).isoformat()).alias("retrieved_at"),
    )


def series_stats(obs: DataFrame, spec: Spec) -> DataFrame:
    """A7 in flat, scale-safe form: one row per measure.

    ``unit`` is the unit of the measure's first observation in declared
    order; first/last period likewise.  The measures are the spec's, so all are found
    by one aggregate without a grouping key: no row is sorted, spilled or
    shuffled, and a task sends one row.
    """
    o = _ord_struct(obs, spec)

    def of(measure: str) -> Column:
        own = F.col("measure") == measure
        place = F.when(own, o)
        return F.struct(
            F.lit(measure).alias("measure"), F.min_by(F.struct("unit", "period"), place).alias("first"), F.count(F.when(own, 1)).alias("n_obs"), F.max_by("period", place).alias("last_period")
        )

    found = obs.agg(F.array(*[of(c.key) for c in spec.measure_columns()]).alias("found")).select(F.inline("found")).where("n_obs > 0")
    return found.select("measure", F.col("first.unit").alias("unit"), "n_obs", F.col("first.period").alias("first_period"), "last_period")


def series_partitioned(obs: DataFrame, spec: Spec) -> DataFrame:
    """K2 for large results: observations range-partitioned by (measure, order)
    and sorted within partitions, so each series is contiguous and a hot
    measure spreads over many partitions instead of one group."""
    keys = [F.col("measure"), *row_order(obs, spec)]
    return obs.repartitionByRange(*keys).sortWithinPartitions(*keys)


def _cut(rows: int):
    """The observations of a partition, in order, as chunks of each measure."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, schema = TaskContext.get().partitionId(), None
        held: dict[str, tuple] = {}  # of a measure: unit, number of its next chunk, items

        def chunk(measure: str, unit: str | None, own: int, items: pa.Array) -> pa.RecordBatch:
            listed = pa.ListArray.from_arrays(pa.array([0, len(items)], pa.int32()), items)
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([measure], pa.string()), pa.array([unit], pa.string()), pa.array([own], pa.int64()), listed], ["part", "measure", "unit", "own", "observations"])

        for b in batches:
            measures, units, items = (b.column(b.schema.get_field_index(c)) for c in ("measure", "unit", "item"))
            for measure in pc.unique(measures).to_pylist():
                mine = pc.equal(measures, measure)
                new = items.filter(mine)
                unit, own, old = held.get(measure) or (units.filter(mine)[0].as_py(), 0, new[:0])
                new = pa.concat_arrays([old, new])
                while len(new) >= rows:
                    yield chunk(measure, unit, own, pa.concat_arrays([new[:rows]]))
                    new, own = new[rows:], own + 1
                held[measure] = unit, own, pa.concat_arrays([new])
        for measure, (unit, own, items) in held.items():
            if len(items):
                yield chunk(measure, unit, own, items)

    return run


def series_chunked(obs: DataFrame, spec: Spec, rows: int = 10_000, folder: str | None = None, wide: tuple[DataFrame, list[str]] | None = None) -> DataFrame:
    """K2 nested at any length: ``measure, unit, chunk, observations[]``.

    A series is its chunks in order of ``chunk`` (from 0), each of at most ``rows``
    observations (period, value, dimensions), in declared order.  The rows are
    range-partitioned by their order, and chunks are cut inside the sorted partitions, so
    no series meets in one task or row.  The chunks are written once under ``folder``
    (else ``spark.checkpoint.dir``); only the number of chunks of each (partition,
    measure) is summed up globally.

    ``wide`` names the keyed rows and measures that ``obs`` was expanded from: then
    these, fewer and shorter, are shuffled and sorted, and expanded where they lie.
    """
    if rows < 1:
        raise ValueError("rows must be 1 or more")
    spark = obs.sparkSession
    dims = [c for c in obs.columns if c not in OBS_HEAD and not c.startswith("_")]
    # Rows that tie on the order are told apart by their content.
    if wide:
        keyed, measures = wide
        keys = [*row_order(keyed, spec)[:-1], F.xxhash64(*keyed.columns)]  # the last is the measure's place
        placed = observations(keyed.repartitionByRange(*keys).sortWithinPartitions(*keys), spec, measures)
    else:
        keys = [F.col("measure"), *row_order(obs, spec), F.xxhash64(*OBS_HEAD, *dims)]
        placed = obs.repartitionByRange(*keys).sortWithinPartitions(*keys)
    entries = F.filter(
        F.array(*[F.struct(F.lit(d).alias("key"), F.col(d).cast("string").alias("value")) for d in dims]).cast("array<struct<key:string,value:string>>"),
        lambda e: e["value"].isNotNull(),
    )
    item = F.struct("period", "value", F.map_from_entries(entries).alias("dimensions"))
    path = f"{checkpoint_dir(spark, folder).rstrip('/')}/statsheet-series-{uuid.uuid4().hex}"
    ship_package(spark)
    kind = "part int, measure string, unit string, own bigint, observations array<struct<period: string, value: double, dimensions: map<string, string>>>"
    placed.select("measure", "unit", item.alias("item")).mapInArrow(_cut(rows), kind).write.option("parquet.block.row.count.limit", max(1, ROWS_READ // rows)).parquet(path)
    stored = spark.read.schema(kind).parquet(path)
    each = stored.groupBy("measure", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("measure").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row of each partition
    offsets = each.select("measure", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    # As many rows as tasks and measures: the chunks stay where they are.
    return stored.join(F.broadcast(offsets), ["measure", "part"]).select("measure", "unit", (F.col("offset") + F.col("own")).cast("bigint").alias("chunk"), "observations")


def series_nested(obs: DataFrame, spec: Spec) -> DataFrame:
    """K2 nested form ``measure, unit, observations[]`` for a bounded result.

    Only for slices already cut by a limit (the API uses it after ``limit``);
    large slices use :func:`series_chunked` or :func:`series_partitioned`, which
    never gather a whole series into one row.
    """
    o = _ord_struct(obs, spec)
    dims = [c for c in obs.columns if c not in OBS_HEAD and not c.startswith("_")]
    # Dimensions travel as key/value entries (orderable) and become a map
    # after the sort; null dimensions are left out.
    entries = F.filter(
        F.array(*[F.struct(F.lit(d).alias("key"), F.col(d).cast("string").alias("value")) for d in dims]),
        lambda e: e["value"].isNotNull(),
    ) if dims else F.array().cast("array<struct<key:string,value:string>>")
    item = F.struct(o.alias("o"), F.col("period"), F.col("value"), entries.alias("dims"))
    grouped = obs.groupBy("measure").agg(
        F.min_by("unit", o).alias("unit"),
        F.min(o).alias("_first"),
        F.sort_array(F.collect_list(item)).alias("_items"),
    )
    return grouped.select(
        "measure",
        "unit",
        F.transform(
            "_items",
            lambda x: F.struct(x["period"].alias("period"), x["value"].alias("value"), F.map_from_entries(x["dims"]).alias("dimensions")),
        ).alias("observations"),
        "_first",
    ).orderBy("_first").drop("_first")
