"""Mixing sources to target weights by capped water-filling.

``plan`` gives each source a target: the total is shared by weight, a target stops
at ``most`` times its source's size, and what is above is shared anew among the
others, until none is above.  Each round is one aggregate over the table of
sources, which returns one row; nothing grows on the driver.

A target of r times its source's size takes every document floor(r) whole times
and once more as much of the source as the fraction asks for.  Documents stand in a
seeded order (``draw``, from an MD5 of seed and id): those before the source's cut
are taken once more, and the document at the cut gives as many of its words as
are still wanted, so each source meets its target to the word.  The cut is found by
descending a histogram of the order: 4,096 slices of a source, then 4,096 of the
slice that holds the cut, and only within that last slice (1 in 16 million of the
order) are single documents put in order.  So a source with a third of all rows costs
partial sums and no sort.

Defined cases: a null text has size 0 and gives no words.  Null is a source of its
own.  Rows that repeat an id share one place in the order; at a cut they share the
words by size, rounded down (fewer than one word lost for each).  Sources without a
weight, or with one of 0 or less, have target 0.  A total above what all caps allow
gives the caps.  An empty table gives no rows.  Columns beside id, source and text
are not read.  The same seed and rows give the same result on any cluster.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage, shared_folder

SLICE_BITS = 12
_DRAW_BITS = 60
WORDS = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Mix:
    """``sized``: doc_id, source, size, draw of every row.  ``plan``: one row for each source."""

    sized: DataFrame
    plan: DataFrame


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)).cast("bigint"), F.lit(0).cast("bigint"))


def _draw(doc_id: Column, seed: int) -> Column:
    """A 60-bit place in the seeded order."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, 15), 16, 10).cast("bigint")


def _sized(docs: DataFrame, seed: int, id_col: str, source_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        word_count(F.col(text_col).cast("string")).alias("size"),
        _draw(F.col(id_col), seed).alias("draw"),
    )


def repeated_weights(sources: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """(source, weight): the sources by code point, null last, weigh ``weights`` in turn.

    Places are counted in range partitions, so no task holds all sources."""
    order = F.col("source").asc_nulls_last()
    dealt = cut_lineage(sources.select("source").distinct().repartitionByRange(order).withColumn("part", F.spark_partition_id()))
    before, start = 0, F.lit(0)
    for part, n in sorted((r["part"], r["count"]) for r in dealt.groupBy("part").count().collect()):
        start = F.when(F.col("part") == part, before).otherwise(start)
        before = (before + n) % len(weights)
    place = (F.row_number().over(Window.partitionBy("part").orderBy(order)) - 1 + start) % len(weights)
    return dealt.select("source", F.element_at(F.array(*map(F.lit, weights)), place.cast("int") + 1).alias("weight"))


def water_level(sources: DataFrame, most: int, total: int | None = None) -> DataFrame:
    """``sources`` (source, weight decimal, source_size) with ``target``."""
    weight, cap = F.col("weight"), F.col("source_size") * most
    taking = F.coalesce(weight > 0, F.lit(False))
    if total is None:
        total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, clamped = None, F.lit(False)
    while True:
        capped, open_weight = sources.agg(
            F.sum(F.when(taking & clamped, cap)), F.sum(F.when(taking & ~clamped, weight))
        ).first()
        found = (total - int(capped or 0), open_weight)
        if found == level or not open_weight or found[0] <= 0:
            break
        level = found
        share = F.lit(float(level[0])) * weight.cast("double") / F.lit(float(level[1]))
        clamped = share > cap
    if level is None:
        return sources.withColumn("target", F.lit(0.0))
    if not open_weight:  # all stand at their caps
        return sources.withColumn("target", F.when(taking, cap.cast("double")).otherwise(0.0))
    return sources.withColumn("target", F.when(taking, F.least(share, cap.cast("double"))).otherwise(0.0))


def _cut(histogram: DataFrame, place: str) -> DataFrame:
    """Of each source the slice in which ``rest`` words are reached: source, the
    slice, and the ``rest`` still wanted of it.  One row for each slice comes in."""
    upto = F.sum("size").over(Window.partitionBy("source").orderBy(place))
    return histogram.withColumn("upto", upto).where("upto > rest and upto - size <= rest").select("source", place, (F.col("rest") - F.col("upto") + F.col("size")).alias("rest"), F.col("size").alias("held"))


def plan(
    docs: DataFrame, weights: DataFrame | None = None, most: int = 3, seed: int = 0, total: int | None = None, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text"
) -> Mix:
    """``weights``: (source, weight); without it the sources weigh 1, 2, 3 in turn."""
    spark = docs.sparkSession
    folder = shared_folder(spark, "mixing")
    _sized(docs, seed, id_col, source_col, text_col).write.parquet(f"{folder}/sized")
    sized = spark.read.parquet(f"{folder}/sized")

    high = F.shiftright("draw", _DRAW_BITS - SLICE_BITS)
    slices = cut_lineage(sized.groupBy("source", high.alias("slice")).agg(F.sum("size").alias("size")))
    totals = slices.groupBy("source").agg(F.sum("size").alias("source_size"))
    weights = repeated_weights(totals) if weights is None else weights
    w = weights.select(F.col("source").cast("string").alias("of"), F.col("weight").cast("decimal(18,6)").alias("weight"))
    sources = cut_lineage(totals.join(w, F.col("source").eqNullSafe(F.col("of")), "left").drop("of"))

    wanted = F.floor(F.col("target") + 0.5).cast("bigint")
    whole = F.when(F.col("source_size") > 0, F.expr("wanted div source_size")).otherwise(0)
    targets = cut_lineage(
        water_level(sources, most, total).withColumn("wanted", F.least(wanted, F.col("source_size") * most)).withColumn("whole", whole.cast("bigint"))
        .withColumn("rest", F.col("wanted") - F.col("whole") * F.col("source_size"))
    )
    rests = targets.where("rest > 0").select(F.col("source").alias("of"), "rest")
    same = F.col("source").eqNullSafe(F.col("of"))
    first = _cut(slices.join(rests, same).drop("of"), "slice")

    # Within the slice: finer slices, then single places of the order.
    middle = F.shiftright("draw", _DRAW_BITS - 2 * SLICE_BITS)
    inner = sized.withColumn("slice", high).join(first.select(F.col("source").alias("of"), F.col("slice").alias("at"), "rest"), same & (F.col("slice") == F.col("at")))
    inner = cut_lineage(inner.groupBy("source", "rest", middle.alias("slice"), "draw").agg(F.sum("size").alias("size")))
    second = _cut(inner.groupBy("source", "rest", "slice").agg(F.sum("size").alias("size")), "slice")
    last = inner.drop("rest").join(second.select(F.col("source").alias("of"), F.col("slice").alias("at"), "rest"), same & (F.col("slice") == F.col("at")))
    cut = _cut(last.select("source", "rest", "draw", "size"), "draw").select(F.col("source").alias("of"), F.col("draw").alias("cut"), F.col("rest").alias("cut_words"), F.col("held").alias("cut_held"))
    planned = targets.drop("rest", "wanted").join(cut, same, "left").drop("of")
    return Mix(sized, cut_lineage(planned))


def _taking(rows: DataFrame, mix: DataFrame) -> DataFrame:
    """``rows`` (with source, size, draw) with their source's plan and ``extra``: the
    words taken beside the whole repetitions."""
    p = mix.withColumnRenamed("source", "of")
    shared = F.expr("(cast(size as decimal(19,0)) * cast(cut_words as decimal(19,0))) div cast(cut_held as decimal(19,0))")
    extra = F.when(F.col("draw") < F.col("cut"), F.col("size")).when(F.col("draw") == F.col("cut"), shared).otherwise(0)
    return rows.join(p, F.col("source").eqNullSafe(F.col("of"))).drop("of").withColumn("extra", extra.cast("bigint"))


def taken_words(mix: Mix) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, whole
    (repetitions), extra (words of one more, cut short at the source's cut), taken."""
    return _taking(mix.sized, mix.plan).select("doc_id", "source", "size", "source_size", "target", "whole", "extra", (F.col("whole") * F.col("size") + F.col("extra")).alias("taken"))


def draw_texts(docs: DataFrame, mix: Mix, seed: int = 0, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """The mix itself: doc_id, source, repetition (from 0), text.  A text cut short
    is its first words, joined by one space.  ``seed`` is that of the plan."""
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), F.col(text_col).cast("string").alias("text"),
        word_count(F.col(text_col).cast("string")).alias("size"), _draw(F.col(id_col), seed).alias("draw"),
    )
    t = _taking(rows, mix.plan).where("size > 0 and (whole > 0 or extra > 0)")
    copies = t.withColumn("repetition", F.explode(F.expr("sequence(0, cast(whole + if(extra > 0, 1, 0) as int) - 1)")))
    some = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORDS), F.lit(0)), 1, F.col("extra").cast("int")), " ")
    full = (F.col("repetition") < F.col("whole")) | (F.col("extra") == F.col("size"))
    return copies.select("doc_id", "source", "repetition", F.when(full, F.col("text")).otherwise(some).alias("text"))
