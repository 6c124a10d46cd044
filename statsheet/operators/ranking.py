"""Top-n, latest and limits (L1..L6, A5, A6).

Plans chosen for scale:

* ``top_n`` and ``limit_rows`` are ``orderBy(...).limit(n)``, planned as
  ``TakeOrderedAndProject``: each task keeps its own top n and only n rows
  per task reach the final merge.  No global sort, no shuffle of the data.
* ``latest_tail`` (tail n per measure) is a partial ``max_by`` aggregate for
  n = 1, else a ``row_number`` window filtered to ``<= n``, where Spark
  inserts a partial ``WindowGroupLimit`` before the shuffle.  Either way each
  task ships at most n rows per measure: a measure holding a third of all
  rows costs n rows of shuffle, not a third of the data.
* ``latest_periods`` keeps the rows from the n-th newest period on; that
  period is a scalar subquery of the same plan (partial aggregation, then a
  top-n of a handful of rows), so nothing is collected and nothing is joined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..spec import Spec
from .observe import order_exprs, row_order


def top_n(obs: DataFrame, spec: Spec, n: int = 10, direction: str = "desc") -> DataFrame:
    """L1: n observations by value; ties keep declared order in both directions."""
    if n < 1:
        raise ValueError("n must be >= 1")
    if direction not in ("desc", "asc"):
        raise ValueError("direction must be 'desc' or 'asc'")
    v = F.col("value").desc() if direction == "desc" else F.col("value").asc()
    return obs.filter(F.col("value").isNotNull()).orderBy(v, *order_exprs(obs, spec)).limit(n)


def _tail_key(obs: DataFrame, spec: Spec):
    # Struct ordering puts a null field first, so the max of (period, order)
    # is the newest period (nulls oldest), then the last row in order.
    return F.struct(F.col("period"), *row_order(obs, spec))


def latest_tail(obs: DataFrame, spec: Spec, n: int = 1) -> DataFrame:
    """L2: per measure, the last n by (period asc with nulls first, row order).

    n = 1 is a ``max_by`` aggregate over structs: Spark sorts each task's rows
    by measure for it, and partial aggregation ships one row per measure and
    task.  n > 1 is a ``row_number`` window
    whose partial ``WindowGroupLimit`` ships at most n rows per measure and
    task to the shuffle.
    """
    if n == 1:
        cols = obs.columns
        best = obs.groupBy("measure").agg(F.max_by(F.struct(*[F.col(c) for c in cols]), _tail_key(obs, spec)).alias("_r"))
        return best.select(*[F.col("_r")[c].alias(c) for c in cols])
    w = Window.partitionBy("measure").orderBy(F.col("period").desc_nulls_last(), *order_exprs(obs, spec, descending=True))
    return obs.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def newest_periods(obs: DataFrame, n: int = 1) -> DataFrame:
    """The newest n distinct non-null periods (at most n rows)."""
    return obs.select("period").filter(F.col("period").isNotNull()).distinct().orderBy(F.col("period").desc()).limit(n)


def latest_periods(obs: DataFrame, n: int = 1) -> DataFrame:
    """L3: every observation in the newest n periods.

    When no observation has a period at all, every observation is kept
    (there is nothing to be newest by).
    """
    oldest = newest_periods(obs, n).agg(F.min("period").alias("p"))
    return obs.filter(oldest.scalar().isNull() | (F.col("period") >= oldest.scalar()))


def distinct_measures(obs: DataFrame, cap: int = 2) -> list[str]:
    """A5: up to ``cap`` distinct measures present (one small job)."""
    return [r[0] for r in obs.select("measure").distinct().limit(cap).collect()]


def choose_latest_mode(obs: DataFrame, spec: Spec, measures: list[str], mode: str = "auto") -> str:
    """Q2: 'period' when exactly one measure remains and a period is declared.

    With one requested measure the answer is known from metadata; with
    several it depends on which measures have values, so a bounded
    ``distinct ... limit 2`` job decides.
    """
    if mode in ("period", "tail"):
        return mode
    if mode != "auto":
        raise ValueError("mode must be 'auto', 'period' or 'tail'")
    if spec.period_column is None:
        return "tail"
    if len(measures) == 1:
        return "period"
    return "period" if len(distinct_measures(obs, 2)) == 1 else "tail"


def latest(obs: DataFrame, spec: Spec, measures: list[str], n: int = 1, mode: str = "auto") -> DataFrame:
    """L4 without the limit: L3 or L2 by :func:`choose_latest_mode`.

    In 'auto' mode with several requested measures one small job tells whether
    more than one of them has values; the answer itself stays a plan.
    """
    if n < 1:
        raise ValueError("last_n must be >= 1")
    chosen = choose_latest_mode(obs, spec, measures, mode)
    return latest_periods(obs, n) if chosen == "period" else latest_tail(obs, spec, n)


def default_sorted(obs: DataFrame, spec: Spec) -> list:
    """Output order.  The sort measure's value per row is carried in the
    hidden ``_sortv`` column (added by ``plans.api.build_observations``);
    rows sort by it descending, nulls last, then by declared order (see
    ``observe.row_order``)."""
    return order_exprs(obs, spec)


def limit_rows(obs: DataFrame, spec: Spec, n: int) -> DataFrame:
    """First n observations in output order (TakeOrderedAndProject)."""
    if n < 1:
        raise ValueError("limit must be >= 1")
    return obs.orderBy(*default_sorted(obs, spec)).limit(n)
