"""Lookups and pairings (J1, F5 column form, J5, J6).

* ``translate_column``: alias → canonical for a whole column, by a
  left join on the spec's alias table (AQE broadcasts it when it is small).
* ``pair_entities``: two tables joined on an identifier after identifier
  normalisation (P4).  Integer keys on both sides join as numbers; text
  keys are stripped.  The plan is left to AQE: broadcast when a side is
  small at run time, else sort-merge with skew-split of hot keys.
* ``pair_bases``: current and historical series side by side in one table
  with a ``basis`` column; values are never merged across bases.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..spec import Spec


def alias_table(spark, spec: Spec, dim: str) -> DataFrame:
    """``(alias, canonical)`` rows of one dimension, canonicals included as
    their own aliases so that a canonical value maps to itself."""
    dv = spec.dimension_values.get(dim)
    pairs: dict[str, str] = {}
    if dv is not None:
        for canon in dv.values.values():
            pairs.setdefault(canon, canon)
        pairs.update(dv.values)
    return spark.createDataFrame(sorted(pairs.items()), "alias string, canonical string")


def translate_column(df: DataFrame, spec: Spec, dim: str, column: str, out: str, strict: bool | None = None) -> DataFrame:
    """``out`` = canonical value of ``column`` (stripped).

    Unknown values pass through on permissive dimensions; on strict ones
    they become null unless ``strict=False``.  The join preserves every input row (left join on a unique
    alias key).
    """
    dv = spec.dimension_values.get(dim)
    is_strict = (dv is not None and bool(dv.values) and not dv.permissive) if strict is None else strict
    table = alias_table(df.sparkSession, spec, dim).withColumnRenamed("alias", "_al_key").withColumnRenamed("canonical", "_al_val")
    key = F.regexp_replace(F.col(column).cast("string"), r"(?U)^\s+|\s+$", "")
    joined = df.withColumn("_al_in", key).join(table, F.col("_al_in") == F.col("_al_key"), "left")
    resolved: Column = F.col("_al_val") if is_strict else F.coalesce(F.col("_al_val"), F.col("_al_in"))
    return joined.withColumn(out, resolved).drop("_al_in", "_al_key", "_al_val")


def _is_integral(df: DataFrame, c: str) -> bool:
    t = df.schema[c].dataType
    return isinstance(t, NumericType) and t.typeName() in ("byte", "short", "integer", "long")


def identifier_key(df: DataFrame, c: str) -> Column:
    """P4 for join keys: integers as digits; whole doubles without ``.0``;
    text stripped."""
    t = df.schema[c].dataType
    col = F.col(c)
    if _is_integral(df, c):
        return col.cast("string")
    if isinstance(t, NumericType):
        return F.when(col % 1 == 0, F.coalesce(col.try_cast("long").cast("string"), col.cast("string"))).otherwise(col.cast("string"))
    return F.regexp_replace(col.cast("string"), r"(?U)^\s+|\s+$", "")


def pair_entities(left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str = "inner") -> DataFrame:
    """Join two tables on a shared identifier (e.g. an ABN)."""
    if _is_integral(left, left_key) and _is_integral(right, right_key):
        cond = left[left_key] == right[right_key]
        return left.join(right, cond, how)
    lk = left.withColumn("_pair_key", identifier_key(left, left_key))
    rk = right.withColumn("_pair_key_r", identifier_key(right, right_key))
    return lk.join(rk, lk["_pair_key"] == rk["_pair_key_r"], how).drop("_pair_key", "_pair_key_r")


def pair_bases(current: DataFrame, historical: DataFrame, current_basis: str, historical_basis: str) -> DataFrame:
    """One table, a ``basis`` column per side; no values merged."""
    return current.withColumn("basis", F.lit(current_basis)).unionByName(
        historical.withColumn("basis", F.lit(historical_basis)), allowMissingColumns=True
    )
