"""Dimension values kept beside a dataset.

A dictionary has one row for each dimension value: ``key, value, n`` (rows that hold it).
It is made in one pass (an Expand over the dimensions, partial sums), written by
``ingest`` with each silver table and by ``upsert`` with each touched period of a history,
and read by checks and hints in place of the data: it is as small as the data's
different values, however many rows there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..spec import Spec
from .project import key_expressions


def value_counts(table: DataFrame, values: dict[str, Column], by: tuple[str, ...] = ()) -> DataFrame:
    """(*by, key, value, n) of the given text columns; nulls are no values."""
    listed = F.array(*[F.struct(F.lit(k).alias("key"), c.cast("string").alias("value")) for k, c in values.items()])
    return table.select(*by, F.explode(listed).alias("e")).select(*by, "e.key", "e.value").where("value is not null").groupBy(*by, "key", "value").agg(F.count(F.lit(1)).alias("n"))


def dictionary_of(table: DataFrame, spec: Spec) -> DataFrame:
    """The dictionary of a source table: all dimensions but the period, as filters see them."""
    exprs = key_expressions(table, spec, [])
    return value_counts(table, {c.key: exprs[c.key] for c in spec.dimension_columns() if c.key != spec.period_key and c.key in exprs})


def dictionary_path(silver_root: str, dataset_id: str) -> str:
    return f"{silver_root.rstrip('/')}/dictionary/dataset_id={dataset_id}"


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """Key, value, n; the periods of an accumulated dictionary are summed up."""
    stored = spark.read.parquet(path)
    return stored.groupBy("key", "value").agg(F.sum("n").alias("n"))


def values_of(dictionary: DataFrame, key: str) -> DataFrame:
    return dictionary.where(F.col("key") == key).select("value", "n")
