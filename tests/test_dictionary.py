"""Dimension dictionaries: equal to a full distinct, and read in place of the data."""

import pytest
from pyspark.sql import functions as F

from statsheet import get_data
from statsheet.operators.dictionary import dictionary_of, read_dictionary, value_counts
from statsheet.sources.tables import read_table
from statsheet.spec import get_spec
from statsheet.streaming.accumulate import upsert


def as_set(df):
    return {(r["key"], r["value"], r["n"]) for r in df.collect()}


def test_equals_a_full_distinct_after_upserts(spark, tmp_path):
    history, book = str(tmp_path / "history"), str(tmp_path / "dictionary")
    cols = "entity string, sector string, region string, period string, fetched int, v double"
    batches = [
        [("a", "x", "n", "2024", 1, 1.0), ("b", "x", None, "2024", 1, 2.0), ("c", "y", "s", "2023", 1, 3.0)],
        [("a", "z", "n", "2024", 2, 4.0), ("d", "y", "s", "2025", 2, 5.0)],
        [("a", "z", "n", "2024", 2, 4.0), ("d", "y", "s", "2025", 2, 5.0)],  # a replay
        [("c", "w", None, "2023", 3, 6.0)],
    ]
    for b in batches:
        upsert(spark.createDataFrame(b, cols), history, ["entity", "period"], ["fetched"], "period", str(tmp_path / "stage"), dictionary_path=book, dimensions=["sector", "region"])
        rows = spark.read.schema(cols).parquet(history)
        assert as_set(read_dictionary(spark, book)) == as_set(value_counts(rows, {"sector": F.col("sector"), "region": F.col("region")}))
    assert ("sector", "x", 1) in as_set(read_dictionary(spark, book)) and not any(v == "y" and n > 1 for _, v, n in as_set(read_dictionary(spark, book)))


def test_checks_read_the_dictionary_not_the_data(spark, root):
    spec = get_spec("ORDERS")
    orders = read_table(spark, root, "orders")
    book = dictionary_of(orders, spec)
    assert {(r["value"], r["n"]) for r in book.where("key = 'priority'").collect()} == {(r[0], r[1]) for r in orders.groupBy("o_orderpriority").count().collect()}
    assert get_data(spark, "ORDERS", {"priority": "1-URGENT"}, root=root, validate=True, dictionary=book).records.count() > 0
    # A dictionary that lacks the value decides, whatever the data hold.
    poor = book.where("value <> '1-URGENT'").unionByName(spark.createDataFrame([("priority", "1-URGENTLY", 1)], "key string, value string, n long"))
    poor = poor.where("key = 'priority'")
    broken = orders.withColumn("o_orderpriority", F.raise_error(F.lit("data were read")).cast("string"))
    with pytest.raises(ValueError, match="1-URGENTLY"):
        get_data(spark, "ORDERS", {"priority": "1-URGENTT"}, source=broken, validate=True, dictionary=poor)


def test_hint_from_the_dictionary(spark, root):
    lines = read_table(spark, root, "lineitem")
    spec = get_spec("LINEITEM")
    from statsheet.operators.filters import missing_value_hint

    book = spark.createDataFrame([("returnflag", "Refunded", 3), ("linestatus", "O", 9)], "key string, value string, n long")
    free = [c.key for c in spec.dimension_columns() if not c.permissive and not spec.dimension_values.get(c.key) and c.key != spec.period_key]
    for key in free:
        held = book.withColumn("key", F.lit(key))
        assert "Refunded" in missing_value_hint(held, spec, {key: "Refundedd"})
        assert missing_value_hint(held, spec, {key: "Refunded"}) is None
    assert missing_value_hint(book, spec, {"linestatus": ["x"]}) is None and lines.columns
