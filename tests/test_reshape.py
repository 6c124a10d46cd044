"""Layouts: transposed melt, snapshot header, blank rows, header promotion."""

import pytest
from pyspark.sql import functions as F

from statsheet import get_data, latest
from statsheet.operators.reshape import drop_blank_rows, melt_transposed, promote_header
from statsheet.spec import spec_from_dict


def test_melt_transposed(spark):
    df = spark.createDataFrame(
        [("Office", 1.0, None, "n1"), ("Retail", 2.0, 3.0, None), (None, 9.0, 9.0, "x")],
        "`Property type` string, `Mar 2025` double, `jun 2025` double, Notes string",
    )
    rows = melt_transposed(df, "property_type").orderBy("_melt_col", "property_type").collect()
    assert [(r["property_type"], r["period"].isoformat(), r["value"]) for r in rows] == [
        ("Office", "2025-03-31", 1.0), ("Retail", "2025-03-31", 2.0), ("Office", "2025-06-30", None), ("Retail", "2025-06-30", 3.0),
    ]
    assert "Notes" not in rows[0].asDict()


def test_melt_without_period_headers_is_unchanged(spark):
    df = spark.createDataFrame([("a", 1.0)], "entity string, value double")
    assert melt_transposed(df, "x").columns == ["entity", "value"]


def test_blank_rows(spark):
    df = spark.createDataFrame([("x", 1, "a"), (None, None, "b"), ("y", 3, "c"), (None, None, None)], "A string, B int, C string")
    assert drop_blank_rows(df, ["A", "B"]).count() == 2
    assert drop_blank_rows(df, ["A", "missing"]).count() == 2
    assert drop_blank_rows(df, ["missing"]).count() == 4


def test_header_promotion_and_max_rows(spark):
    grid = spark.createDataFrame(
        [(1, ["Title", None]), (2, ["Entity\nname", ""]), (3, ["a", "1"]), (4, [None, None]), (5, ["b", "2"]), (6, ["c", "3"])]
        + [(10 + i, [f"r{i}", str(i)]) for i in range(10)],
        "row_idx long, cells array<string>",
    )
    t = promote_header(grid, header_row=2)
    assert t.columns == ["Entity name", "Unnamed: 1"]
    assert t.count() == 13
    assert promote_header(grid, header_row=2, max_rows=5).count() == 4  # the blank row is one of the 5
    assert promote_header(grid, header_row=2, data_start_row=5).count() == 12
    with pytest.raises(ValueError):
        promote_header(grid, header_row=2, data_start_row=2)
    with pytest.raises(ValueError):
        promote_header(grid, header_row=99)


TRANSPOSED = spec_from_dict(
    {
        "id": "T_SMALL",
        "name": "transposed fixture",
        "layout": "transposed",
        "entity_alias": "fund_type",
        "period_column": "period",
        "order_by": ["_melt_col", "row"],
        "columns": [
            {"key": "fund_type", "source": "fund_type", "role": "dimension", "dtype": "string"},
            {"key": "period", "source": "period", "role": "dimension", "dtype": "date"},
            {"key": "total_assets", "source": "value", "role": "measure", "dtype": "float", "unit": "AUD billions"},
        ],
        "dimension_values": {"fund_type": {"values": {"industry": "Industry", "retail": "Retail"}}},
    }
)


def test_transposed_pipeline(spark):
    df = spark.createDataFrame(
        [("Industry", 1, 10.0, 11.0), ("Retail", 2, 20.0, None)], "fund_type string, row long, `Mar 2025` double, `Jun 2025` double"
    )
    res = get_data(spark, TRANSPOSED, {"fund_type": "industry"}, source=df)
    assert [(r["period"], r["value"]) for r in res.records.orderBy("period").collect()] == [("2025-03-31", 10.0), ("2025-06-30", 11.0)]
    lat = latest(spark, TRANSPOSED, source=df).records.collect()
    assert [(r["fund_type"], r["period"]) for r in lat] == [("Industry", "2025-06-30")]


SNAPSHOT = spec_from_dict(
    {
        "id": "S_SMALL",
        "name": "snapshot fixture",
        "snapshot": True,
        "period_column": "period",
        "columns": [
            {"key": "institution", "source": "institution", "role": "dimension", "dtype": "string", "permissive": True},
            {"key": "period", "source": "period", "role": "dimension", "dtype": "date"},
            {"key": "total_assets", "source": "Total assets", "role": "measure", "dtype": "float", "unit": "AUD millions"},
        ],
    }
)


def test_snapshot_header(spark):
    df = spark.createDataFrame([("Alpha", "100"), (None, None), ("Beta", "2,000")], "`2025-03-31 00:00:00` string, `Total assets` string")
    rows = get_data(spark, SNAPSHOT, source=df).records.collect()
    assert [(r["institution"], r["period"], r["value"]) for r in rows] == [("Alpha", "2025-03-31", 100.0)]


def test_transposed_period_columns_pruned_before_melt(spark, tmpdir_path):
    path = f"{tmpdir_path}/t.parquet"
    spark.createDataFrame(
        [("Industry", 1, 10.0, 11.0, 12.0)], "fund_type string, row long, `Mar_2025` double, `Jun_2025` double, `Sep_2025` double"
    ).toDF("fund_type", "row", "Mar 2025", "Jun 2025", "Sep 2025").write.parquet(path)
    df = spark.read.parquet(path)
    res = get_data(spark, TRANSPOSED, start_period="2025-06", end_period="2025-06", source=df)
    assert [(r["period"], r["value"]) for r in res.records.collect()] == [("2025-06-30", 11.0)]
    plan = spark._jvm.PythonSQLUtils.explainString(res.records._jdf.queryExecution(), "formatted")
    schema = [ln for ln in plan.splitlines() if ln.startswith("ReadSchema")][0]
    assert "Jun 2025" in schema and "Mar 2025" not in schema and "Sep 2025" not in schema
