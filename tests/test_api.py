"""The public calls on the driver's smallest tables and on synthetic fixtures."""

import math

import pytest
from pyspark.sql import functions as F

from statsheet import describe_dataset, get_data, latest, list_curated, top_n
from statsheet.spec import spec_from_dict

WIDE = spec_from_dict(
    {
        "id": "WIDE_SMALL",
        "name": "wide fixture",
        "period_column": "period",
        "order_by": ["row"],
        "columns": [
            {"key": "period", "source": "period", "role": "dimension", "dtype": "date"},
            {"key": "entity", "source": "entity", "role": "dimension", "dtype": "string", "permissive": True},
            {"key": "sector", "source": "sector", "role": "dimension", "dtype": "string"},
            {"key": "m1", "source": "m1", "role": "measure", "dtype": "float", "unit": "AUD"},
            {"key": "m2", "source": "m2", "role": "measure", "dtype": "float", "unit": "ratio"},
        ],
        "dimension_values": {"sector": {"values": {"major": "Major banks", "other": "Other banks"}}},
    }
)


@pytest.fixture(scope="module")
def wide(spark):
    import datetime as dt

    d1, d2 = dt.date(2024, 3, 31), dt.date(2024, 6, 30)
    rows = [
        (1, d1, "Alpha Bank", "Major banks", 10.0, 0.1),
        (2, d1, "Beta Bank", "Other banks", 10.0, None),
        (3, d2, "Alpha Bank", "Major banks", float("nan"), 0.2),
        (4, d2, "Beta Bank", None, 7.0, 0.3),
        (5, d2, "Gamma Mutual", "Other banks", 10.0, 0.4),
        (6, None, "Delta", "Other banks", 1.0, 0.5),
    ]
    return spark.createDataFrame(rows, "row long, period date, entity string, sector string, m1 double, m2 double")


def test_observations_drop_null_and_nan(spark, wide):
    recs = get_data(spark, WIDE, source=wide).records.collect()
    assert len(recs) == 10  # 12 cells minus one null and one NaN
    assert all(r["value"] is not None and not math.isnan(r["value"]) for r in recs)
    assert {r["unit"] for r in recs if r["measure"] == "m2"} == {"ratio"}


def test_null_dimension_omitted_from_map(spark, wide):
    res = get_data(spark, WIDE, {"entity": "Beta Bank"}, start_period="2024-Q2", source=wide)
    maps = [r["dimensions"] for r in res.with_map().collect()]
    assert maps and all("sector" not in m for m in maps)


def test_filters_alias_wildcard_and_errors(spark, wide):
    got = get_data(spark, WIDE, {"sector": "major"}, source=wide).records
    assert {r["entity"] for r in got.collect()} == {"Alpha Bank"}
    got = get_data(spark, WIDE, {"entity": "*bank"}, "m1", source=wide).records
    assert {r["entity"] for r in got.collect()} == {"Alpha Bank", "Beta Bank"}
    with pytest.raises(ValueError, match="Did you mean 'entity'"):
        get_data(spark, WIDE, {"entitty": "x"}, source=wide)
    with pytest.raises(ValueError, match="wildcard"):
        get_data(spark, WIDE, {"entity": "*"}, source=wide)
    with pytest.raises(ValueError, match="is no value of"):
        get_data(spark, WIDE, {"sector": "majr"}, source=wide)
    with pytest.raises(ValueError, match="after"):
        get_data(spark, WIDE, start_period="2024-06", end_period="2024-03", source=wide)
    with pytest.raises(ValueError):
        get_data(spark, WIDE, start_period="garbage", source=wide)
    with pytest.raises(ValueError, match="format"):
        get_data(spark, WIDE, fmt="recrods", source=wide)
    with pytest.raises(ValueError, match="empty list"):
        get_data(spark, WIDE, {"entity": []}, source=wide)


def test_expanded_bounds_that_text_compare_would_reject(spark, wide):
    # ('2024-03', '2024') is a valid range once both ends are expanded.
    n = get_data(spark, WIDE, start_period="2024-03", end_period="2024", source=wide).records.count()
    assert n == 8


def test_top_n_ties_keep_declared_order(spark, wide):
    res = top_n(spark, WIDE, "m1", 3, source=wide)
    rows = res.records.collect()
    assert [r["entity"] for r in rows] == ["Alpha Bank", "Beta Bank", "Gamma Mutual"]
    asc = top_n(spark, WIDE, "m1", 2, direction="asc", source=wide).records.collect()
    assert [r["value"] for r in asc] == [1.0, 7.0]
    s = res.summary.first()
    assert s["row_count"] == 3 and s["unit"] == "AUD"


def test_latest_multi_measure_is_one_per_measure(spark, wide):
    rows = latest(spark, WIDE, source=wide).records.collect()
    assert sorted(r["measure"] for r in rows) == ["m1", "m2"]
    by = {r["measure"]: r for r in rows}
    assert by["m1"]["entity"] == "Gamma Mutual" and by["m2"]["entity"] == "Gamma Mutual"


def test_latest_single_measure_is_whole_newest_period(spark, wide):
    rows = latest(spark, WIDE, measures="m2", source=wide).records.collect()
    assert {r["period"] for r in rows} == {"2024-06-30"} and len(rows) == 3


def test_latest_on_driver_tables(spark, root):
    rows = latest(spark, "LINEITEM", root=root).records.collect()
    assert len(rows) == 4 and len({r["measure"] for r in rows}) == 4
    ev = latest(spark, "EVENTS", root=root, limit=None).records.collect()
    assert len(ev) > 10 and len({r["period"] for r in ev}) == 1
    filt = latest(spark, "EVENTS", {"data_item": "click"}, root=root).records.collect()
    assert len({r["period"] for r in filt}) == 1 and {r["data_item"] for r in filt} == {"click"}


def test_summary_and_limit(spark, root):
    res = get_data(spark, "LINEITEM", root=root, limit=5)
    s = res.summary.first()
    assert s["row_count"] == 5 and s["truncated_at"] > 5 and s["unit"] is None
    assert res.records.count() == 5
    one = get_data(spark, "ORDERS", start_period="1996", end_period="1996", root=root).summary.first()
    assert one["period_start"] == "1996" and one["unit"] == "USD" and one["truncated_at"] is None


def test_csv_and_series(spark, root):
    res = get_data(spark, "LINEITEM", {"linestatus": "open"}, root=root, limit=6)
    text = res.csv_text()
    header = text.splitlines()[0].split(",")
    assert header[:4] == ["period", "measure", "value", "unit"]
    assert header[4:] == ["returnflag", "linestatus", "orderkey", "partkey", "suppkey", "linenumber"]
    series = res.nested_series().collect()
    assert sum(len(r["observations"]) for r in series) == 6
    empty = get_data(spark, "ORDERS", {"status": "pending"}, start_period="1890", end_period="1890-12", root=root, limit=5)
    assert empty.csv_text() == ""
    whole = get_data(spark, "LINEITEM", {"linestatus": "open"}, root=root)
    for gather in (whole.csv_text, whole.nested_series):
        with pytest.raises(ValueError, match="limit"):
            gather()
    # The flat form has one schema, with a limit or without.
    assert whole.series().columns == res.series().columns == res.records.columns
    lines = get_data(spark, "LINEITEM", {"linestatus": "open"}, root=root, limit=6, fmt="CSV").output()
    assert lines.columns == ["csv"] and [r["csv"].split(",")[1] for r in lines.collect()] == [x.split(",")[1] for x in text.splitlines()[1:]]
    assert get_data(spark, "LINEITEM", root=root, limit=1, fmt=None).fmt == "records"


def test_default_sort_puts_largest_first(spark, root):
    rows = get_data(spark, "CUSTOMER", root=root, limit=10).records.collect()
    vals = [r["value"] for r in rows]
    assert vals == sorted(vals, reverse=True)


def test_describe_and_list(spark):
    d = describe_dataset(spark, "orders").first()
    assert d["id"] == "ORDERS" and [m["key"] for m in d["measures"]] == ["total_price"]
    assert "period" not in [x["key"] for x in d["dimensions"]] or d["period_key"] == "period"
    ids = [r["id"] for r in list_curated(spark).collect()]
    assert ids == sorted(ids) and "LINEITEM" in ids
    with pytest.raises(ValueError, match="Did you mean"):
        get_data(spark, "LINEITEMS")


def test_period_filter_reaches_scan(spark, root):
    df = get_data(spark, "ORDERS", {"status": "F"}, start_period="1996", root=root).records
    plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert "GreaterThanOrEqual(o_orderdate" in plan and "EqualTo(o_orderstatus,F)" in plan


def test_search_ranks(spark):
    from statsheet.operators.search import entries_from_specs, search_datasets
    from statsheet.spec import load_all

    entries = entries_from_specs(load_all().values())
    for q, want in [("orders", "ORDERS"), ("account balance", "CUSTOMER"), ("line items shipments", "LINEITEM"), ("clicks", "EVENTS")]:
        assert search_datasets(spark, q, entries, 3).first()["id"] == want, q
    with pytest.raises(ValueError):
        search_datasets(spark, "  ", entries)


def test_top_n_empty_when_nothing_matches(spark, root):
    res = top_n(spark, "ORDERS", "total_price", 5, {"priority": "*no such priority"}, root=root)
    assert res.records.count() == 0
    s = res.summary.first()
    assert s["row_count"] == 0 and s["period_start"] is None


def test_empty_result_hints(spark, wide):
    spec = spec_from_dict({"id": "WIDE_HINT", "name": "w",
                           "period_column": "period", "order_by": ["row"],
                           "columns": [{"key": "period", "source": "period", "role": "dimension", "dtype": "date"},
                                       {"key": "entity", "source": "entity", "role": "dimension", "dtype": "string"},
                                       {"key": "m1", "source": "m1", "role": "measure", "dtype": "float"}]})
    with pytest.raises(ValueError, match="Close values: 'Alpha Bank'"):
        get_data(spark, spec, {"entity": "Alpha Bnak"}, source=wide, hints=True)
    assert get_data(spark, spec, {"entity": "Alpha Bnak"}, source=wide).records.count() == 0  # hints are opt-in
    assert get_data(spark, spec, {"entity": "Alpha Bank"}, source=wide, hints=True).records.count() == 1  # one NaN cell dropped


def test_wildcard_rules(spark, wide):
    # Q11: '~' anywhere or '*' at either end = case-insensitive substring; all '*'/'~' removed.
    assert {r["entity"] for r in get_data(spark, WIDE, {"entity": "al~pha"}, source=wide).records.collect()} == {"Alpha Bank"}
    assert {r["entity"] for r in get_data(spark, WIDE, {"entity": "*MUTUAL"}, source=wide).records.collect()} == {"Gamma Mutual"}
    # Q10: inside a list the value is literal.
    assert get_data(spark, WIDE, {"entity": ["*bank"]}, source=wide).records.count() == 0
    # Not permissive: '*' is part of the value, which the strict alias map rejects.
    with pytest.raises(ValueError, match="is no value of"):
        get_data(spark, WIDE, {"sector": "major*"}, source=wide)


def test_long_value_list(spark, root):
    keys = [str(k) for k in range(0, 30_000, 3)]  # 10,000 values
    res = get_data(spark, "ORDERS", {"orderkey": keys}, root=root)
    want = get_data(spark, "ORDERS", root=root).records.filter("cast(orderkey as bigint) % 3 = 0").count()
    assert res.records.count() == want


def test_search_default_catalogue(spark):
    from statsheet import search_datasets

    assert search_datasets(spark, "orders").first()["id"] == "ORDERS"
    with pytest.raises(ValueError):
        search_datasets(spark, "orders", limit=0)
