"""Smaller operators: CSV source, value checks, hints, JSON inputs, ids, CSV sink."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from statsheet import get_data
from statsheet.functions.links import normalize_dataset_id, normalize_dataset_id_col, stale_age_minutes
from statsheet.operators.filters import empty_result_hint, validate_permissive_values
from statsheet.operators.links import read_seed_manifest
from statsheet.operators.observe import write_csv
from statsheet.operators.project import key_expressions
from statsheet.sources.tables import read_csv_text
from statsheet.spec import SpecError, get_spec, parse_filters, spec_from_dict

CSV_SPEC = {
    "id": "CSV_SMALL",
    "name": "csv fixture",
    "format": "csv",
    "period_column": "Reporting date",
    "order_by": ["Row"],
    "columns": [
        {"key": "period", "source": "Reporting date", "role": "dimension", "dtype": "date"},
        {"key": "state", "source": "State", "role": "dimension", "dtype": "string", "permissive": True},
        {"key": "abn", "source": "ABN", "role": "id", "dtype": "string", "permissive": True},
        {"key": "value", "source": "Value", "role": "measure", "dtype": "float", "unit": "AUD"},
    ],
}


def test_csv_source_through_the_pipeline(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "t.csv")
    with open(path, "w") as f:
        f.write("Row,Reporting date,State,ABN,Value\n")
        f.write("1,2024-03-31, New South Wales ,12345678901,\" 1e3 \"\n")
        f.write("2,2024-06-30 00:00:00,Victoria,98765432109,1d\n")
        f.write("3,2024-06-30,Queensland,11111111111,2.5\n")
    spec = spec_from_dict({**CSV_SPEC, "path": path})
    raw = read_csv_text(spark, path)
    assert raw.schema["Value"].dataType.simpleString() == "string"
    rows = get_data(spark, spec, {"state": "NSW"}).records.collect()
    assert [(r["period"], r["state"], r["abn"], r["value"]) for r in rows] == [("2024-03-31", "New South Wales", "12345678901", 1000.0)]
    late = get_data(spark, spec, start_period="2024-Q2").records.collect()
    assert [r["value"] for r in late] == [2.5]  # '1d' is not a number


def test_permissive_value_check_and_hints(spark, root):
    spec = get_spec("ORDERS")
    raw = spark.read.parquet(f"{root}/orders.parquet")
    exprs = key_expressions(raw, spec)
    validate_permissive_values(raw, spec, {"priority": "urgent"}, exprs)  # an alias
    validate_permissive_values(raw, spec, {"priority": "1-URGENT"}, exprs)  # canonical
    with pytest.raises(ValueError, match="Did you mean 'urgent'"):
        validate_permissive_values(raw, spec, {"priority": "urgnt"}, exprs)
    with pytest.raises(ValueError):
        get_data(spark, "ORDERS", {"priority": "nope"}, root=root, validate=True)
    hint = empty_result_hint(raw, spec, "priority", "1-URGNT", exprs["priority"])
    assert "1-URGENT" in hint
    year = spark.createDataFrame([("2019",), ("2021",)], "y string")
    for asked, place in (("2030", "after the last"), ("1999", "before the first"), ("2020", "without rows")):
        hint = empty_result_hint(year, spec, "y", asked, F.col("y"))
        assert place in hint and "2019 to 2021" in hint and "Close" not in hint
    three = spark.createDataFrame([("alpha",), ("alpho",), ("alphx",), ("alphaa",), ("zzz",)], "y string")
    assert "'alpha', 'alphaa', 'alpho'" in empty_result_hint(three, spec, "y", "alpha ", F.col("y"))


def test_filters_as_json(spark, root):
    assert parse_filters('{"status": ["F", "O"]}') == {"status": ["F", "O"]}
    with pytest.raises(ValueError):
        parse_filters("{not json")
    with pytest.raises(ValueError):
        parse_filters("[1, 2]")
    n = get_data(spark, "ORDERS", '{"status": "F"}', root=root).records.count()
    assert n == get_data(spark, "ORDERS", {"status": "filled"}, root=root).records.count()


def test_seed_manifest_json(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "seed.json")
    with open(path, "w") as f:
        json.dump({"refreshed_at": "2026-01-01", "urls": {"A": "https://x.example/a.xlsx", "B": "ftp://no", "C": "http://y/c.xlsx"}}, f)
    got = sorted((r["dataset_id"], r["seed_url"]) for r in read_seed_manifest(spark, path).collect())
    assert got == [("A", "https://x.example/a.xlsx"), ("C", "http://y/c.xlsx")]


def test_ids_and_age(spark):
    assert normalize_dataset_id(" orders ") == "ORDERS"
    for bad in ("", "1ABC", "a-b"):
        with pytest.raises(ValueError):
            normalize_dataset_id(bad)
    df = spark.createDataFrame([(" adi_key_stats ",), ("bad id",)], "s string")
    assert [r[0] for r in df.select(normalize_dataset_id_col("s")).collect()] == ["ADI_KEY_STATS", None]
    t = spark.createDataFrame([(dt.datetime(2026, 1, 1, 0, 0), dt.datetime(2026, 1, 1, 1, 30, 59)), (dt.datetime(2026, 1, 2), dt.datetime(2026, 1, 1))],
                              "fetched timestamp, now timestamp")
    assert [r[0] for r in t.select(stale_age_minutes("fetched", F.col("now"))).collect()] == [90, 0]


def test_csv_sink(spark, root, tmpdir_path):
    res = get_data(spark, "ORDERS", {"status": "P"}, start_period="1996", end_period="1996", root=root)
    out = os.path.join(tmpdir_path, "csv")
    write_csv(res.observations, res.spec, out)
    back = spark.read.option("header", True).csv(out)
    assert back.columns == ["period", "measure", "value", "unit", "status", "priority", "customer", "orderkey"]
    assert back.count() == res.records.count()


def test_spec_validation():
    with pytest.raises(SpecError):
        spec_from_dict({"id": "X", "name": "x", "columns": [{"key": "a", "source": "A", "role": "oops"}]})
    with pytest.raises(SpecError):
        spec_from_dict({"id": "X", "name": "x", "layout": "diagonal", "columns": []})
    with pytest.raises(SpecError):
        spec_from_dict({"id": "X", "name": "x", "columns": [{"key": "a", "source": "A", "role": "id"}, {"key": "a", "source": "B", "role": "id"}]})
    with pytest.raises(ValueError, match="is no measure of"):
        get_spec("ORDERS").resolve_measures("price")
    assert get_spec("ORDERS").resolve_measures(["o_totalprice", "total_price"]) == ["total_price"]


def test_schema_drift_names_missing_and_seen(spark):
    df = spark.createDataFrame([("a", 1.0)], "Entity string, Value double")
    spec = spec_from_dict({"id": "D", "name": "d", "columns": [
        {"key": "institution", "source": "Entity name", "role": "dimension", "dtype": "string"},
        {"key": "v", "source": "Value", "role": "measure"}]})
    with pytest.raises(ValueError, match=r"\['Entity name'\].*Saw"):
        get_data(spark, spec, source=df)


def test_tiers_with_stale_payload(spark):
    from statsheet.operators.links import resolve_tiers

    ds = spark.createDataFrame([("A", "https://d/a"), ("B", "https://d/b"), ("C", "https://d/c")], "dataset_id string, default_url string")
    scraped = spark.createDataFrame([("A", "https://l/a.xlsx")], "dataset_id string, link_url string")
    seed = spark.createDataFrame([("B", "https://s/b.xlsx")], "dataset_id string, seed_url string")
    payloads = spark.createDataFrame([("A", "payload served from cache")], "dataset_id string, stale_reason string")
    got = {r["dataset_id"]: r for r in resolve_tiers(ds, scraped, seed, payloads).collect()}
    assert (got["A"]["tier"], got["A"]["stale"], got["A"]["stale_reason"]) == ("scrape", True, "payload served from cache")
    assert (got["B"]["tier"], got["B"]["url"], got["B"]["stale"]) == ("seed", "https://s/b.xlsx", True)
    assert got["B"]["stale_reason"].startswith("no matching link")
    assert (got["C"]["tier"], got["C"]["url"]) == ("default", "https://d/c")
