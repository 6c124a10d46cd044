"""Cases that once went wrong, each with the answer it must give."""

import datetime as dt
import subprocess
import sys
import urllib.parse
import zipfile

import pytest
from conftest import ROOT
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType
from statsheet import get_data, latest, search_datasets, top_n
from statsheet.functions.coerce import clean_string
from statsheet.functions.links import absolute_url, normalize_dataset_id, normalize_dataset_id_col, redact_urls
from statsheet.functions.periods import header_period, is_period_header
from statsheet.plans.api import describe_dataset
from statsheet.plans.ingest import ingest, read_silver
from statsheet.sources.tables import read_csv_text
from statsheet.sources.workbook import errors, read_workbooks
from statsheet.spec import SpecError, spec_from_dict
from statsheet.streaming.accumulate import latest_per_key, upsert
from xlsx_writer import write_xlsx

COLUMNS = [{"key": "x", "source": "X", "role": "dimension"}]


def test_flat_alias_maps():
    spec = spec_from_dict({"id": "A", "name": "a", "columns": COLUMNS, "dimension_values": {"x": {"stock": "Stock basis", "values": "Values basis"}}})
    assert spec.translate("x", "stock") == "Stock basis" and spec.translate("x", "values") == "Values basis"
    with pytest.raises(ValueError, match="is no value of"):
        spec.translate("x", "bogus")
    nested = spec_from_dict({"id": "A", "name": "a", "columns": COLUMNS, "dimension_values": {"x": {"values": {"s": "S"}, "permissive": True}}})
    assert nested.translate("x", "s") == "S" and nested.translate("x", "other") == "other"
    for bad in ("text", {"a": {"b": "c"}}, ["a"]):
        with pytest.raises(SpecError):
            spec_from_dict({"id": "A", "name": "a", "columns": COLUMNS, "dimension_values": {"x": bad}})


def test_urls_resolve_as_the_standard_library_does(spark):
    bases = ["https://h.org/a/b/c.html?q=1#f", "https://h.org", "http://h.org/x/", "https://h.org/a"]
    hrefs = ["../x", "./x", "../../x", "../../../../x", "x/./y/../z.xlsx?u=/../v#w", "?q=2", "#top", "/r/../s", "//o.org/p", "mailto:a@b", "..", ".", "a/..", "p%20q.xlsx", ""]
    rows = [(b, h) for b in bases for h in hrefs]
    got = spark.createDataFrame(rows, "b string, h string").select("b", "h", absolute_url("b", "h").alias("u")).collect()
    for r in got:
        want = urllib.parse.urljoin(r["b"], r["h"]) if r["h"] else r["b"].partition("#")[0]
        assert r["u"] == want, (r["b"], r["h"])


def test_redaction_takes_the_whole_url(spark):
    texts = ["see https://x.example.org.mirror.net/secret/a.xlsx now", "https://user:pw@www.example.org/x?y=1", "http://other.net/?to=example.org&k=v.", "<a href='https://EXAMPLE.org/a'>", "plain example.org stays"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(redact_urls("t", r"example\.org")).collect()]
    assert got == ["see <source> now", "<source>", "<source>", "<a href='<source>'>", "plain example.org stays"]


def test_dataset_ids_in_both_forms(spark):
    raw = ["\tABC ", "ABC\n", "A\nB", "a_1", "1A", "", None, "\u00a0AB\u00a0"]

    def one(v):
        try:
            return normalize_dataset_id(v)
        except ValueError:
            return None

    got = [r[0] for r in spark.createDataFrame([(i, v) for i, v in enumerate(raw)], "i int, v string").orderBy("i").select(normalize_dataset_id_col("v")).collect()]
    assert got == [one(v) for v in raw] == ["ABC", "ABC", None, "A_1", None, None, None, "AB"]


def test_whole_numbers_beyond_a_long(spark):
    df = spark.createDataFrame([(1e20,), (42.0,), (None,)], "v double")
    assert [r[0] for r in df.select(clean_string("v", DoubleType(), True)).collect()] == ["1.0E20", "42", None]


def test_argument_checks(spark, root):
    for limit in (True, 2.5, 0):
        with pytest.raises(ValueError):
            search_datasets(spark, "orders", limit=limit)
    for call in (lambda **k: latest(spark, "ORDERS", {"priority": "urgnt"}, root=root, **k), lambda **k: top_n(spark, "ORDERS", "total_price", 3, {"priority": "urgnt"}, root=root, **k)):
        assert call().records.count() == 0
        with pytest.raises(ValueError, match="urgent"):
            call(validate=True)


def test_describe_covers_the_data(spark, root):
    r = describe_dataset(spark, "ORDERS", root=root).first()
    o = spark.read.parquet(f"{root}/orders.parquet").agg(F.date_format(F.min("o_orderdate"), "yyyy-MM-dd"), F.date_format(F.max("o_orderdate"), "yyyy-MM-dd")).first()
    assert tuple(r["period_coverage"]) == tuple(o) and describe_dataset(spark, "ORDERS").first()["period_coverage"] is None


def test_iso_date_headers():
    assert is_period_header("2024-03-31") and is_period_header("2024-03-31 00:00:00") and not is_period_header("2024-03")
    assert header_period("2024-03-31 00:00:00") == "2024-03-31" and header_period(dt.datetime(2024, 3, 31)) == "2024-03-31"


def _replace(path, out, member, change):
    with zipfile.ZipFile(path) as src, zipfile.ZipFile(out, "w") as dst:
        for name in src.namelist():
            data = src.read(name)
            dst.writestr(name, change(data.decode()).encode() if name == member else data)


ROWS = [["Id", "When"], [12345678901234567890, dt.date(2024, 3, 31)], [7, dt.date(2024, 6, 30)]]


def test_bad_files_do_not_stop_the_others(spark, tmp_path):
    good = str(tmp_path / "good.xlsx")
    write_xlsx(good, {"T": [["Name"], ["alpha"], ["beta"]]})
    dated = str(tmp_path / "dated.xlsx")
    write_xlsx(dated, {"T": ROWS})
    _replace(good, str(tmp_path / "strings.xlsx"), "xl/sharedStrings.xml", lambda t: t[: len(t) // 2])
    _replace(good, str(tmp_path / "index.xlsx"), "xl/worksheets/sheet1.xml", lambda t: t.replace("<v>2</v>", "<v>999</v>"))
    serial = str((dt.datetime(2024, 3, 31) - dt.datetime(1899, 12, 30)).days)
    _replace(dated, str(tmp_path / "huge.xlsx"), "xl/worksheets/sheet1.xml", lambda t: t.replace(serial, "99999999999"))
    grid = read_workbooks(spark, str(tmp_path), ["T"]).collect()
    failed = {r["source"].rsplit("/", 1)[1] for r in grid if r["error"]}
    assert failed == {"strings.xlsx", "index.xlsx"}
    # A number beyond all days is no date: it stays, and so does the rest of its sheet.
    huge = [r["cells"] for r in grid if r["source"].endswith("huge.xlsx")]
    assert [c[1] for c in huge] == ["When", "99999999999", "2024-06-30"]
    assert [r["cells"] for r in grid if r["source"].endswith("good.xlsx")] == [["Name"], ["alpha"], ["beta"]]


def test_digits_date_base_and_rows_without_numbers(spark, tmp_path):
    path = str(tmp_path / "a.xlsx")
    write_xlsx(path, {"T": ROWS})
    import re

    other = str(tmp_path / "b.xlsx")
    _replace(path, other, "xl/workbook.xml", lambda t: t.replace("<sheets>", '<workbookPr date1904="1"/><sheets>'))
    bare = str(tmp_path / "c.xlsx")
    _replace(path, bare, "xl/worksheets/sheet1.xml", lambda t: re.sub(r' r="[A-Z]*[0-9]+"', "", t))
    read = lambda p: [(r["row_idx"], r["cells"]) for r in read_workbooks(spark, p, ["T"]).orderBy("row_idx").collect()]
    assert read(path)[1] == (2, ["12345678901234567890", "2024-03-31"])
    assert read(other)[1][1][1] == "2028-04-01"  # the same serial, counted from 1904
    assert read(bare) == read(path)


def test_ingest_reports_a_sheet_that_breaks_half_way_and_types_the_rest(spark, tmp_path, monkeypatch):
    rows = [["Date", "Name", "Value"], [dt.date(2024, 3, 31), " A ", 1.5], [dt.date(2024, 6, 30), "A", 2], [None, "Z", None]]
    good, bad = str(tmp_path / "good.xlsx"), str(tmp_path / "bad.xlsx")
    write_xlsx(good, {"T": rows})
    _replace(good, bad, "xl/worksheets/sheet1.xml", lambda t: t.replace('<row r="4">', '<row r="4"><c r="A4" t="s"><v>999</v></c>'))
    columns = [
        {"key": "period", "source": "Date", "role": "dimension", "dtype": "date"},
        {"key": "name", "source": "Name", "role": "dimension", "permissive": True},
        {"key": "v", "source": "Value", "role": "measure"},
    ]
    specs = {i: spec_from_dict({"id": i, "name": i, "format": "xlsx", "sheet": "T", "period_column": "Date", "columns": columns}) for i in ("GOOD", "BAD")}
    import statsheet.plans.ingest as module

    monkeypatch.setattr(module, "get_spec", specs.__getitem__)
    status = {r["dataset_id"]: r["status"] for r in ingest(spark, {"GOOD": good, "BAD": bad}, str(tmp_path / "bronze"), str(tmp_path / "silver")).collect()}
    assert status["GOOD"] == "ok" and status["BAD"].startswith("error:")
    silver = read_silver(spark, str(tmp_path / "silver"), "GOOD")
    kinds = dict(silver.dtypes)
    assert kinds["Date"] == "date" and kinds["Value"] == "double"
    res = get_data(spark, specs["GOOD"], {"name": "A"}, start_period="2024-06", source=silver)
    assert [(r["period"], r["value"]) for r in res.records.collect()] == [("2024-06-30", 2.0)]
    plan = spark._jvm.PythonSQLUtils.explainString(res.records._jdf.queryExecution(), "formatted")
    assert "GreaterThanOrEqual(Date" in plan


def test_csv_header_in_another_order_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    assert read_csv_text(spark, str(tmp_path / "a.csv"), ["x", "y"]).first()["y"] == "2"
    with pytest.raises(Exception):
        read_csv_text(spark, str(tmp_path / "a.csv"), ["y", "x"]).collect()


def test_ties_are_decided_and_files_bounded(spark, tmp_path):
    rows = [("k", 1, f"v{i}", "p") for i in range(6)]
    df = spark.createDataFrame(rows, "k string, at int, v string, p string")
    picks = {latest_per_key(df.repartition(n), ["k"], ["at"]).first()["v"] for n in (1, 2, 5)}
    assert len(picks) == 1
    many = spark.range(4000, numPartitions=16).selectExpr("cast(id as string) k", "1 at", "'v' v", "cast(id % 2 as string) p")
    history, folder = str(tmp_path / "history"), str(tmp_path / "shared")
    for _ in range(2):
        upsert(many, history, ["k"], ["at"], "p", folder)
    assert spark.read.parquet(history).count() == 4000
    from statsheet.streaming.accumulate import FILES_PER_PERIOD

    for p in (tmp_path / "history").glob("p=*"):
        assert len(list(p.glob("*.parquet"))) <= FILES_PER_PERIOD
    assert not list((tmp_path / "shared").glob("statsheet-staging-*"))


def test_stream_checkpoint_is_found_again_by_another_process(tmp_path):
    code = f"""
import sys; sys.path.insert(0, {ROOT!r})
from statsheet.session import local_session
from statsheet.streaming.accumulate import accumulate_stream
spark = local_session(2, 2, extra_conf={{"spark.checkpoint.dir": {str(tmp_path / "ck")!r}}})
if not __import__("os").path.exists({str(tmp_path / "in")!r}):
    spark.createDataFrame([("a", 1, "p")], "k string, at int, p string").write.parquet({str(tmp_path / "in")!r})
q = accumulate_stream(spark, {str(tmp_path / "in")!r}, "k string, at int, p string", {str(tmp_path / "out")!r}, ["k"], ["at"], "p")
print("ROWS", sum(p["numInputRows"] for p in q.recentProgress))
"""
    said = [subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=240).stdout for _ in range(2)]
    assert "ROWS 0" not in said[0] and "ROWS 0" in said[1]


def test_range_outside_a_transposed_sheet_is_empty(spark):
    sheet = spark.createDataFrame([("Office", 1.0, 2.0), ("Retail", 3.0, None)], "priority string, `Mar 2025` double, `Jun 2025` double")
    for a, b in (("1900", "1950"), ("2030", None), (None, "2024")):
        res = get_data(spark, "ORDERS_MONTHLY", start_period=a, end_period=b, source=sheet)
        assert res.records.collect() == [] and res.summary.first()["row_count"] == 0
        assert res.records.columns == get_data(spark, "ORDERS_MONTHLY", source=sheet).records.columns
    assert get_data(spark, "ORDERS_MONTHLY", start_period="2025-Q2", source=sheet).records.count() == 1
    assert latest(spark, "ORDERS_MONTHLY", source=sheet).records.count() == 1


def test_hosts_as_the_standard_library_reads_them(spark):
    from statsheet.functions.links import host_allowed, url_host

    urls = ["http://a.org/x y", "http://a.org/x|y", "https://A.org:8443/p", "http://me:p@w@a.org/q", "//a.org/x", "http://a.org?u=http://b.org", "http://a.org#@b.org", "ftp://a.org", "a.org/x", "", "http:///x", "http://[::1]:80/x", "mailto:x@a.org", "http://a.org.evil.net/", "http://evil.net/a.org"]
    got = spark.createDataFrame([(u,) for u in [*urls, None]], "u string").select("u", url_host("u").alias("h"), host_allowed("u", ["a.org"]).alias("ok")).collect()
    for r in got:
        host = urllib.parse.urlparse(r["u"]).hostname if r["u"] else None
        assert (r["h"] or None) == host and r["ok"] == (host == "a.org"), r


def test_a_measure_without_a_unit_beside_one_with(spark):
    spec = spec_from_dict({"id": "U", "name": "u", "columns": [
        {"key": "x", "source": "X", "role": "dimension", "dtype": "string"},
        {"key": "a", "source": "A", "role": "measure", "unit": "AUD"}, {"key": "b", "source": "B", "role": "measure"}]})
    from statsheet.operators.observe import observations
    from statsheet.operators.project import project

    rows = observations(project(spark.createDataFrame([("p", 1.0, 2.0)], "X string, A double, B double"), spec), spec, ["a", "b"]).collect()
    assert sorted((r["measure"], r["unit"], r["value"]) for r in rows) == [("a", "AUD", 1.0), ("b", None, 2.0)]


def test_chunked_series_of_any_length(spark, root):
    res = get_data(spark, "LINEITEM", measures=["quantity", "tax"], root=root)
    chunks = res.chunked_series(rows=70).collect()
    for m in ("quantity", "tax"):
        own = sorted((c for c in chunks if c["measure"] == m), key=lambda c: c["chunk"])
        assert [c["chunk"] for c in own] == list(range(len(own))) and max(len(c["observations"]) for c in own) <= 70
        flat = [(o["period"], o["value"], o["dimensions"]["orderkey"]) for c in own for o in c["observations"]]
        lines = spark.read.parquet(f"{root}/lineitem.parquet").orderBy("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").select("l_quantity" if m == "quantity" else "l_tax", "l_orderkey").collect()
        # Lines may tie on all order columns.
        assert [k for *_, k in flat] == [str(r[1]) for r in lines] and sorted((v, k) for _, v, k in flat) == sorted((r[0], str(r[1])) for r in lines)
    with pytest.raises(ValueError):
        res.chunked_series(rows=0)
