"""The workbook data source: partitions by sheet, pushed filters, error rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from statsheet.operators.sheets import sheet_headers
from statsheet.sources.workbook import read_workbooks
from statsheet.sources.workbook_source import SheetReader, read_grid
from xlsx_writer import write_xlsx

DAYS = [dt.date(2020 + i // 4, 3 * (i % 4) + 1, 1) for i in range(20)]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    d = tmp_path_factory.mktemp("source")
    table = [["Quarter", "Bank", "Assets"]] + [[q, f"B{i}", i * 1.5] for i, q in enumerate(DAYS)]
    write_xlsx(str(d / "two.xlsx"), {"Table": table, "Notes": [["a note"], ["b", 1e12]]})
    write_xlsx(str(d / "one.xlsx"), {"Table": table[:4]})
    (d / "bad.xlsx").write_bytes(b"PK\x03\x04 no zip")
    (d / "empty.xlsx").write_bytes(b"")
    (d / "other.txt").write_text("not read")
    return str(d)


def test_same_grid_as_the_batch_reader(spark, folder):
    got = read_grid(spark, folder).where("error is null")
    want = read_workbooks(spark, folder + "/*.xlsx").where("error is null")
    norm = lambda df: sorted((r["source"].rpartition("/")[2], r["sheet"], r["row_idx"], r["cells"]) for r in df.collect())
    assert norm(got) == norm(want) and len(norm(got)) == 21 + 2 + 4


def test_a_partition_for_each_sheet(spark, folder):
    grid = read_grid(spark, folder)
    parts = grid.select("source", "sheet", F.spark_partition_id().alias("p")).distinct().collect()
    assert len({r["p"] for r in parts}) == len(parts) == 5  # three sheets and two bad files
    two = {r["p"] for r in parts if r["source"].endswith("two.xlsx")}
    assert len(two) == 2


def test_one_error_row_for_a_bad_file_or_sheet(spark, folder):
    bad = read_grid(spark, folder).where("error is not null").collect()
    assert sorted((r["source"].rpartition("/")[2], r["sheet"]) for r in bad) == [("bad.xlsx", None), ("empty.xlsx", None)]
    named = read_grid(spark, [f"{folder}/one.xlsx", f"{folder}/two.xlsx"], sheets=["Notes"]).collect()
    assert [(r["source"].rpartition("/")[2], r["sheet"]) for r in named if r["error"]] == [("one.xlsx", "Notes")]
    assert sum(r["error"] is None for r in named) == 2


def test_pushed_period_bounds_skip_rows_while_reading(spark, folder):
    grid = read_grid(spark, f"{folder}/two.xlsx", period="quarter", sheets=["Table"])
    days = [d.isoformat() for d in DAYS]
    for cond, keep in [("period >= '2023'", lambda d: d >= "2023"), ("period > '2021-04-01' and period <= '2022-01-01'", lambda d: "2021-04-01" < d <= "2022-01-01"), ("period = '2024-10-01'", lambda d: d == "2024-10-01")]:
        got = grid.where(cond)
        assert sorted(r["period"] for r in got.collect()) == [d for d in days if keep(d)]
    # What the reader itself hands on: the header and the rows of the range.
    from pyspark.sql.datasource import GreaterThanOrEqual, LessThanOrEqual

    reader = SheetReader({"paths": f'["{folder}/two.xlsx"]', "sheets": '["Table"]', "period": "Quarter", "header_row": "1"})
    assert len(list(reader.pushFilters([GreaterThanOrEqual(("period",), "2024-01-01"), LessThanOrEqual(("period",), "2024-08-01")]))) == 2
    read = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    assert [r["row_idx"] for r in read] == [1, 18, 19, 20]


def test_equality_on_sheet_and_source_drops_partitions(spark, folder):
    grid = read_grid(spark, folder)
    assert grid.where("sheet = 'Notes'").rdd.getNumPartitions() == 3 and grid.rdd.getNumPartitions() == 5
    assert grid.where(F.col("source").endswith("one.xlsx")).where("sheet in ('Table', 'x')").count() == 4
    assert grid.where(f"source = '{folder}/one.xlsx'").count() == 4
    assert grid.where("sheet = 'none'").count() == 0


def test_feeds_the_many_sheets_plan(spark, folder):
    grid = read_grid(spark, [f"{folder}/one.xlsx", f"{folder}/two.xlsx"], sheets=["Table"]).where("error is null")
    layout = grid.select(F.lit("D").alias("dataset_id"), "source", "sheet").distinct().withColumns({"header_row": F.lit(1), "data_start_row": F.lit(None).cast("int")})
    assert {tuple(r["names"]) for r in sheet_headers(grid, layout).collect()} == {("Quarter", "Bank", "Assets")}


def test_a_date_beyond_all_days_keeps_its_number(spark, tmp_path):
    import zipfile

    path = str(tmp_path / "far.xlsx")
    write_xlsx(path, {"T": [["Day"], [dt.date(2024, 1, 1)], [dt.date(2024, 1, 2)]]})
    far = str(tmp_path / "far2.xlsx")
    with zipfile.ZipFile(path) as a, zipfile.ZipFile(far, "w") as b:
        for n in a.namelist():
            data = a.read(n)
            b.writestr(n, data.replace(b"<v>45292.0</v>", b"<v>99999999999</v>") if n.endswith("sheet1.xml") else data)
    assert [r["cells"] for r in read_grid(spark, far).orderBy("row_idx").collect()] == [["Day"], ["99999999999"], ["2024-01-02"]]


def test_a_query_does_not_keep_the_filters_of_another(spark, folder):
    grid = read_grid(spark, folder, period="Quarter")
    every = grid.count()
    assert grid.where("sheet = 'Notes'").count() == 2 and grid.count() == every
    assert grid.where("period > '2024-06-01'").count() == 2 and grid.count() == every
    assert grid.where("sheet = 'Notes'").union(grid).count() == every + 2
