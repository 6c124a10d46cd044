"""Scalar rules: periods, coercion, headers, places, file-name scores."""

import datetime as dt
import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from statsheet.functions.coerce import disambiguate, normalize_header, safe_value
from statsheet.functions.periods import (
    checked_bound,
    expand_period,
    header_period,
    is_period_header,
    validate_period_arg,
)
from statsheet.functions.places import normalise_state


@pytest.mark.parametrize(
    "value,bound,expected",
    [
        ("2024", "start", "2024-01-01"),
        ("2024", "end", "2024-12-31"),
        ("2025-06", "end", "2025-06-30"),
        ("2025-06", "start", "2025-06-01"),
        ("2025-02", "end", "2025-02-28"),
        ("2024-02", "end", "2024-02-29"),  # leap year: the real month end
        ("2024-Q1", "start", "2024-01-01"),
        ("2024-q4", "end", "2024-12-31"),
        ("2024-Q2", "end", "2024-06-30"),
        ("2025-03-31", "end", "2025-03-31"),
        ("  2024  ", "start", "2024-01-01"),
        ("2025-13", "end", "2025-13"),
        ("2024-Q5", "start", "2024-Q5"),
        ("garbage", "start", "garbage"),
        ("", "start", ""),
    ],
)
def test_expand_period(value, bound, expected):
    assert expand_period(value, bound) == expected


def test_expand_period_column_matches_python(spark):
    from pyspark.sql import functions as F

    from statsheet.functions.periods import expand_periods

    inputs = ["2024", "2025-06", "2025-02", "2024-02", "2000-02", "1900-02", "2024-Q1", "2024-q3", "2024-Q5", "2024-Qx",
              "2025-03-31", " 2024 ", "2025-13", "2025-00", "garbage", "", "abcd-02", "2024-1", None]
    df = spark.createDataFrame([(s,) for s in inputs], "v string")
    rows = expand_periods(df, ["v"]).collect()
    for r in rows:
        assert r["v_start"] == (None if r["v"] is None else expand_period(r["v"], "start")), r
        assert r["v_end"] == (None if r["v"] is None else expand_period(r["v"], "end")), r


def test_bounds_reject_unknown_shapes():
    assert checked_bound("2024-Q2", "end") == "2024-06-30"
    for bad in ("20250101", "garbage", "2025-13"):
        with pytest.raises(ValueError):
            checked_bound(bad, "start")


def test_period_argument_checks():
    assert validate_period_arg(2024, "start") == "2024"
    assert validate_period_arg(" 2024-Q1 ", "start") == "2024-Q1"
    with pytest.raises(ValueError):
        validate_period_arg(True, "start")
    with pytest.raises(ValueError):
        validate_period_arg(1800, "start")


def test_header_periods():
    assert header_period("Mar 2025") == "2025-03-31"
    assert header_period("jun 2025") == "2025-06-30"
    assert header_period("Feb 2024") == "2024-02-29"
    assert header_period("Foo 2025") == "Foo 2025"
    assert header_period(dt.datetime(2025, 3, 31)) == "2025-03-31"
    assert header_period("2025-03-31 00:00:00") == "2025-03-31"
    assert is_period_header("Mar 2025") and is_period_header(dt.date(2024, 1, 1))
    assert not is_period_header("Notes")


def test_header_period_column_matches_python(spark):
    from statsheet.functions.periods import header_period_col

    vals = ["Mar 2025", "jun 2025", "Feb 2024", "Foo 2025", "2025-03-31 00:00:00", "Notes", ""]
    df = spark.createDataFrame([(v,) for v in vals], "h string")
    got = {r["h"]: r["p"] for r in df.select("h", header_period_col("h").alias("p")).collect()}
    for v in vals:
        assert got[v] == header_period(v), v


COERCE = [
    ("12", 12.0), (" 12 ", 12.0), ("1e3", 1000.0), ("1d", None), ("1,000", None), ("nan", None),
    ("inf", math.inf), ("-Infinity", -math.inf), ("", None), (" 12", None), ("+.5", 0.5), ("5.", 5.0), ("abc", None),
]


@pytest.mark.parametrize("raw,expected", COERCE)
def test_safe_value(raw, expected):
    assert safe_value(raw) == expected


def test_to_double_column_matches(spark):
    from statsheet.functions.coerce import to_double

    df = spark.createDataFrame([(r,) for r, _ in COERCE], "raw string")
    got = {r["raw"]: r["v"] for r in df.select("raw", to_double("raw").alias("v")).collect()}
    for raw, expected in COERCE:
        assert got[raw] == expected, raw


def test_clean_string_integral_ids(spark):
    from pyspark.sql.types import DoubleType

    from statsheet.functions.coerce import clean_string, integral_check

    df = spark.createDataFrame([(12345678901.0,), (2.0,), (None,)], "x double")
    assert df.agg(integral_check("x").alias("ok")).first()["ok"] is True
    got = [r[0] for r in df.select(clean_string("x", DoubleType(), True)).collect()]
    assert got == ["12345678901", "2", None]


def test_headers():
    assert normalize_header("Of which: \nIRRBB - Internal model approach") == "Of which: IRRBB - Internal model approach"
    assert normalize_header("Foo\r\nBar") == "Foo Bar"
    assert normalize_header("  a   b ") == "a b"
    assert normalize_header(5) == 5
    assert disambiguate([None, "A", "A", "", "A"]) == ["Unnamed: 0", "A", "A.1", "Unnamed: 3", "A.2"]


def test_header_names_table_matches(spark):
    from statsheet.operators.reshape import header_names_table

    cells = [None, "A", "A", "", "Customer\nname", "A"]
    grid = spark.createDataFrame([("f", "s", 3, cells)], "source string, sheet string, row_idx long, cells array<string>")
    got = [r["name"] for r in header_names_table(grid, 3).orderBy("col_idx").collect()]
    assert got == disambiguate([normalize_header(c) for c in cells])


@pytest.mark.parametrize(
    "value,expected",
    [
        ("NSW", "New South Wales"), ("nsw", "New South Wales"), ("Queensland", "Queensland"), ("AU-VIC", "Victoria"),
        ("3000", "Victoria"), ("2600", "Australian Capital Territory"), ("2000", "New South Wales"),
        ("Tassie", "Tasmania"), ("0800", "Northern Territory"), ("Total Australia", None), ("12", None),
    ],
)
def test_states(value, expected):
    assert normalise_state(value) == expected


def test_state_column_matches(spark):
    from statsheet.functions.places import normalise_state_column

    vals = ["NSW", "nsw", "Queensland", "AU-VIC", "3000", "2600", "2000", "Tassie", "0800", "Total Australia", " vic ", "9999"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = {r["v"]: r["state"] for r in normalise_state_column(df, "v").collect()}
    for v in vals:
        assert got[v] == (normalise_state(v) or v), v


def test_filename_scores(spark):
    from statsheet.functions.links import filename_date_score

    cases = {
        "data-March-2026.xlsx": 202603,
        "data-Sept-2025.xlsx": 202509,
        "no_dates_here.xlsx": 0,
        "/files/2026-03/file.xlsx": 202603,
        "report 2019 final.xlsx": 201900,
        "archive 1890.xlsx": 0,
        "data_2024_13.xlsx": 0,
        "data 2024 13.xlsx": 202400,
        "December 2025 and 2024-06.xlsx": 202512,
    }
    df = spark.createDataFrame([(k,) for k in cases], "n string")
    got = {r["n"]: r["s"] for r in df.select("n", filename_date_score("n").alias("s")).collect()}
    assert got == cases


def test_absolute_url_and_names(spark):
    from statsheet.functions.links import absolute_url, decoded_file_name

    rows = [
        ("https://h.example/a/b/page?x=1", "/files/x.xlsx", "https://h.example/files/x.xlsx"),
        ("https://h.example/a/b/page", "x.xlsx", "https://h.example/a/b/x.xlsx"),
        ("https://h.example/a/b/page", "//cdn.example/y.xlsx", "https://cdn.example/y.xlsx"),
        ("https://h.example/a", "http://o.example/z.xlsx", "http://o.example/z.xlsx"),
    ]
    df = spark.createDataFrame(rows, "base string, href string, want string")
    for r in df.select("want", absolute_url("base", "href").alias("got")).collect():
        assert r["got"] == r["want"]
    names = spark.createDataFrame([("https://h/x/Quarterly%20Stats%20%28v2%29+final.xlsx",)], "u string")
    assert names.select(decoded_file_name("u")).first()[0] == "Quarterly Stats (v2)+final.xlsx"


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="0123456789-Qq ", max_size=9), st.sampled_from(["start", "end"]))
def test_expand_period_total(value, bound):
    out = expand_period(value, bound)
    assert out == value or isinstance(out, str)


def _py_filename_score(name: str) -> int:
    """Plain-Python statement of the C3 rule, for the property test below."""
    import re

    from statsheet.functions.links import BARE_YEAR_PATTERN, MONTH_NAME_PATTERN, MONTH_NUMBERS, YEAR_MONTH_PATTERN

    best = 0
    for m in re.finditer(MONTH_NAME_PATTERN, name):
        best = max(best, int(m.group(2)) * 100 + MONTH_NUMBERS[m.group(1).lower()])
    for m in re.finditer(YEAR_MONTH_PATTERN, name):
        y, mo = int(m.group(1)), int(m.group(2))
        if 1 <= mo <= 12 and 1990 <= y <= 2100:
            best = max(best, y * 100 + mo)
    if best == 0:
        for tok in re.findall(BARE_YEAR_PATTERN, name):
            if 1990 <= int(tok) <= 2100:
                best = max(best, int(tok) * 100)
    return best


_PIECES = st.sampled_from(
    ["March", "sept", "Sep", "dec", "December", "mayday", "jun", "2025", "1999", "2101", "12", "3", "13", "-", "_", "/", " ", ".xlsx", "x", "Q4", "0"]
)


@settings(max_examples=3, deadline=None)
@given(st.lists(st.lists(_PIECES, min_size=1, max_size=8).map("".join), min_size=150, max_size=150))
def test_filename_score_matches_python_rule(spark, names):
    from statsheet.functions.links import filename_date_score

    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, n string")
    got = {r["i"]: r["s"] for r in df.select("i", filename_date_score("n").alias("s")).collect()}
    for i, n in enumerate(names):
        assert got[i] == _py_filename_score(n), n


@settings(max_examples=3, deadline=None)
@given(st.lists(st.text(alphabet="0123456789-Qq x ", max_size=11), min_size=200, max_size=200))
def test_expand_period_column_matches_python_on_random_text(spark, values):
    from statsheet.functions.periods import expand_periods

    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    rows = {r["i"]: r for r in expand_periods(df, ["v"]).collect()}
    for i, v in enumerate(values):
        assert rows[i]["v_start"] == expand_period(v, "start"), repr(v)
        assert rows[i]["v_end"] == expand_period(v, "end"), repr(v)


@settings(max_examples=3, deadline=None)
@given(st.lists(st.text(alphabet="0123456789.eE+- \tinfa,d", max_size=10), min_size=200, max_size=200))
def test_to_double_matches_python_on_random_text(spark, values):
    from statsheet.functions.coerce import to_double

    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = {r["i"]: r["d"] for r in df.select("i", to_double("v").alias("d")).collect()}
    for i, v in enumerate(values):
        assert got[i] == safe_value(v), repr(v)


@settings(max_examples=2, deadline=None)
@given(st.lists(st.sampled_from(["nsw", "NSW ", " Vic", "AU-QLD", "au-tas", "Tassie", "Queensland", "new  south wales",
                                  "0800", "0899", "2600", "2619", "2920", "2921", "3000", "6798", "9999", "12345", "",
                                  "Total", "WA", "act"]), min_size=60, max_size=60))
def test_state_column_matches_python_on_random_spellings(spark, values):
    from statsheet.functions.places import normalise_state_column

    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = {r["i"]: r["state"] for r in normalise_state_column(df, "v").collect()}
    for i, v in enumerate(values):
        assert got[i] == (normalise_state(v) or v), repr(v)
