"""Every registered query against its DuckDB SQL on the smallest tables.

Order-insensitive comparison of the rows, with the columns sorted by name,
as the correctness gate does; doubles compared after rounding to 9 places.
"""

import importlib.util
import math
import os

import duckdb
import pytest

from conftest import ROOT, SF_SMALL
from statsheet.plans.verification import REGISTRY

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _entry():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    m = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(m)
    return m


ENTRY = _entry()
NAMES = sorted(REGISTRY)


def _norm(v):
    if v is None:
        return "<null>"
    if isinstance(v, float):
        return "<null>" if math.isnan(v) else repr(round(v, 9))
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    try:
        import pandas as pd

        if pd.isna(v):
            return "<null>"
    except (TypeError, ValueError):
        pass
    return str(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = ENTRY.entry(spark)
    assert df.count() >= 0 and "value" in df.columns


def test_every_query_has_sql_or_is_rows_only():
    assert set(NAMES) <= set(ENTRY.oracle_sql()) and set(NAMES) <= set(ENTRY.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = ENTRY.queries()[name](spark, SF_SMALL)
    rows = df.collect()
    sql = ENTRY.oracle_sql().get(name)
    if sql is None:
        assert df.columns
        return
    odf = con.execute(sql).df()
    assert sorted(df.columns) == sorted(odf.columns)
    cols = sorted(df.columns)
    got = sorted(tuple(_norm(r[c]) for c in cols) for r in rows)
    want = sorted(tuple(_norm(x) for x in t) for t in odf[cols].itertuples(index=False, name=None))
    assert len(got) == len(want)
    assert got == want
