"""The queries that SQL can state, against DuckDB on the smallest tables."""

import duckdb
import pytest
from statsheet.llm.queries import REGISTRY, SQL


def _plain(v):
    return int(v) if hasattr(v, "dtype") and v.dtype.kind in "iu" else v


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, root, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{root}/{t}.parquet')")
    df = REGISTRY[name](spark, root)
    cols = sorted(df.columns)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({SQL[name]})").fetchall()
    got = [tuple(r[c] for c in cols) for r in df.collect()]
    key = lambda r: tuple((v is not None, v) for v in r)
    assert got and sorted(got, key=key) == sorted(want, key=key)
