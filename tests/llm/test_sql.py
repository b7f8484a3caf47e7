"""The registered SQL of this subpackage in DuckDB against the queries in Spark."""

import os

import duckdb
import pytest

from tablewright.llm import catalog

SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_MID, t)}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_matches_sql(spark, con, name):
    got = catalog.QUERIES[name](spark, SF_MID)
    want = con.sql(catalog.SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    cols = sorted(got.columns)
    rows = sorted((tuple(r[c] for c in cols) for r in got.collect()), key=repr)
    at = [want.columns.index(c) for c in cols]
    assert rows == sorted((tuple(r[i] for i in at) for r in want.fetchall()), key=repr)
