"""Every core query with SQL against DuckDB on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from tidemark.plans import catalog

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


def plain(frame):
    import pandas as pd

    def value(v):
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
            return "null"
        if isinstance(v, float):
            return str(int(v)) if v == int(v) else f"{v:.5g}"
        return str(v).replace(" 00:00:00", "")

    return sorted(tuple(map(value, r)) for r in frame[sorted(frame.columns)].itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(DATA):
        if f.endswith(".parquet"):
            con.sql(f"create view {f[:-8]} as select * from '{DATA}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, duck, name):
    got = catalog.queries()[name](spark, DATA).toPandas()
    sql = catalog.oracle_sql().get(name)
    if sql:
        want = duck.sql(sql).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert plain(got) == plain(want)


def test_entry(spark):
    assert entry.entry(spark).columns == ["character", "chapters", "volumes", "first_chapter", "last_chapter"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
