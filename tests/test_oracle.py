"""Every registered query that has SQL, against DuckDB on the small tables."""

import math
import os

import pytest

import __spark_entry__ as entry

duckdb = pytest.importorskip("duckdb")
QUERIES, SQL = entry.queries(), entry.oracle_sql()


def plain(v):
    if isinstance(v, float) or hasattr(v, "quantize"):
        return "nan" if math.isnan(float(v)) else repr(round(float(v), 5) + 0.0)
    return str(v)


@pytest.fixture(scope="module")
def views(small):
    c = duckdb.connect()
    c.execute("set timezone = 'UTC'")
    for f in os.listdir(small):
        c.execute(f"create view {f.removesuffix('.parquet')} as select * from '{small}/{f}'")
    return c


def test_sql_names_are_queries():
    assert not set(SQL) - set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, small, views, name):
    df = QUERIES[name](spark, small)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    cursor = views.execute(SQL[name])
    names = [x[0] for x in cursor.description]
    assert sorted(names) == columns
    want = sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in cursor.fetchall())
    assert got == want


@pytest.mark.parametrize("name", sorted(n for n in set(QUERIES) - set(SQL) if not n.startswith("p") or not n[1].isdigit()))
def test_runs(spark, small, name):
    assert QUERIES[name](spark, small).collect() is not None


def test_entry(spark):
    assert entry.entry(spark).columns == ["yr", "ALL", "AEs", "EMDEs", "LICs"]
