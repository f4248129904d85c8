"""Every registered query that has SQL gives the SQL's rows on the small tables."""

import glob
import math
import os

import duckdb
import pytest

from chronotally.plans import catalog

SF = "/root/testdata/sf0.001"
QUERIES, SQL = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from read_parquet('{path}')")
    return con


def plain(v):
    if v is None or isinstance(v, (bool, str, bytes)):
        return v
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
        return "nan" if math.isnan(v) else float(f"{float(v):.9g}")
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    found = duck.execute(SQL[name])
    columns = [c[0] for c in found.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, found.fetchall())


def test_all_queries_have_sql():
    assert set(QUERIES) == set(SQL)
