"""Every query with SQL gives what DuckDB gives on the smallest tables; every other one runs."""

import datetime
import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"


def norm(v):
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return round(v, 6) + 0.0 if isinstance(v, float) else tuple(map(norm, v)) if isinstance(v, (list, tuple)) else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for f in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM read_parquet('{f}')")
    return con


CORE = [name for module in entry.MODULES for name in module.QUERIES]


@pytest.mark.skipif(not os.path.exists(DATA), reason="no tables")
@pytest.mark.parametrize("name", CORE)
def test_query(spark, duck, name):
    rows = entry.queries()[name](spark, DATA)
    got = rows.collect()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return
    found = duck.execute(sql)
    columns = [c[0] for c in found.description]
    assert sorted(columns) == sorted(rows.columns)
    order = sorted(columns)
    wanted = sorted((tuple(norm(r[columns.index(c)]) for c in order) for r in found.fetchall()), key=repr)
    assert sorted((tuple(norm(r[c]) for c in order) for r in got), key=repr) == wanted
