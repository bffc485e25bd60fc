"""Each registered query against its SQL twin in DuckDB on the smallest tables; queries without one must run and return rows."""

import datetime
import decimal
import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from folioframe.plans import catalog

SF = os.environ.get("FOLIO_SF", "/root/testdata/sf0.001")
QUERIES, SQL = catalog.queries(), catalog.oracle_sql()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def _cell(x):
    if isinstance(x, (float, decimal.Decimal)):
        return f"{float(x):.5g}"
    if isinstance(x, (datetime.datetime, datetime.date)):
        return str(x)
    return repr(x)


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    rows = df.collect()
    if name not in SQL:
        assert rows
        return
    got = duck.execute(SQL[name])
    columns = [d[0] for d in got.description]
    assert sorted(columns) == sorted(df.columns)
    want = _bag(columns, got.fetchall())
    mine = _bag(df.columns, rows)
    assert len(mine) == len(want) and mine == want, [(a, b) for a, b in zip(mine, want) if a != b][:3]


def test_entry_points(spark):
    assert set(SQL) <= set(QUERIES) and set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
