"""Every registered query of the reference's operators against its SQL, on the smallest tables."""

import datetime
import decimal
import os

import duckdb
import pytest

from trawl import catalog

SF = "/root/testdata/sf0.001"
SQL = catalog.oracle_sql()


def plain(x):
    if isinstance(x, float) or (isinstance(x, decimal.Decimal) and x != int(x)):
        return f"{float(x):.9g}"
    if isinstance(x, (int, decimal.Decimal)) and not isinstance(x, bool):
        return f"{float(int(x)):.9g}"
    return x.isoformat() if isinstance(x, (datetime.datetime, datetime.date)) else str(x)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, con, name):
    df = catalog.queries()[name](spark, SF)
    rows = sorted([plain(r[c]) for c in sorted(df.columns)] for r in df.collect())
    if name in SQL:
        r = con.execute(SQL[name])
        columns = [c[0] for c in r.description]
        assert sorted(columns) == sorted(df.columns)
        at = [columns.index(c) for c in sorted(columns)]
        assert rows == sorted([plain(x[i]) for i in at] for x in r.fetchall())
    else:
        assert rows
