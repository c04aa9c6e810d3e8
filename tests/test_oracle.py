"""Every registered query against its DuckDB oracle on sf0.001 (as the driver does on sf0.01)."""

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as E

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = []
    for r in rows:
        t = []
        for i in order:
            v = r[i]
            if isinstance(v, float):
                v = None if math.isnan(v) else repr(v)
            elif isinstance(v, (dt.datetime, dt.date)):
                v = v.isoformat()
            t.append(v)
        out.append(repr(tuple(t)))
    return sorted(out)


@pytest.fixture(scope="module")
def con(sf_small):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.QUERIES))
def test_query_matches_oracle(spark, con, sf_small, name):
    df = E.queries()[name](spark, sf_small)
    rows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert rows, "approximate query returned nothing"
        return
    cur = con.execute(sql)
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert _norm(rows, df.columns) == _norm(orows, ocols)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "__time" in df.columns
