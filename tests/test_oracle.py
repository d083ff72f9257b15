"""Every registered query against its DuckDB statement on the small supplied tables."""

import datetime as dt
import decimal
import os

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from innflow.oracle import ORACLE_SQL
from innflow.plans.catalog import QUERIES

TABLES = "region nation customer supplier part orders lineitem".split()


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f") if v == v.to_integral_value() else format(v, "f").rstrip("0")
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return "∅" if v is None else str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t)}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL) <= set(entry.oracle_sql())
    assert len(QUERIES) >= 40
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    res = duck.execute(entry.oracle_sql()[name])
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert _rows(s_cols, s_rows) == _rows(d_cols, d_rows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "total_revenue" in df.columns
