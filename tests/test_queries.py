"""Every registered query against its DuckDB oracle on the smallest fixture."""

import datetime as dt
import decimal

import duckdb
import pytest

import __spark_entry__ as E
from loadworks.plans import catalog
from loadworks.plans.registry import ALL_TABLES
from loadworks.session import scratch_scope

QUERIES = catalog.QUERIES  # the optional queries have tests of their own
ORACLE = catalog.ORACLE


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v).lower()
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f")
    if isinstance(v, float):
        return repr(round(v, 9))
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(cols), sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in ALL_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "valid_to" in df.columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, sf, duck, name):
    with scratch_scope(spark):
        df = QUERIES[name](spark, sf)
        got = _canon(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(ORACLE[name])
    want = _canon([d[0] for d in res.description], res.fetchall())
    assert got[0] == want[0]
    assert got[1] == want[1]
