"""Every registered query against its DuckDB oracle on the smallest scale."""

import hashlib
import math

import duckdb
import pytest
from conftest import SF_SMALL

import __spark_entry__ as entry
from tradelens.plans.registry import QUERIES

TABLES = ["orders"]


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, float):
        return repr(round(v, 9))
    return str(v)


def _digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha256("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.oracle_sql())
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    sdf = entry.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    res = duck.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert len(srows) == len(orows)
    assert sorted(sdf.columns) == sorted(ocols)
    assert _digest(srows, sdf.columns) == _digest(orows, ocols)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() == 64
