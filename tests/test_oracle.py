"""Every registered query against its DuckDB oracle on sf0.001 (the driver's gate)."""

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as E
from cartwheel.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = ["events", "part", "documents", "pages", "embeddings"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


SQL = E.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(SQL[name])
    want = _rows(rel.columns, rel.fetchall())
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(got) == len(want)
    assert got == want


def test_every_query_has_an_oracle():
    assert set(registry.QUERIES) == set(registry.ORACLE_FINAL)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "session_to_payment_cr" in df.columns
