"""Every registered query against its DuckDB oracle (the driver's check),
on the smallest data set."""

import datetime as dt
import decimal
import os

import duckdb
import pytest

import __spark_entry__ as E
from carepulse.plans import registry

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
#: The library's own queries; those of the corpus operators have their tests in tests/llm.
QUERIES = {k: q for k, q in E.queries().items() if k in registry.REGISTRY}
SQL = {k: q for k, q in E.oracle_sql().items() if k in registry.REGISTRY}


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = sorted((tuple(_norm(r[i]) for i in order) for r in rows),
                 key=lambda t: tuple((x is None, str(x)) for x in t))
    return [cols[i] for i in order], out


@pytest.fixture(scope="module")
def duck(small_sf):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{small_sf}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, small_sf, name):
    df = QUERIES[name](spark, small_sf)
    s_cols, s_rows = _canon(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(SQL[name])
    d_cols, d_rows = _canon([d[0] for d in cur.description], cur.fetchall())
    assert s_cols == d_cols
    assert s_rows == d_rows


@pytest.mark.parametrize("name", ["test_unique_combination", "test_relationships", "fanout_guard"])
def test_fixtures_give_the_checks_something_to_find(spark, small_sf, name):
    rows = QUERIES[name](spark, small_sf).collect()
    assert any((r.asDict().get("FAILURES") or r.asDict().get("N") or 0) > 0 for r in rows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["LA_NAME", "SOURCE_SYSTEM", "QUERY_COUNT_RAW", "TIME_WINDOW_MONTHS"]
