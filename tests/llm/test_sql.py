"""The corpus queries that SQL can express, against DuckDB on the smallest tables."""

import duckdb
import pytest

from carepulse.llm.queries import QUERIES
from carepulse.llm.sql import SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, small_sf, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{small_sf}/{t}.parquet')")
    got = QUERIES[name](spark, small_sf)
    cols = sorted(got.columns)
    want = con.sql(f"SELECT {', '.join(cols)} FROM ({SQL[name]})").fetchall()
    assert sorted(map(tuple, got.select(cols).collect()), key=str) == sorted(want, key=str)
