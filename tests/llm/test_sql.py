"""Queries against their SQL."""

from __future__ import annotations

import duckdb
import pytest

from trailmark.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(name, spark, sf_dir):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    result = con.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    got = QUERIES[name](spark, sf_dir)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(tuple(r) for r in got.select(*columns).collect()) == sorted(result.fetchall())
