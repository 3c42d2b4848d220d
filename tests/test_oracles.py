"""Every registered query against its SQL counterpart on the driver tables."""

from __future__ import annotations

import glob
import math
import os

import duckdb
import pytest

from oracle_queries import ORACLES
from trailmark.plans.catalog import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _key(row):
    return tuple((v is None, str(v)) for v in row)


def _same(a, b):
    if isinstance(a, float) or isinstance(b, float):
        return a == b or (a is not None and b is not None and math.isclose(a, b, rel_tol=1e-12))
    return type(a) is type(b) and a == b


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(name, spark, sf_dir, duck):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(*columns).collect()), key=_key)
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    want = sorted((tuple(row[i] for i in order) for row in result.fetchall()), key=_key)
    assert len(got) == len(want)
    assert got, "no rows to compare"
    for g, w in zip(got, want):
        assert all(_same(a, b) for a, b in zip(g, w)), (g, w)
