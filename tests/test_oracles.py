"""Every query with SQL gives the rows that DuckDB gives on the same tables."""

import math
import os

import duckdb
import pytest

from wayweave.queries import ORACLES, QUERIES

ROOT = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9) + 0.0
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(ROOT):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from read_parquet('{ROOT}/{f}')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, duck, name):
    df = QUERIES[name](spark, ROOT)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    cur = duck.execute(ORACLES[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    want = sorted((tuple(plain(r[i]) for i in at) for r in cur.fetchall()), key=repr)
    assert got == want and got


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows(spark, name):
    assert QUERIES[name](spark, ROOT).count() > 0
