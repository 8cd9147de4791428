"""Every registered query against its DuckDB oracle on the smallest driver data."""

from __future__ import annotations

import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from sleeper.plans import queries
from sleeper.plans.workload import TABLES

from conftest import SF_SMALL


def _norm(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _sorted(rs):
    return sorted((tuple(_norm(v) for v in r) for r in rs), key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


OWN = sorted(queries.registry())


def test_every_query_has_an_oracle():
    assert set(OWN) <= set(E.queries())
    assert set(OWN) <= set(E.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "hidden_gem_score" in df.columns


@pytest.mark.parametrize("name", OWN)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = _sorted(tuple(r[c] for c in cols) for r in df.collect())
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(dcols) == cols
    idx = [dcols.index(c) for c in cols]
    want = _sorted(tuple(r[i] for i in idx) for r in res.fetchall())
    assert got == want
