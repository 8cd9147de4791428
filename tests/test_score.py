"""Score table (FIXTURES F5) and score properties."""

from __future__ import annotations

import math

from hypothesis import given, settings
from hypothesis import strategies as st

from sleeper.config import ScoreParams
from sleeper.operators.score import score_items

# name, pos, tot, price, quality, obscurity, price_score, score, tier  (max total = 1000)
F5 = [
    ("free", 95, 100, 0.0, 0.95, 0.9, 1.0, 0.9450, "S"),
    ("most reviewed", 800, 1000, 30.0, 0.8, 0.0, 0.5, 0.5000, "B"),
    ("middle", 450, 500, 12.0, 0.9, 0.5, 0.8, 0.7600, "A"),
    ("no reviews", 0, 0, 60.0, 0.0, 1.0, 0.0, 0.3000, "B"),
    ("over cap", 90, 100, 75.0, 0.9, 0.9, 0.0, 0.7200, "A"),
    ("price missing", 99, 100, None, 0.99, 0.9, 0.0, 0.7650, "A"),
    ("pos missing", None, 50, 10.0, None, 0.95, 1 - 10 / 60, None, "B"),
    ("edge S", 500, 500, 0.0, 1.0, 0.5, 1.0, 0.8500, "S"),
    ("edge A", 400, 500, 15.0, 0.8, 0.5, 0.75, 0.7000, "A"),
]


def close(a, b):
    return (a is None and b is None) or (a is not None and b is not None and math.isclose(a, b, abs_tol=1e-12))


def test_score_table(spark):
    df = spark.createDataFrame([(i, r[1], r[2], r[3]) for i, r in enumerate(F5)],
                               "appid long, resenas_positivas int, total_resenas int, precio double")
    got = {r["appid"]: r for r in score_items(df, ScoreParams()).collect()}
    for i, (name, _p, _t, _pr, q, o, ps, s, tier) in enumerate(F5):
        r = got[i]
        assert close(r["quality_score"], q), name
        assert close(r["obscurity_score"], o), name
        assert close(r["price_score"], ps), name
        assert close(r["hidden_gem_score"], s), name
        assert r["tier"] == tier, name


def test_score_by_run_uses_each_runs_max(spark):
    df = spark.createDataFrame([(1, 1, 10, 10, 0.0), (2, 1, 5, 5, 0.0), (1, 2, 40, 40, 0.0)],
                               "appid long, run int, resenas_positivas int, total_resenas int, precio double")
    got = {(r["appid"], r["run"]): r["obscurity_score"] for r in score_items(df, by=["run"]).collect()}
    assert got == {(1, 1): 0.0, (2, 1): 0.5, (1, 2): 0.0}


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1000), st.integers(0, 1000), st.floats(0, 200)), min_size=1, max_size=12))
def test_score_in_unit_interval(spark, items):
    data = [(i, min(p, t), t, pr) for i, (p, t, pr) in enumerate(items)]
    df = spark.createDataFrame(data, "appid long, resenas_positivas int, total_resenas int, precio double")
    for r in score_items(df).collect():
        assert 0.0 <= r["hidden_gem_score"] <= 1.0
        assert r["tier"] in ("S", "A", "B")


def test_score_by_run_keeps_rows_without_a_run(spark):
    df = spark.createDataFrame([(1, None, 10, 10, 0.0), (2, None, 5, 5, 0.0), (3, 7, 4, 4, 0.0)],
                               "appid long, run int, resenas_positivas int, total_resenas int, precio double")
    got = {r["appid"]: r["obscurity_score"] for r in score_items(df, by=["run"]).collect()}
    assert got == {1: 0.0, 2: 0.5, 3: 0.0}
