from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest
from llm_support import CLASH, SF_SMALL, make  # noqa: F401

from sleeper.llm import queries
from sleeper.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows):
    """Exact whole numbers and covariance by fractions, eigenvectors by numpy."""
    x = [[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in rows]
    n, dim = len(x), len(x[0])
    s = [sum(r[j] for r in x) for j in range(dim)]
    z = [[Fraction(n * r[j] - s[j], n) for j in range(dim)] for r in x]
    cov = np.array([[float(sum(r[i] * r[j] for r in z) / n) for j in range(dim)] for i in range(dim)])
    e, u = np.linalg.eigh(cov)
    return n, [sum((n * r[j] - s[j]) ** 2 for j in range(dim)) for r in x], np.array(z, float), cov, e[::-1], u[:, ::-1]


def test_query_matches_brute_force(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()
    n, deviation, z, cov, e, u = brute([r["embedding"] for r in rows])
    got = queries.op11_cholesky_jacobi_whitening(spark, SF_SMALL).toPandas()
    assert len(got) == 32 * n and set(got["n"]) == {n}
    wide = got.pivot(index="vec_id", columns="component", values="whitened").loc[[r["vec_id"] for r in rows]].to_numpy()
    want = z @ u[:, :32] / np.sqrt(e[:32])
    signs = np.sign((want * wide).sum(0))
    assert np.abs(wide - want * signs).max() < 1e-8
    assert got.groupby("component")["explained"].first().to_list() == pytest.approx((e / np.trace(cov))[:32], rel=1e-9)
    dev = got.groupby("vec_id")["deviation"].agg(["min", "max"])
    assert (dev["min"] == dev["max"]).all() and dev["min"].loc[[r["vec_id"] for r in rows]].to_list() == deviation
    error = np.abs(np.cov(wide.T, bias=True) - np.eye(32)).max()
    assert got["identity_error"].nunique() == 1 and got["identity_error"].iloc[0] < 1e-9 and error < 1e-9


@pytest.mark.parametrize("dim", [1, 2, 5, 12, 33])
def test_factor_and_rotations(dim):
    rng = np.random.default_rng(dim)
    a = rng.normal(size=(dim, 3 * dim)) * np.logspace(0, -4, dim)[:, None]
    cov = a @ a.T
    low, order = W.pivoted_cholesky(cov)
    assert np.allclose(low @ low.T, cov[order][:, order], rtol=0, atol=1e-13 * np.abs(cov).max())
    assert np.allclose(low, np.tril(low))
    e, u = W.eigen(cov)
    assert e == pytest.approx(np.linalg.eigvalsh(cov)[::-1], rel=1e-8)
    assert np.allclose(u.T @ u, np.eye(dim), atol=1e-13) and np.allclose(cov @ u, u * e, atol=1e-12 * e[0])


def test_rank_deficient_and_equal_eigenvalues():
    e, u = W.eigen(np.diag([4.0, 0.0, 4.0]))
    assert e.tolist() == [4, 4] and np.allclose(u.T @ u, np.eye(2))
    assert len(W.eigen(np.zeros((3, 3)))[0]) == 0
    v = np.arange(1.0, 5)[:, None]
    e, u = W.eigen(v @ v.T)
    assert len(e) == 1 and e[0] == pytest.approx(30)


def test_odd_rows(spark, make):
    nan, inf = float("nan"), float("inf")
    odd = [(1, None), (2, []), (3, [None, 1.0, 2.0]), (4, [nan, 0.0, 0.0]), (5, [0.0, inf, 0.0]), (6, [1.0, 2.0]),
           (7, [3e38, 0.0, 0.0])]
    fine = [(10, [1.0, 2.0, -3.0]), (10, [1.0, 2.0, -3.0]), (None, [0.5, 0.25, 4.0]), (12, [-1.0, 0.0, 2.0])]
    df = make([(i, v, *["z"] * 13) for i, v in odd + fine], f"{SCHEMA}, {CLASH}")
    model = W.fit(df)
    n, deviation, z, cov, e, u = brute([v for _, v in fine])
    assert (model.n, model.dim) == (4, 3) and model.eigenvalues == pytest.approx(e[:len(model.eigenvalues)], rel=1e-9)
    got = W.whiten(df, model).collect()
    assert sorted((str(r["vec_id"]), int(r["deviation"])) for r in got) == sorted(
        (str(i), d) for (i, _), d in zip(fine, deviation))
    assert W.identity_error(df, model) < 1e-9
    for rows in ([], odd[:1]):
        empty = make(rows, SCHEMA)
        assert W.fit(empty) is None and W.whiten(empty, None).collect() == [] and W.identity_error(empty, None) is None
    same = make([(1, [2.0, 2.0])] * 5, SCHEMA)
    model = W.fit(same)
    assert [r["whitened"] for r in W.whiten(same, model).collect()] == [[]] * 5 and W.identity_error(same, model) is None


def test_large_offsets_keep_their_precision(spark, make):
    """Means far from zero and sums beyond a long: nothing is multiplied before it is centred."""
    rng = np.random.default_rng(1)
    rows = (rng.normal(size=(200, 4)) + 2.0 ** 40).tolist()
    df = make([(i, v) for i, v in enumerate(rows)], "vec_id long, embedding array<double>")
    model = W.fit(df)
    n, deviation, z, cov, e, u = brute(rows)
    assert model.eigenvalues == pytest.approx(e, rel=1e-9)
    assert {r["vec_id"]: int(r["deviation"]) for r in W.whiten(df, model).collect()} == dict(enumerate(deviation))
    assert W.identity_error(df, model) < 1e-9


def test_long_vectors(spark, make):
    rng = np.random.default_rng(2)
    df = make([(i, v) for i, v in enumerate(rng.normal(size=(64, 300)).tolist())], "vec_id long, embedding array<double>")
    model = W.fit(df)
    assert len(model.eigenvalues) == 63 and W.identity_error(df, model, components=63) < 1e-6
