"""Whitening of embeddings: pivoted Cholesky of the centred scatter, then one-sided
Jacobi on the triangular factor.

Entries become whole numbers ``floor(scale * c) + offset``. Each task reduces its
vectors to a count, exact sums and a scatter about its own mean; these are merged
about the exact mean of all (nothing is multiplied before it is centred). What
reaches the driver is one covariance matrix, whose size is that of a vector and
not of the data. There the covariance is factored as ``L L'`` with pivoting, and
pairs of the factor's columns are rotated until all are orthogonal: their squared
norms are the eigenvalues, their directions the components.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sleeper.llm.common import keep, map_batches
from sleeper.llm.vectors import finite_vectors

SCALE, OFFSET = 64, 1_000_000
#: Rows that are multiplied at once in a task.
ROWS = 4096
_EPS = np.finfo(np.float64).eps


@dataclass(frozen=True)
class Whitening:
    """What whitens a vector; components are columns, by falling eigenvalue."""

    n: int
    sums: tuple[int, ...]       # of the whole numbers, per dimension
    eigenvalues: np.ndarray
    components: np.ndarray
    trace: float

    @property
    def dim(self) -> int:
        return len(self.sums)

    def explained(self) -> list[float]:
        return [float(e / self.trace) for e in self.eigenvalues]


def whole(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows, ``floor(SCALE * c)`` of their entries): rows whose entries doubles hold exactly. OFFSET
    is added to sums only, so that products stay small."""
    y = np.floor(SCALE * matrix)
    good = np.flatnonzero((np.abs(y) < 2.0 ** 53).all(axis=1))
    return good, y[good]


class Moments:
    """Count, exact sums, mean and scatter about the mean of the rows it was given. Whole numbers
    are taken relative to the first row, so that ``mean`` keeps its fraction."""

    def __init__(self, dim: int, exact: bool):
        self.n, self.mean, self.scatter = 0, np.zeros(dim), np.zeros((dim, dim))
        self.sums, self.first = ([0] * dim if exact else None), None

    def add(self, rows: np.ndarray) -> None:
        m = len(rows)
        if self.sums is not None:
            self.sums = [a + int(b) for a, b in zip(self.sums, _exact_sums(rows))]
            self.first = rows[0].copy() if self.first is None else self.first
            rows = rows - self.first
        mean = rows.mean(axis=0)
        z = rows - mean
        apart = mean - self.mean
        total = self.n + m
        self.scatter += z.T @ z + np.outer(apart, apart) * (self.n * m / total)
        self.mean = self.mean + apart * (m / total)
        self.n = total


def _exact_sums(rows: np.ndarray):
    if len(rows) and np.abs(rows).max() * len(rows) >= 2.0 ** 62:
        return rows.astype(object).sum(axis=0)
    return rows.astype(np.int64).sum(axis=0)


def _partials(rows: DataFrame, exact: bool, matrix_of) -> DataFrame:
    """One row per task and vector length: (dim, n, sums, mean, scatter above the diagonal, by rows)."""

    def run(batches):
        found: dict[int, Moments] = {}
        for b in batches:
            for m in matrix_of(b):
                if len(m):
                    found.setdefault(m.shape[1], Moments(m.shape[1], exact)).add(m)
        for dim, f in found.items():
            yield pa.RecordBatch.from_arrays([
                pa.array([dim], pa.int32()), pa.array([f.n], pa.int64()),
                pa.array([[Decimal(s) for s in f.sums or []]], pa.list_(pa.decimal128(38, 0))),
                pa.array([f.mean]), pa.array([f.scatter[np.triu_indices(dim)]], pa.list_(pa.float64()))],
                ["dim", "n", "sums", "mean", "scatter"])

    schema = "dim int, n long, sums array<decimal(38,0)>, mean array<double>, scatter array<double>"
    return map_batches(rows, run, schema, ROWS)


def _covariance(partials: DataFrame, dim: int, n: int, mean: np.ndarray, sums: list[int] | None = None) -> np.ndarray:
    """The partial scatters, moved to the mean of all rows and summed entry by entry, over ``n``. With
    exact ``sums`` of all rows the distances of the means are exact before they are rounded."""
    upper = np.triu_indices(dim)

    def moved(batches):
        total = None
        for b in batches:
            for count, m, s, own in zip(*(b[c].to_pylist() for c in ("n", "mean", "scatter", "sums"))):
                apart = np.array(m) - mean if sums is None else np.array(
                    [float(Fraction(int(x), count) - Fraction(t, n)) for x, t in zip(own, sums)])
                s = np.array(s) + count * np.outer(apart, apart)[upper]
                total = s if total is None else total + s
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["entry", "value"])

    entries = map_batches(partials.where(F.col("dim") == dim).select("n", "mean", "scatter", "sums"), moved,
                          "entry long, value double", 64)
    got = entries.groupBy("entry").agg(F.sum("value").alias("value")).toPandas()  # one matrix
    v = np.zeros(dim * (dim + 1) // 2)
    v[got["entry"].to_numpy()] = got["value"].to_numpy()
    cov = np.zeros((dim, dim))
    cov[upper] = v / n
    return cov + np.triu(cov, 1).T


def pivoted_cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(L, order) with ``a[order][:, order] = L L'``, the largest remaining diagonal first, up to
    the numerical rank."""
    d = len(a)
    order, left, low = np.arange(d), np.diag(a).copy(), np.zeros((d, d))
    floor = d * _EPS * max(left.max(initial=0.0), 0.0)
    for k in range(d):
        p = k + int(np.argmax(left[k:]))
        if left[p] <= floor:
            return low[:, :k], order
        for x in (order, left, low):
            x[[k, p]] = x[[p, k]]
        low[k, k] = np.sqrt(left[k])
        low[k + 1:, k] = (a[order[k + 1:], order[k]] - low[k + 1:, :k] @ low[k, :k]) / low[k, k]
        left[k + 1:] -= low[k + 1:, k] ** 2
    return low, order


def _rounds(r: int):
    """Pairings of ``r`` columns in which every two meet once: (left, right) index arrays."""
    ring = list(range(r)) + ([-1] if r % 2 else [])
    for _ in range(len(ring) - 1):
        half = len(ring) // 2
        pairs = [(a, b) for a, b in zip(ring[:half], reversed(ring[half:])) if a >= 0 and b >= 0]
        yield np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs])
        ring = [ring[0], ring[-1], *ring[1:-1]]


def one_sided_jacobi(g: np.ndarray, sweeps: int = 100) -> np.ndarray:
    """``g`` times rotations, its columns orthogonal to working precision. Disjoint pairs of columns
    are rotated together."""
    g = g.copy()
    pairings = list(_rounds(g.shape[1])) if g.shape[1] > 1 else []
    close = _EPS * np.sqrt(max(len(g), 1))
    for _ in range(sweeps):
        turned = False
        for p, q in pairings:
            a, b = g[:, p], g[:, q]
            aa, bb, ab = (a * a).sum(0), (b * b).sum(0), (a * b).sum(0)
            far = np.abs(ab) > close * np.sqrt(aa * bb)
            if not far.any():
                continue
            turned = True
            zeta = (bb - aa)[far] / (2 * ab[far])
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            c = 1 / np.hypot(1.0, t)
            s = c * t
            g[:, p[far]], g[:, q[far]] = c * a[:, far] - s * b[:, far], s * a[:, far] + c * b[:, far]
        if not turned:
            break
    return g


def eigen(cov: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, components as columns) of a covariance, by falling eigenvalue, those that
    are zero to working precision left out. The largest entry of each component is positive."""
    low, order = pivoted_cholesky(cov)
    turned = one_sided_jacobi(low)
    norms = np.sqrt((turned * turned).sum(0))
    by = np.argsort(-norms, kind="stable")
    by = by[norms[by] ** 2 > len(cov) * _EPS * (norms.max(initial=0.0) ** 2)]
    unit = np.zeros((len(cov), len(by)))
    unit[order] = turned[:, by] / norms[by]
    signs = np.sign(unit[np.abs(unit).argmax(axis=0), np.arange(len(by))]) if len(by) else np.ones(0)
    return norms[by] ** 2, unit * signs


def fit(df: DataFrame, vec_col: str = "embedding") -> Whitening | None:
    """The whitening of all usable vectors of ``df`` (see :func:`whiten`); None if there are none.

    Vectors of unlike lengths can't be whitened together: the length that most
    vectors have counts (of equally frequent ones the largest).
    """
    def matrix_of(b):
        return (whole(m)[1] for _, m in finite_vectors(b["v"]))

    partials = keep(_partials(df.select(F.col(vec_col).alias("v")), True, matrix_of), "whitening_moments")
    sizes = partials.groupBy("dim").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("dim")).first()
    if sizes is None:
        return None
    dim, n = sizes["dim"], sizes["n"]
    mine = partials.where(F.col("dim") == dim)
    got = mine.select(F.posexplode("sums").alias("i", "s")).groupBy("i").agg(F.sum("s").alias("s")).collect()
    sums = [0] * dim
    for r in got:  # one row a dimension
        sums[r["i"]] = int(r["s"])
    cov = _covariance(partials, dim, n, np.zeros(dim), sums)
    values, components = eigen(cov)
    return Whitening(n, tuple(s + n * OFFSET for s in sums), values, components, float(np.trace(cov)))


def _projection(model: Whitening, components: int):
    """Function from whole numbers (without OFFSET) to whitened coordinates."""
    near = np.array([round(Fraction(s, model.n)) - OFFSET for s in model.sums], np.float64)
    rest = np.array([float(Fraction(s, model.n) - round(Fraction(s, model.n))) for s in model.sums])
    basis = model.components[:, :components] / np.sqrt(model.eigenvalues[:components])
    return lambda y: ((y - near) - rest) @ basis


def _deviations(y: np.ndarray, model: Whitening) -> pa.Array:
    """Exact sums of ``(n*x - S)**2`` over the dimensions."""
    sums = [s - model.n * OFFSET for s in model.sums]
    bound = model.n * float(np.abs(y).max(initial=0)) + max(map(abs, sums), default=0)
    if len(sums) * bound * bound < 2.0 ** 62:
        d = model.n * y.astype(np.int64) - np.array(sums, np.int64)
        return pa.array((d * d).sum(axis=1)).cast(pa.decimal128(38, 0))
    d = model.n * np.vectorize(int, otypes=[object])(y) - np.array(sums, object)
    return pa.array([Decimal(int(x)) for x in (d * d).sum(axis=1)], pa.decimal128(38, 0))


def whiten(df: DataFrame, model: Whitening | None, components: int = 32, id_col: str = "vec_id",
           vec_col: str = "embedding") -> DataFrame:
    """(vec_id, deviation, whitened): each usable vector in whitened coordinates, ``deviation`` being the exact
    sum over dimensions of ``(n*x - S)**2``.

    Null and empty vectors, vectors with null or non-finite entries, with entries beyond
    ``2**53 / SCALE`` (doubles hold no whole numbers exactly there) or of another
    length than the model's give no row. Components whose variance is zero to working
    precision are left out, so ``whitened`` may be shorter than ``components``, and empty
    where all vectors are equal. Repeated rows and tied vectors are each a row and
    counted as often as they occur; between equal eigenvalues any basis of their
    space may come out, the same for all rows. A null id stays null. No vectors, no
    rows; other columns are not read. Vectors may be as long as a matrix of length by length
    fits in the driver and in a task.
    """
    schema = "vec_id long, deviation decimal(38,0), whitened array<double>"
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("v"))
    if model is None:
        return rows.select("vec_id", F.lit(None).cast("decimal(38,0)").alias("deviation"),
                           F.array().cast("array<double>").alias("whitened")).where(F.lit(False))
    project = _projection(model, components)

    def run(batches):
        for b in batches:
            for at, m in finite_vectors(b["v"]):
                if m.shape[1] != model.dim:
                    continue
                good, y = whole(m)
                w = project(y)
                ends = pa.array(np.arange(len(w) + 1, dtype=np.int32) * w.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [b["vec_id"].take(pa.array(at[good])), _deviations(y, model),
                     pa.ListArray.from_arrays(ends, pa.array(w.ravel()))], ["vec_id", "deviation", "whitened"])

    return map_batches(rows, run, schema, ROWS)


def identity_error(df: DataFrame, model: Whitening | None, components: int = 32,
                   vec_col: str = "embedding") -> float | None:
    """The largest entry, in size, of the whitened vectors' covariance minus the identity, measured over all of them."""
    if model is None or not len(model.eigenvalues):
        return None
    project = _projection(model, components)

    def matrix_of(b):
        return (project(whole(m)[1]) for _, m in finite_vectors(b["v"]) if m.shape[1] == model.dim)

    partials = keep(_partials(df.select(F.col(vec_col).alias("v")), False, matrix_of), "whitened_moments")
    k = min(components, len(model.eigenvalues))
    got = partials.select(F.posexplode("mean").alias("i", "m"), "n").groupBy("i").agg(
        F.sum(F.col("m") * F.col("n")).alias("s")).collect()
    mean = np.zeros(k)
    for r in got:  # one row a component
        mean[r["i"]] = r["s"] / model.n
    return float(np.abs(_covariance(partials, k, model.n, mean) - np.eye(k)).max())
