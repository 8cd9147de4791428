from __future__ import annotations

import math

import numpy as np
import pytest
from llm_support import CLASH, SF_SMALL, make  # noqa: F401

from sleeper.llm import embedding_dedup as E
from sleeper.llm import queries

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, threshold=0.93):
    """{place: (links, component)} over all pairs of one label."""
    def usable(v, label):
        return label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    at = [i for i, (_, v, label) in enumerate(rows) if usable(v, label)]
    links = {i: set() for i in range(len(rows))}
    for label, dim in {(rows[i][2], len(rows[i][1])) for i in at}:
        mine = [i for i in at if rows[i][2] == label and len(rows[i][1]) == dim]
        u = np.array([rows[i][1] for i in mine], np.float64)
        u /= np.sqrt((u * u).sum(1, keepdims=True))
        for a, b in zip(*np.nonzero(np.triu(u @ u.T >= threshold, 1))):
            links[mine[a]].add(mine[b])
            links[mine[b]].add(mine[a])
    root = {}
    for i in range(len(rows)):
        if i not in root:
            todo, comp = [i], {i}
            while todo:
                for j in links[todo.pop()] - comp:
                    comp.add(j)
                    todo.append(j)
            ids = [rows[j][0] for j in comp if rows[j][0] is not None]
            root |= dict.fromkeys(comp, min(ids, default=None))
    return {i: (len(links[i]), root[i]) for i in links}


def compare(spark_rows, rows, threshold=0.93):
    got = sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"]), r["kept"]) for r in spark_rows)
    want = sorted((str(rows[i][0]), n, str(c), rows[i][0] == c) for i, (n, c) in brute(rows, threshold).items())
    assert got == want


def near(rng, base, noise):
    v = base + rng.normal(size=len(base)) * noise
    return v / np.linalg.norm(v)


def planted(seed=0, dim=48):
    """Lone vectors, pairs at several cosines, a crowd, a chain, copies and scaled copies, in two labels."""
    rng = np.random.default_rng(seed)
    out = [rng.normal(size=dim) for _ in range(300)]
    for cos in (0.90, 0.925, 0.935, 0.95, 0.98, 0.999):
        for _ in range(15):
            a = near(rng, rng.normal(size=dim), 0)
            b = rng.normal(size=dim)
            b = near(rng, b - a * (a @ b), 0)
            out += [a, cos * a + math.sqrt(1 - cos * cos) * b]
    crowd = near(rng, rng.normal(size=dim), 0)
    out += [near(rng, crowd, 0.08 / math.sqrt(dim)) for _ in range(150)]
    step = near(rng, rng.normal(size=dim), 0)
    for _ in range(12):
        step = near(rng, step, 0.25 / math.sqrt(dim))
        out.append(step)
    out += [out[0]] * 40 + [out[1] * 3.0, out[2] * 0.25]
    order = rng.permutation(len(out))
    return [(int(i) + 1000, [float(x) for x in np.float32(out[i])], int(i) % 5 != 0 and 1 or 2) for i in order]


def test_planted_match_brute_force(spark, make):
    rows = planted()
    compare(E.near_duplicates(make(rows, SCHEMA)).collect(), rows)


def test_query_matches_brute_force(spark):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    compare(queries.op12_sorted_projection_dedup(spark, SF_SMALL).collect(), rows)


def test_windows_reach_across_partitions(spark, make):
    """Every partition shorter than a window: each pair of the order within a window is compared exactly once or more."""
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=4)], 1) for i in range(60)]
    nodes = make([(i, "1", v) for i, v, _ in rows], "node long, label string, v array<double>")
    got = {(r["a"], r["b"]) for r in E.find_links(nodes, 0.1, 64, 1).collect()}
    u = np.array([v for _, v, _ in rows])
    u /= np.linalg.norm(u, axis=1)[:, None]
    assert got == {(a, b) for a, b in zip(*map(list, np.nonzero(np.triu(u @ u.T >= 0.1, 1))))}


def test_odd_rows(spark, make):
    nan, inf = float("nan"), float("inf")
    a, b = [1.0, 2.0, 3.0], [1.0, 2.0, 3.05]
    rows = [(1, None, 1), (2, [], 1), (3, [0.0, 0.0, 0.0], 1), (4, [None, 1.0, 1.0], 1), (5, [nan, 1.0, 1.0], 1),
            (6, [inf, 1.0, 1.0], 1), (7, a, None), (8, a, 1), (8, a, 1), (9, b, 1), (10, a, 2), (None, a, 1),
            (None, [-5.0, 1.0, 0.0], 1), (11, [1.0, 2.0], 1), (12, [2.0, 4.0], 1), (13, [-0.0, 1.0, 0.0], 1),
            (14, [0.0, 1.0, 0.0], 1), (15, [1e-30, 0.0, 0.0], 1), (16, [1e30, 0.0, 0.0], 1)]
    df = make([(*r, *["z"] * 13) for r in rows], f"{SCHEMA}, {CLASH}")
    compare(E.near_duplicates(df).collect(), rows)
    assert E.near_duplicates(make([], SCHEMA)).collect() == []
    with pytest.raises(ValueError):
        E.near_duplicates(df, threshold=1.5)


def test_passes_grow_with_the_largest_label():
    n = [E.passes_needed(m, 0.93, 32, 0.999) for m in (2, 33, 1000, 100_000, 10_000_000)]
    assert n[:2] == [1, 1] and n == sorted(n) and n[-1] > n[2]


def test_recall_among_many(spark, make):
    """Pairs at the threshold among thousands of others: at least nine in ten are found."""
    rng = np.random.default_rng(5)
    dim, pairs = 32, 200
    rows = [rng.normal(size=dim) for _ in range(4000)]
    for _ in range(pairs):
        a = near(rng, rng.normal(size=dim), 0)
        b = rng.normal(size=dim)
        b = near(rng, b - a * (a @ b), 0)
        rows += [a, 0.931 * a + math.sqrt(1 - 0.931 ** 2) * b]
    df = make([(i, [float(x) for x in v], 1) for i, v in enumerate(rows)], "vec_id long, embedding array<double>, label int")
    got = E.near_duplicates(df).where("n_links > 0").collect()
    assert len(got) >= 0.95 * 2 * pairs and all(r["n_links"] == 1 for r in got)
