from __future__ import annotations

import numpy as np
import xxhash
from llm_support import SF_SMALL, lower_az, make, odd_docs  # noqa: F401

from sleeper.llm import queries
from sleeper.llm import simhash as S


def brute_fp(text, k=3):
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", lower_az(text or "")) if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, bits):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= bits:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(fps))]


def test_query_matches_brute_force(spark):
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect())
    fps = [brute_fp(t) for _, t in docs]
    comp = brute_components(fps, 2)  # ids are sorted, so the smallest index is the smallest id
    got = {r["doc_id"]: r for r in queries.op6_simhash_pigeonring(spark, SF_SMALL).collect()}
    assert len(got) == len(docs)
    for (i, _), fp, c in zip(docs, fps, comp):
        assert (got[i]["fingerprint"], got[i]["component_id"]) == (f"{fp:016x}", docs[c][0])


def test_odd_rows(spark, make):
    got = S.near_duplicates(odd_docs(make)).collect()
    assert len(got) == 12
    by = {r["doc_id"]: r for r in got}
    assert by[1]["fp"] == by[2]["fp"] == by[3]["fp"] == 0
    assert [by[i]["component_id"] for i in (1, 2, 3)] == [1, 1, 1]
    same = [r for r in got if r["doc_id"] in (5, 6, None)]
    assert len(same) == 4 and {r["component_id"] for r in same} == {5} and sum(r["kept"] for r in same) == 1
    assert S.near_duplicates(make([], "doc_id long, text string")).collect() == []


def planted(rng, n, bits):
    """Fingerprints in chains, dense clusters and alone."""
    out = list(rng.integers(0, 1 << 63, n, dtype=np.uint64))
    for start in out[:n // 10]:
        x = int(start)
        for _ in range(6):  # a chain: neighbours within the distance, ends far apart
            for b in rng.choice(64, bits, replace=False):
                x ^= 1 << int(b)
            out.append(np.uint64(x))
    core = int(out[0])
    for _ in range(3 * S.PAIRED):  # a dense cluster under few keys
        x = core
        for b in rng.choice(64, rng.integers(0, bits + 1), replace=False):
            x ^= 1 << int(b)
        out.append(np.uint64(x))
    return list({int(x) for x in out})


def test_links_connect_what_brute_force_connects(spark):
    for bits in (1, 2, 3):
        fps = planted(np.random.default_rng(bits), 150, bits)
        signed = np.array(fps, np.uint64).view(np.int64).tolist()
        df = spark.createDataFrame([(x,) for x in signed], "fp long")
        edges = S.links(df, bits)
        for r in edges.collect():
            assert bin((r["a"] ^ r["b"]) & (2 ** 64 - 1)).count("1") <= bits
        got = {r["node"]: r["root"] for r in S.components(edges).collect()}
        want = brute_components(fps, bits)
        groups = {}
        for x, c in zip(signed, want):
            groups.setdefault(c, set()).add(x)
        for g in groups.values():
            assert {got.get(x, x) for x in g} == {min(g)}


def test_ring_keeps_every_close_pair():
    rng = np.random.default_rng(7)
    for bits in (1, 2, 3, 4):
        ring = S.segments(bits)
        for _ in range(300):
            d = sum(1 << int(b) for b in rng.choice(64, rng.integers(0, bits + 1), replace=False))
            ok = False
            for start in range(len(ring)):
                ok |= all(bin(d & S.chain(bits, start, n) & (2 ** 64 - 1)).count("1") <= n * bits // len(ring)
                          for n in range(1, len(ring) + 1))
            assert ok


def test_components_of_a_long_path_and_a_hot_node(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 2000)]
    got = {r["node"]: r["root"] for r in S.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(301)} == {0} and {got[1000 + i] for i in range(2000)} == {1000}
