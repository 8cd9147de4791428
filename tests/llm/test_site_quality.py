from __future__ import annotations

import sys

import numpy as np
from llm_support import CLASH, make  # noqa: F401
from pyspark import cloudpickle

from sleeper.llm import quality as Q
from sleeper.llm import queries

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers can't import the tests

DOCS = "doc_id long, text string, source string, lang string"
SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    """Fitted on the labels of half the documents, checked on the other half's."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    half = "crc32(cast(cast(doc_id as string) as binary)) % 2 = "
    model = Q.train(docs, labels.where(half + "0"))
    truth = labels.where(half + "1").withColumnRenamed("toxic", "truth")
    got = Q.judge(docs, model).join(truth, "doc_id").select("low", "toxic", "quality", "truth").toArrow().to_pandas()
    assert ((got["low"] > 0.5) == (got["quality"] == 0)).mean() > 0.99
    toxic = got
    hit = toxic["toxic"] > 0.5
    assert (hit & (toxic["truth"] == 1)).sum() / max((toxic["truth"] == 1).sum(), 1) > 0.9
    assert (hit & (toxic["truth"] == 0)).mean() < 0.01


def test_query_covers_all_documents(spark):
    sf = "/root/testdata/sf0.001"
    got = queries.op3_hierarchical_quality(spark, sf).collect()
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count() == len({r["doc_id"] for r in got})


def site_rows():
    rng = np.random.default_rng(1)
    rows = [(i, "hot", f"p{i % 3}", float(rng.normal(-3, 1))) for i in range(600)]
    rows += [(1000 + i, "bad", "p", float(rng.normal(3, 1))) for i in range(60)]
    return rows + [(2000 + i, f"one{i}", "p", float(rng.normal(-3, 1))) for i in range(40)] + [(3000, "solo", "p", 3.0)]


class Planted(Q.Classifier):
    """Reads both log odds from the text."""

    def __init__(self):
        super().__init__({h: {} for h in Q.HEADS})

    def odds(self, texts):
        return {h: np.array([float(t or 0) for t in texts]) for h in Q.HEADS}


def brute(rows):
    """{id: (host share, path share, combined probability)} of rows (id, host, path, log odds)."""
    share = {i: 1 / (1 + np.exp(-x)) for i, _, _, x in rows}
    sites, paths = {}, {}
    for i, h, p, _ in rows:
        sites.setdefault(h, []).append(share[i])
        paths.setdefault((h, p), []).append(share[i])
    overall = np.clip(np.mean(list(share.values())), 1e-4, 1 - 1e-4)

    def strength(groups):
        n = np.array([len(g) for g in groups])
        s = np.array([sum(g) for g in groups])
        mean = s.sum() / n.sum()
        between = ((n * (s / n - mean) ** 2).sum() - (len(n) - 1) * mean * (1 - mean)) / (n.sum() - (n * n).sum() / n.sum())
        return np.clip(mean * (1 - mean) / max(between, 1e-9) - 1, 2, 1e4)

    ks, kp = strength(sites.values()), strength(paths.values())
    logit = lambda q: np.log(np.clip(q, 1e-4, 1 - 1e-4) / (1 - np.clip(q, 1e-4, 1 - 1e-4)))
    out = {}
    for i, h, p, x in rows:
        host = (sum(sites[h]) + ks * overall) / (len(sites[h]) + ks)
        path = (sum(paths[h, p]) + kp * host) / (len(paths[h, p]) + kp)
        out[i] = host, path, 1 / (1 + np.exp(-(x + np.clip(logit(path) - logit(overall), -Q.SWAY, Q.SWAY))))
    return out


def test_posteriors_match_brute_force(spark, make):
    rows = site_rows()
    df = make([(i, str(x), h, p) for i, h, p, x in rows], DOCS)
    got = {r["doc_id"]: r for r in Q.judge(df, Planted()).collect()}
    for i, (host, path, both) in brute(rows).items():
        r = got[i]
        assert np.allclose([r["host_low"], r["path_low"], r["low"]], [host, path, both], rtol=1e-6)
        assert r["kept"] == (both < 0.5)


def test_query_matches_brute_force(spark):
    """The query's model on every whole document, its sites worked out here."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = Q.train(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    rows = docs.select("doc_id", "text", "source", "lang").collect()
    odds = model.odds([r["text"] or "" for r in rows])
    got = {r["doc_id"]: r for r in queries.op3_hierarchical_quality(spark, sf).collect()}
    assert len(got) == len(rows)
    want = {h: brute([(r["doc_id"], r["source"] or "", r["lang"] or "", float(x)) for r, x in zip(rows, odds[h])]) for h in Q.HEADS}
    for i, r in got.items():
        for h in Q.HEADS:
            assert np.allclose([r[f"host_{h}"], r[f"path_{h}"], r[h]], want[h][i], rtol=1e-5, atol=1e-9)
        assert r["kept"] == all(want[h][i][2] < 0.5 for h in Q.HEADS)


def test_the_sample_is_bounded_by_rows(spark, make):
    """One labelled id with most of the rows: copies count once, and unlike texts no more than the bound."""
    rows = [(1, "same words here", "h", "p")] * 3000 + [(1, f"other words {i}", "h", "p") for i in range(3000)]
    rows += [(i, f"good text {i}", "h", "p") for i in range(2, 40)]
    labels = make([(i, int(i != 1), 0) for i in range(1, 40)], "doc_id long, quality int, toxic int")
    seen = []
    real = Q.Classifier.fit
    try:
        Q.Classifier.fit = lambda self, x, y: (seen.append((len(x), int(sum(y["low"])))), real(self, x, y))[1]
        Q.train(make(rows, DOCS), labels, fitted=50)
        Q.train(make(rows[:3000] + rows[6000:], DOCS), labels, fitted=50)
    finally:
        Q.Classifier.fit = real
    assert seen[0][0] == 50 and seen[1] == (39, 1)


def test_sparse_sites_shrink_to_the_whole(spark, make):
    got = {r["doc_id"]: r for r in Q.judge(make([(i, str(x), h, p) for i, h, p, x in site_rows()], DOCS), Planted()).collect()}
    assert got[1000]["host_low"] > 0.8
    assert got[3000]["host_low"] < got[3000]["p_low"] - 0.2  # one document doesn't make a bad host


def test_odd_rows(spark, make):
    rows = [(1, None, None, None), (2, "", "h", None), (None, "a b c", None, "p"), (3, "a b c", "h", "p"),
            (3, "a b c", "h", "p"), (4, "w " * 100_000, "h", "p"), (5, "x" * 100_000, "h", "p")]
    df = make([(*r, *["z"] * 13) for r in rows], f"{DOCS}, {CLASH}")
    labels = make([(1, 1, 0), (3, 0, None), (3, 1, 1), (None, 0, 1), (4, None, None)], "doc_id long, quality int, toxic int")
    model = Q.train(df, labels)
    got = Q.judge(df, model).collect()
    assert len(got) == 7 and all(0 <= r["low"] <= 1 and 0 <= r["toxic"] <= 1 for r in got)
    assert len({r["low"] for r in got if r["doc_id"] == 3}) == 1
    assert Q.judge(df.where("false"), model).collect() == []
    unlabelled = Q.train(df, labels.where("false"))
    assert len(Q.judge(df, unlabelled).collect()) == 7
