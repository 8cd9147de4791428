from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
from llm_support import SF_SMALL, lower_az, make, odd_docs  # noqa: F401

from sleeper.llm import interpolation as I
from sleeper.llm import queries


def words(text):
    return [w for w in __import__("re").split("[\x20\x09-\x0d]+", lower_az(text or "")) if w]


def brute(docs, rounds=I.ROUNDS):
    """The same model over plain dictionaries: n-grams as tuples, one document at a time."""
    end, begin = ("end",), ("begin",)
    part = {}
    for i, _ in docs:
        crc = zlib.crc32(b"" if i is None else str(i).encode())
        part[i] = 2 if i is not None and crc % 7 == 2 else 1 if i is None or crc // 7 % I.DELETED == 0 else 0
    seqs = [(i, [*words(t), end]) for i, t in docs]

    def counts(which):
        uni, pair, n = Counter(), Counter(), 0
        for i, s in seqs:
            if part[i] in which:
                uni.update(s)
                pair.update(zip([begin, *s], s))
                n += 1
        tokens = sum(uni.values())
        uni[begin] = n
        return uni, pair, tokens

    def estimates(a, b, uni, pair, n):
        c = uni[a]
        return min(int(math.log2(c + 1)), I.BUCKETS - 1), pair[a, b] / max(c, 1), uni[b] / max(n, 1)

    uni0, pair0, n0 = counts({0})
    dev = counts({1})[1]
    v0 = sum(1 for k, v in uni0.items() if v and k != begin)
    weights = np.full((I.BUCKETS, 3), 1 / 3)
    for _ in range(rounds):
        sums = np.ones((I.BUCKETS, 3))
        for (a, b), m in dev.items():
            k, p2, p1 = estimates(a, b, uni0, pair0, n0)
            p = weights[k] * np.array([p2, p1, 1 / (v0 + 1)])
            sums[k] += m * p / p.sum()
        new = sums / sums.sum(axis=1, keepdims=True)
        done = np.abs(new - weights).max() < I.STILL
        weights = new
        if done:
            break
    uni, pair, n = counts({0, 1})
    v = sum(1 for k, x in uni.items() if x and k != begin)
    out = {}
    for i, s in seqs:
        score = base = 0.0
        for a, b in zip([begin, *s], s):
            k, p2, p1 = estimates(a, b, uni, pair, n)
            score += math.log10(weights[k] @ np.array([p2, p1, 1 / (v + 1)]))
            base += math.log10((uni[b] + 1) / (n + v + 1))
        out[i] = (part[i] == 2, len(s), sum(uni[b] > 0 for b in s), n, base, score)
    return out


def compare(got, want):
    for r in got:
        held, n, known, train, base, score = want[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held, n, known, train)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9)
        assert math.isclose(r["score"], score, rel_tol=2e-3, abs_tol=0.05)


def test_query_matches_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = queries.op2_deleted_interpolation(spark, SF_SMALL).collect()
    assert len(got) == len(docs)
    compare(got, brute(docs))
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)  # it predicts unseen texts better


def test_many_blocks_and_shards(spark, make, monkeypatch):
    docs = [(i, " ".join(f"w{(i * j) % 23}" for j in range(i % 40))) for i in range(300)]
    monkeypatch.setattr(I, "BLOCK_CHARS", 200)
    monkeypatch.setattr(I, "SHARD_TOKENS", 500)
    compare(I.score(make(docs, "doc_id long, text string")).collect(), brute(docs))


def test_odd_rows(spark, make):
    got = I.score(odd_docs(make)).collect()
    assert len(got) == 12 and all(math.isfinite(r["score"]) and math.isfinite(r["base_score"]) for r in got)
    assert {r["n_tokens"] for r in got if r["doc_id"] in (1, 2, 3)} == {1}
    assert I.score(make([], "doc_id long, text string")).collect() == []
    alone = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 7 == 2)
    r = I.score(make([(alone, "no one trains")], "doc_id long, text string")).collect()[0]
    assert (r["held_out"], r["n_known"], r["train_tokens"]) == (True, 0, 0) and math.isfinite(r["score"])


def test_weights_are_still(spark):
    """A round more moves no weight by more than 1e-4, where the estimates are close to each other."""
    pair, word, uniform = np.float32([0.05, 0.001] * 50), np.float32([0.02, 0.03] * 50), 0.01
    bucket, n = np.full(100, 3, np.uint8), np.float32([70, 30] * 50)
    got = I.learn(spark.createDataFrame(
        [tuple(bytearray(x.tobytes()) for x in (bucket, n, pair, word))],
        "bucket binary, n binary, pair binary, word binary"), uniform)[3]
    p = np.stack([pair, word, np.full(100, uniform)], axis=1) * got
    more = (p * (n / p.sum(axis=1))[:, None]).sum(axis=0) + 1
    assert np.abs(more / more.sum() - got).max() < 1e-4
