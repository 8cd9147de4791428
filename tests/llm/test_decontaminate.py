from __future__ import annotations

import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from llm_support import SF_SMALL, lower_az, make, odd_docs  # noqa: F401

from sleeper.llm import decontaminate as D
from sleeper.llm import queries

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def split(text):
    return WORD.findall(lower_az(text or ""))


def brute(docs, items, window=10):
    wins = {}
    for i, t in items:
        w = split(t)
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            wins.setdefault(tuple(w[k:k + n]), set()).add(str(i))
    sizes = sorted({len(w) for w in wins})
    out = []
    for i, t in docs:
        w, hit, found = split(t), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if (own := wins.get(tuple(w[k:k + n]))):
                    hit |= set(range(k, k + n))
                    found |= own
        out.append((i, len(w), len(hit), sorted(found)))
    return out


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(codec="utf-8"), max_size=80))
def test_words(text):
    assert [w.decode() for w in D.words(text)] == split(text)


def test_query_matches_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    got = {r["doc_id"]: r for r in queries.op4_positional_index(spark, SF_SMALL).collect()}
    want = brute(docs, items)
    assert len(got) == len(docs) and any(n for _, _, n, _ in want)
    for i, n, hit, found in want:
        assert got[i].asDict() == {"doc_id": i, "n_words": n, "n_hit": hit, "n_items": len(found), "contaminated": hit > 0,
                                   "items_sha256": hashlib.sha256(",".join(found).encode()).hexdigest()}


ITEMS = [(1, "a b a b a b a b a b a b"), (2, "Solo"), (3, None), (4, ""), (None, "never seen"), (10, "x, y; z"),
         (5, "one two three four five six seven eight nine ten eleven"), (2, "Solo")]
DOCS = [(1, "a b " * 12), (2, "solo SOLO. so lo"), (3, None), (4, "x y"), (5, "x-y-z x y z z"), (5, "x-y-z x y z z"),
        (6, "zero one two three four five six seven eight nine ten. One two three four five six seven eight nine eleven"),
        (7, "one two three four five six seven eight nine ten " * 3), (8, "nine ten eleven"), (None, "solo")]


def test_small_cases_in_one_block_and_many(spark, make, monkeypatch):
    want = sorted(brute(DOCS, [x for x in ITEMS if x[0] is not None]), key=str)
    bench = make(ITEMS, "item_id long, text string")
    for shard, block in ((1 << 20, 1 << 20), (10, 1 << 20), (30, 8)):
        monkeypatch.setattr(D, "SHARD_BYTES", shard)
        got = D.contamination(odd_docs(make, DOCS), bench, block_bytes=block).withColumn("n_hit", D.n_hit()).collect()
        assert sorted([(r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in got], key=str) == want
    none = D.contamination(odd_docs(make, DOCS), bench.where("false")).collect()
    assert len(none) == len(DOCS) and not any(r["hits"] for r in none)
    assert D.contamination(make([], "doc_id long, text string"), bench).collect() == []
    assert len(D.contamination(odd_docs(make), bench).collect()) == 12


def test_benchmark_is_cut_in_tasks_and_read_round_by_round(spark, make):
    items = [(i, f"w{i} " + "a b c d e f g h i j k l " * (i % 3) + f"w{i}") for i in range(40)]
    bench = make(items, "item_id long, text string").repartition(5)
    blocks = D.build_blocks(bench, size=100)
    assert blocks.count() >= 5
    got = list(D.rounds(blocks, 100))
    assert len(got) > 5 and sum(len(q.names) for r in got for q in r) == 40
    merged = list(D.rounds(blocks, 1 << 20))
    assert len(merged) == 1 and len(merged[0]) == blocks.count()
    docs = [(i, f"x {t} y") for i, t in items] + [(99, "a b c d e f g h i j")]
    want = brute(docs, items)
    for size in (100, 1 << 20):
        found = D.contamination(make(docs, "doc_id long, text string"), bench, block_bytes=size)
        found = found.withColumn("n_hit", D.n_hit()).collect()
        assert sorted((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in found) == sorted(want)


def test_very_long_item_and_document(make):
    long = " ".join(f"w{i}" for i in range(200_000))
    got = D.contamination(make([(1, long), (2, "w5 w6")], "doc_id long, text string"),
                          make([("all", long)], "item_id string, text string")).withColumn("n_hit", D.n_hit())
    assert {(r["doc_id"], r["n_hit"], *r["items"]) for r in got.collect()} == {(1, 200_000, "all"), (2, 0)}


def test_proximity(spark, make):
    docs = [(1, "a x x b x a"), (2, "a b"), (3, "b x x x a"), (4, "c a d b"), (5, "a"), (6, "a a b a")]
    index = D.build_index(make(docs, "doc_id long, text string").selectExpr("0L _file", "0L _row", "doc_id", "text"))
    want = set()
    for i, t in docs:
        w = split(t)
        for k in range(len(w)):
            if w[k] in "ab" and {"a", "b"} <= set(w[k:k + 3]):
                want.add((i, k))
    assert {(r["doc_id"], r["position"]) for r in D.search_near(index, "a b", within=3).collect()} == want
    assert D.search_near(index, "a nowhere", within=3).collect() == []
