from __future__ import annotations

import hashlib

from llm_support import SF_SMALL, lower_az, make, odd_docs  # noqa: F401

from sleeper.llm import exact_dedup as D
from sleeper.llm import queries


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(lower_az(t or ""), []).append(i)
    return {k: (max((x for x in v if x is not None), default=None), len(v)) for k, v in groups.items()}


def test_query_matches_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    want = brute(docs)
    got = {r["doc_id"]: r for r in queries.op10_exact_dedup(spark, SF_SMALL).collect()}
    assert len(got) == len(docs)
    for i, t in docs:
        top, n = want[lower_az(t or "")]
        sha = hashlib.sha256(lower_az(t or "").encode()).hexdigest()
        assert got[i].asDict() == {"doc_id": i, "keep_id": top, "group_size": n, "kept": i == top, "text_sha256": sha}


def test_odd_rows(spark, make):
    got = D.dedup(odd_docs(make), D.DigestIndex(spark)).collect()
    assert len(got) == 12
    empty = [r for r in got if r["doc_id"] in (1, 2)]
    assert [(r["keep_id"], r["group_size"]) for r in empty] == [(2, 2)] * 2
    same = [r for r in got if r["keep_id"] == 6]
    assert len(same) == 4 and [r["doc_id"] for r in same if r["kept"]] == [6]
    assert sum(r["kept"] for r in got) == 8


def test_repeated_row_is_kept_once(spark, make):
    got = D.dedup(make([(1, "a b"), (1, "a b"), (1, "A b")], "doc_id long, text string"), D.DigestIndex(spark)).collect()
    assert sum(r["kept"] for r in got) == 1


def test_later_batches_and_replay(spark, make):
    index = D.DigestIndex(spark, buckets=3)
    schema = "doc_id long, text string"
    D.dedup(make([(1, "one"), (2, "two")], schema), index, batch="a")
    for _ in range(2):  # the second time is a replay
        got = {r["doc_id"]: r for r in D.dedup(make([(3, "ONE"), (4, "three"), (5, "Three")], schema), index, "b").collect()}
        assert [(got[i]["keep_id"], got[i]["kept"]) for i in (3, 4, 5)] == [(1, False), (5, False), (5, True)]
    assert index.read().count() == 3
    again = D.DigestIndex(spark, index.path, buckets=3)  # as a later session opens it
    assert [r["kept"] for r in D.dedup(make([(9, "two")], schema), again, "c").collect()] == [False]
    assert D.dedup(make([], schema), again, "d").collect() == []


def test_index_is_read_without_a_shuffle(spark, make):
    index = D.DigestIndex(spark, buckets=4)
    D.dedup(make([(i, f"t{i}") for i in range(50)], "doc_id long, text string"), index)
    files = index.read().select("_metadata.file_path").distinct().count()
    assert files <= 4
    with_conf = index.read().hint("merge").join(index.read().select("digest"), "digest", "left_anti")
    assert "Exchange" not in with_conf._jdf.queryExecution().executedPlan().toString()


def test_hot_text(spark, make):
    rows = [(i, "hot") for i in range(3000)] + [(10_000 + i, f"t{i}") for i in range(2000)]
    got = D.dedup(make(rows, "doc_id long, text string"), D.DigestIndex(spark)).collect()
    assert len(got) == 5000 and sum(r["kept"] for r in got) == 2001
    assert {r["group_size"] for r in got} == {1, 3000}


def test_an_index_keeps_its_number_of_buckets(spark, make):
    """Opened under other numbers of shuffle partitions, the index still finds every text."""
    docs = make([(i, f"text {i}") for i in range(300)], "doc_id long, text string")
    before, path = spark.conf.get("spark.sql.shuffle.partitions"), None
    try:
        for n, fresh in ((4, 300), (16, 0), (3, 0)):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            index = D.DigestIndex(spark, path)
            path = index.path
            assert D.dedup(docs, index, batch=str(n)).where("kept").count() == fresh
            assert (index.buckets, index.read().count()) == (4, 300)
            index.close()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
