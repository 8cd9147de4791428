from __future__ import annotations

import hashlib

from llm_support import SF_SMALL, make  # noqa: F401
from pyspark.sql import functions as F
from test_decontaminate import brute as brute_hits
from test_exact_dedup import lower_az
from test_simhash import brute_components, brute_fp
from tokenizers import Tokenizer

import corpus_pipeline as C
from sleeper.llm import quality, queries

SF = "/root/testdata/sf0.01"


def test_stages_against_brute_force(spark, tmp_path):
    """Each stage's rows follow from its input rows; the quality decision is its operator's own."""
    import __spark_entry__ as E

    assert E.queries()["pipeline"] is C.run
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, {}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for name, stage in C.STAGES:
        before = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
        out = stage(spark, docs, SF)
        path = str(tmp_path / name.replace(" ", "_"))
        out.write.parquet(path)
        after = spark.read.parquet(path)
        ids = {r["doc_id"] for r in after.select("doc_id").collect()}
        seen[name] = (len(before), len(ids))
        if name == "quality classifier":
            model = quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
            want = {r["doc_id"] for r in quality.judge(docs, model).where("kept").collect()}
            labels = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
            clean = {i for i, r in labels.items() if r["quality"] == 1 and r["toxic"] == 0}
            toxic = {i for i, r in labels.items() if r["toxic"] == 1}
            # 399 labels only: a word that marks toxic texts of one language is seen a few times
            assert len(clean - ids) <= 0.01 * len(clean) and len(toxic & ids) <= 0.15 * len(toxic)
        elif name == "exact dedup":
            want = set({lower_az(before[i]): i for i in sorted(before)}.values())
        elif name == "simhash near-dedup":
            order = sorted(before)
            comp = brute_components([brute_fp(before[i]) for i in order], 2)
            want = {order[c] for c in comp}
        elif name == "benchmark decontamination":
            want = {i for i, _, hit, _ in brute_hits(list(before.items()), items) if not hit}
        else:
            library = Tokenizer.from_file(queries.vocabulary())
            want = set(before)
            for r in after.collect():
                assert r["n_tokens"] == len(library.encode(before[r["doc_id"]], add_special_tokens=False).ids)
                assert r["decoded_sha256"] == hashlib.sha256(before[r["doc_id"]].encode()).hexdigest()
        assert ids == want, name
        if name != C.STAGES[-1][0]:
            assert after.columns == columns
            assert {r["doc_id"]: r["text"] or "" for r in after.collect()} == {i: before[i] for i in ids}
        docs = after
    assert all(seen[n][1] < seen[n][0] for n in ("quality classifier", "exact dedup", "benchmark decontamination"))


def test_near_copies_leave_one(spark, make, tmp_path):
    words = [f"word{i}" for i in range(4000)]
    rows = [(i, " ".join(words[:i] + ["changed"] + words[i + 1:]), "s") for i in range(0, 60, 3)]
    rows += [(1000 + i, " ".join(f"other{i}x{j}" for j in range(300)), "s") for i in range(20)]
    make(rows, "doc_id long, text string, source string").write.parquet(str(tmp_path / "in"))
    kept = {r["doc_id"] for r in C.near(spark, spark.read.parquet(str(tmp_path / "in")), SF_SMALL).collect()}
    order = sorted(i for i, _, _ in rows)
    texts = {i: t for i, t, _ in rows}
    assert kept == {order[c] for c in brute_components([brute_fp(texts[i]) for i in order], 2)}
    assert len(kept) < len(rows) and {1000 + i for i in range(20)} <= kept


def test_odd_rows_pass_through(spark, make, tmp_path):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "Some text, three words more.", "en", "s", 9),
            (3, "Some text, three words more.", "en", "s", 9), (None, "no id but a text of its own", None, "s", 1),
            (4, "w " * 30_000, "en", None, 5)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    make([(*r, "k", "d") for r in rows], schema + ", keep_id string, _f0 string").write.parquet(str(tmp_path / "in"))
    docs = spark.read.parquet(str(tmp_path / "in"))
    for i, (_, stage) in enumerate(C.STAGES):
        out = stage(spark, docs, SF_SMALL)
        out.write.parquet(str(tmp_path / f"out{i}"))
        docs = spark.read.parquet(str(tmp_path / f"out{i}"))
        if i + 1 < len(C.STAGES):
            assert docs.columns == [*schema.replace(" long", "").replace(" string", "").split(", "), "keep_id", "_f0"]
    empty = spark.read.parquet(str(tmp_path / "in")).where("false")
    for i, (_, stage) in enumerate(C.STAGES):
        out = stage(spark, empty, SF_SMALL)
        out.write.parquet(str(tmp_path / f"none{i}"))
        assert spark.read.parquet(str(tmp_path / f"none{i}")).count() == 0


def test_rows_of_the_same_id_and_text_count_once(spark, make, tmp_path):
    text = "Some text, five words more."
    make([(3, text, "a"), (3, text, "b"), (3, "Another text of this same id.", "c")],
         "doc_id long, text string, source string").write.parquet(str(tmp_path / "in"))
    out = C.exact(spark, spark.read.parquet(str(tmp_path / "in")), SF_SMALL)
    assert sorted(r["text"] for r in out.collect()) == ["Another text of this same id.", text]
    assert out.where(F.col("source").isin("a", "b")).count() == 1
