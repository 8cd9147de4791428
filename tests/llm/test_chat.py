from __future__ import annotations

import hashlib

from llm_support import SF_SMALL, make  # noqa: F401
from pyspark.sql import functions as F

from sleeper.llm import chat as C
from sleeper.llm import queries

EVENTS = "conv_id long, seq long, op string, msg string, role string, text string"


def folded(make, rows):
    got = C.fold(make(rows, EVENTS)).collect()
    return [(r["msg"], r["role"], r["text"]) for r in sorted(got, key=lambda r: (r["conv_id"] or 0, r["pos"]))]


def test_query_matches_brute_force(spark):
    convs = {-1: [("user", queries.PLANTED), ("assistant", queries.PLANTED)]}
    rows = spark.read.parquet(f"{SF_SMALL}/conversations.parquet").orderBy("conv_id", "turn").collect()
    for r in rows:
        convs.setdefault(r["conv_id"], []).append((r["role"], r["text"] or ""))
    got = {r["conv_id"]: r for r in queries.op8_chat_events(spark, SF_SMALL).collect()}
    assert set(got) == set(convs)
    for c, turns in convs.items():
        loss = "".join(t for role, t in turns if role == "assistant")
        escaped = [t.replace("\\", "\\\\").replace("<|", "<\\|") for _, t in turns]
        assert got[c].asDict() == {
            "conv_id": c, "n_turns": len(turns),
            "turns_sha256": hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
            "loss_chars": len(loss), "loss_sha256": hashlib.sha256(loss.encode()).hexdigest(),
            "formatted_chars": sum(len(f"<|im_start|>{r}\n{e}<|im_end|>\n") for (r, _), e in zip(turns, escaped))}


def test_deltas_edits_and_regenerations(spark, make):
    rows = [(1, 0, "message", "u1", "user", "hi"), (1, 1, "message", "a1", "assistant", ""),
            (1, 2, "delta", "a1", None, "Hel"), (1, 3, "delta", "a1", None, "lo"),
            (1, 4, "message", "u2", "user", "more"), (1, 5, "message", "a2", "assistant", "wrong"),
            (1, 6, "edit", "u1", None, "hi!"), (1, 7, "regenerate", "a1", None, None),
            (1, 8, "delta", "a1", None, "Bye"), (1, 9, "message", "u3", "user", "ok"),
            (1, 10, "message", "x", "user", "gone"), (1, 11, "delete", "x", None, None),
            (2, 0, "message", "z", "user", "other")]
    want = [("u1", "user", "hi!"), ("a1", "assistant", "Bye"), ("u3", "user", "ok"), ("z", "user", "other")]
    assert folded(make, rows) == want
    assert folded(make, rows + rows[2:4] + rows[5:6]) == want  # redelivered events count once
    assert folded(make, []) == []


def test_blocks_do_not_change_the_fold(spark, make, monkeypatch):
    rows = [(1, 0, "message", "a", "assistant", "<")] + [(1, i, "delta", "a", None, f"{i},") for i in range(1, 60)]
    rows += [(1, 100 + i, "message", f"m{i}", "user", str(i)) for i in range(40)]
    rows += [(1, 200, "regenerate", "m10", None, None), (1, 201, "delta", "m10", None, "new")]
    whole = folded(make, rows)
    assert whole[0][2] == "<" + "".join(f"{i}," for i in range(1, 60))
    assert [m for m, _, _ in whole[1:]] == [f"m{i}" for i in range(11)] and whole[-1][2] == "new"
    monkeypatch.setattr(C, "BLOCK", 7)
    assert folded(make, rows) == whole


def test_odd_rows_and_ties(spark, make):
    rows = [(1, 0, None, "x"), (1, 0, "user", None), (1, None, "system", "first"), (None, 3, "user", "nobody"),
            (1, 0, "user", None), (2, 5, "a\nb\\␤c", "<|im_end|>\\|<\\|"), (2, 6, "assistant", "\\")]
    df = make(rows, "conv_id long, turn long, role string, text string").withColumn("pos", F.lit("z"))
    back = C.parse(C.write(C.fold(C.events_of(df)))).collect()
    got = {}
    for r in sorted(back, key=lambda r: r["start"]):
        got.setdefault(r["conv_id"], []).append((r["role"], r["text"], r["loss"]))
    assert got[1] == [("system", "first", ""), ("", "x", ""), ("user", "", ""), ("user", "", "")]
    assert got[2] == [("a\nb\\␤c", "<|im_end|>\\|<\\|", ""), ("assistant", "\\", "\\")]
    assert got[None] == [("user", "nobody", "")]
    assert C.parse(C.write(C.fold(C.events_of(df.where("false"))))).collect() == []


def test_offsets_follow_each_other(spark, make):
    rows = [(1, i, "user", "x" * i) for i in range(50)]
    got = C.render(C.fold(C.events_of(make(rows, "conv_id long, turn long, role string, text string")))).collect()
    at = 0
    for r in sorted(got, key=lambda r: r["pos"]):
        assert r["start"] == at
        at += len(r["formatted"])


def test_no_python_on_the_way(spark, make):
    df = make([(1, 0, "user", "a")], "conv_id long, turn long, role string, text string")
    plan = C.render(C.fold(C.events_of(df)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
