"""Delta Gold, table rules and the history of outcomes."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sleeper import schemas as T
from sleeper.config import ScoreParams
from sleeper.operators import quality as DQ
from sleeper.plans.gold import score_gems
from sleeper.plans.silver import bronze_to_silver
from sleeper.sinks.outcomes import read_outcomes
from sleeper.streaming.incremental import read_stream_silver, run_gold_delta, run_silver_increment

from test_jobs import land


def silver_rows(spark, rows):
    """Silver rows from (appid, total, run day)."""
    df = spark.createDataFrame([(i, n, f"2026-01-{d:02d}") for i, n, d in rows], "appid int, total_resenas int, day string")
    have = {"appid": F.col("appid"), "nombre": F.concat(F.lit("item "), F.col("appid")), "total_resenas": F.col("total_resenas"),
            "resenas_positivas": F.floor(F.col("total_resenas") / 2).cast("int"), "precio": F.lit("5.00"),
            "puntuacion": F.lit(8), "run_ts": F.to_timestamp("day"), "source_file": F.lit("f")}
    return df.select(*[have.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in T.SILVER.fields],
                     F.lit(None).cast("array<string>").alias("failed_rules"), F.lit("passed").alias("dq_status"))


def test_gold_delta_rewrites_what_changed(spark, tmp_path):
    """Waves that raise, keep and lower the maximum; after each one Gold is the batch job's."""
    silver, state, ckpt = (str(tmp_path / n) for n in ("silver", "state", "ckpt"))
    many = [(i, 10 + i, 2) for i in range(200)]
    waves = [
        (many, 200, 200, 209, False),                       # the first
        ([(7, 50, 3)], 1, None, 209, False),                # one newer row: its bucket only
        ([(8, 500, 1)], 1, None, 209, False),               # older than what is there: no change, whatever it holds
        ([(9, 900, 3), (500, 20, 3)], 2, 201, 900, True),   # raised
        ([(9, 30, 4)], 1, 201, 209, True),                  # lowered again
        ([], 0, 0, 209, False)]
    for rows, arrived, rewritten, maximum, rescored in waves:
        if rows:
            silver_rows(spark, rows).write.mode("append").partitionBy("dq_status").parquet(silver)
        got = run_gold_delta(spark, silver, state, ckpt, buckets=16)
        assert (got.arrived, got.maximum, got.rescored_all) == (arrived, maximum, rescored)
        assert got.rewritten == rewritten if rewritten is not None else 0 < got.rewritten < 60
        want = score_gems(read_stream_silver(spark, silver))
        cols = ["appid", "total_resenas", "run_ts", "obscurity_score", "hidden_gem_score", "tier"]
        assert sorted(map(tuple, got.rows.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))
    other = run_gold_delta(spark, silver, state, ckpt, ScoreParams(price_cap=5.0))  # other parameters: all of them
    assert other.rescored_all and other.rewritten == 201
    want = score_gems(read_stream_silver(spark, silver), ScoreParams(price_cap=5.0))
    assert sorted(r[0] for r in other.rows.select("hidden_gem_score").collect()) == sorted(
        r[0] for r in want.select("hidden_gem_score").collect())


def test_rising_run_by_run(spark, tmp_path):
    """Waves in any order, late and repeated runs, corrected scores: the same as windowing over all runs."""
    import random

    from sleeper.operators.insights import score_changes
    from sleeper.plans.rising import advance, read_changes

    rng, root, known = random.Random(3), str(tmp_path / "r"), {}
    schema = "appid long, run int, hidden_gem_score double"
    for runs, again in (((2,), 0), ((3,), 0), ((5, 6), None), ((4,), None), ((1,), None), ((7,), 0), ((7,), None), ((), 0)):
        wave = {(i, r): rng.choice([0.1, 0.2, 0.25, 0.5]) for r in runs for i in range(25) if rng.random() < 0.7}
        known |= wave
        seen = advance(spark.createDataFrame([(*k, v) for k, v in wave.items()], schema), root, buckets=4)
        assert seen["settled"] + seen["again"] == len({i for i, _ in wave})
        assert again is None or seen["again"] == again  # runs in order never look back
        want = score_changes(spark.createDataFrame([(*k, v) for k, v in known.items()], schema)).collect()
        cols = ("appid", "run", "hidden_gem_score", "prev_score", "score_delta", "rise_streak")
        assert sorted(tuple(r[c] for c in cols) for r in read_changes(spark, root).collect()) == sorted(
            tuple(r[c] for c in cols) for r in want)


def test_table_rules(spark, tmp_path):
    assert [o["outcome"] for o in DQ.table_outcomes((DQ.column_count_above(0), DQ.column_count_above(3)), 3, best_effort=True)] \
        == ["Passed", "Failed"]
    with pytest.raises(DQ.TableRuleFailed, match="ColumnCount > 3"):
        DQ.table_outcomes((DQ.column_count_above(3),), 3)
    assert DQ.table_outcomes((DQ.pass_share_at_least(0.5),), 3) == []  # not known before the rows are counted
    assert DQ.table_outcomes((DQ.pass_share_at_least(0.5), DQ.row_count_at_least(0)), 3, 0, 0)[0]["outcome"] == "Passed"
    bronze = land(spark, str(tmp_path / "bronze"), 0, 9999)
    strict = (DQ.column_count_above(100),)
    with pytest.raises(DQ.TableRuleFailed):
        bronze_to_silver(spark, bronze, str(tmp_path / "a"), table_rules=strict)
    assert not (tmp_path / "a").exists()  # a rule on the schema fails before anything is written
    history = str(tmp_path / "history")
    with pytest.raises(DQ.TableRuleFailed, match="PassShare"):
        bronze_to_silver(spark, bronze, str(tmp_path / "b"), table_rules=(DQ.pass_share_at_least(1.0),), history_path=history)
    got = read_outcomes(spark, history).where("scope = 'table'").collect()
    assert [(r["rule"], r["outcome"]) for r in got] == [("PassShare >= 1", "Failed")]  # told, although the run ended


def test_outcome_history_replaces_replays(spark, tmp_path):
    history = str(tmp_path / "history")
    bronze = land(spark, str(tmp_path / "bronze"), 1997, 9999)
    rules = DQ.RULES_SILVER
    for used in (rules, rules, rules[:3]):  # the last replay knows fewer rules
        res = bronze_to_silver(spark, bronze, str(tmp_path / "s"), rules=used, history_path=history, run="r", batch=1)
    got = {r["rule"]: (r["evaluated"], r["failed"]) for r in read_outcomes(spark, history).collect() if r["scope"] == "row"}
    assert got == {o["rule"]: (o["evaluated"], o["failed"]) for o in res.outcomes} and len(got) == 3
    silver, ckpt = str(tmp_path / "stream"), str(tmp_path / "ckpt")
    total = run_silver_increment(spark, bronze, silver, ckpt, history_path=history)
    run_silver_increment(spark, bronze, silver, ckpt, history_path=history)  # nothing new
    land(spark, bronze, 1996, 1996)
    more = run_silver_increment(spark, bronze, silver, ckpt, history_path=history)
    rows = read_outcomes(spark, history).where("run = 'stream'")
    assert rows.select("batch").distinct().count() == 2
    name = 'IsComplete "precio"'
    assert rows.where(F.col("rule") == name).agg(F.sum("evaluated"), F.sum("failed")).first()[:] == (
        total["evaluated"] + more["evaluated"], total[name] + more[name])
