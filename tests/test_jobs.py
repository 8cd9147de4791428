"""End-to-end jobs over landed files: Bronze layout, Silver routing, streaming replay."""

from __future__ import annotations

import json
import os

from pyspark.sql import functions as F

from sleeper.operators import quality as DQ
from sleeper.plans.silver import bronze_to_silver
from sleeper.sinks.files import write_bronze
from sleeper.sources.files import read_bronze, read_silver
from sleeper.streaming.incremental import read_stream_silver, run_gold_increment, run_silver_increment

from conftest import SF_SMALL


def land(spark, root, lo, hi):
    from sleeper.plans.queries import _land_snapshots

    return _land_snapshots(spark, SF_SMALL, root, lo, hi)


def test_bronze_keeps_null_keys_and_skips_meta(spark, tmp_path):
    root = str(tmp_path / "bronze")
    df = spark.createDataFrame([(1, None)], "appid int, nombre string")
    write_bronze(df, root, run_ts="2026-04-05 10:20:30")
    run = os.path.join(root, "2026-04-05_10-20-30")
    lines = [ln for f in os.listdir(run) if f.endswith(".json")
             for ln in open(os.path.join(run, f), encoding="utf-8") if ln.strip()]
    assert [json.loads(ln) for ln in lines] == [{"appid": 1, "nombre": None}]
    os.makedirs(os.path.join(run, "_meta"))
    with open(os.path.join(run, "_meta", "m.json"), "w") as f:
        f.write('{"appid": 999}\n')
    with open(os.path.join(run, "bad.json"), "w") as f:
        f.write("{not json\n")
    got = read_bronze(spark, root).select("appid", "_corrupt_record",
                                          F.date_format("run_ts", "yyyy-MM-dd_HH-mm-ss").alias("r")).collect()
    assert sorted((r["appid"] or 0) for r in got) == [0, 1]
    assert {r["r"] for r in got} == {"2026-04-05_10-20-30"}
    assert sum(r["_corrupt_record"] is not None for r in got) == 1


def test_bronze_to_silver_routes_every_row(spark, tmp_path):
    bronze = land(spark, str(tmp_path / "bronze"), 0, 9999)
    res = bronze_to_silver(spark, bronze, str(tmp_path / "silver"))
    total = read_bronze(spark, bronze).count()
    passed = read_silver(spark, res.path).count()
    rejected = spark.read.parquet(res.quarantine)
    assert passed + rejected.count() == total
    assert rejected.where(F.size("failed_rules") == 0).count() == 0
    assert {o["rule"] for o in res.outcomes} == {r.name for r in DQ.RULES_SILVER}
    assert all(o["evaluated"] == total for o in res.outcomes)


def test_malformed_lines_are_counted_once_and_under_no_rule(spark, tmp_path):
    root = str(tmp_path / "bronze")
    good = spark.read.json(land(spark, str(tmp_path / "good"), 1999, 1999)).limit(1)
    write_bronze(good, root, run_ts="2026-04-05 10:20:30")
    with open(os.path.join(root, "2026-04-05_10-20-30", "bad.json"), "w") as f:
        f.write("{not json\n")
    res = bronze_to_silver(spark, root, str(tmp_path / "silver"))
    rejected = spark.read.parquet(res.quarantine).where("array_contains(failed_rules, 'Malformed record')")
    assert res.malformed == rejected.count() == 1
    complete = {o["rule"]: o["failed"] for o in res.outcomes}
    assert complete['IsComplete "appid"'] == 0
    seen = run_silver_increment(spark, root, str(tmp_path / "stream"), str(tmp_path / "ckpt"))
    assert seen["malformed"] == 1 and seen["evaluated"] == 2 and seen['IsComplete "appid"'] == 0


def test_stream_increment_and_replay(spark, tmp_path):
    bronze, silver, ckpt = (str(tmp_path / n) for n in ("bronze", "silver", "ckpt"))
    land(spark, bronze, 0, 1997)
    seen = run_silver_increment(spark, bronze, silver, ckpt)
    first = read_stream_silver(spark, silver).count()
    assert run_silver_increment(spark, bronze, silver, ckpt)["evaluated"] == 0  # nothing new landed: no new rows
    assert read_stream_silver(spark, silver).count() == first
    land(spark, bronze, 1998, 9999)
    more = run_silver_increment(spark, bronze, silver, ckpt)
    batch = bronze_to_silver(spark, bronze, str(tmp_path / "batch"))
    assert read_stream_silver(spark, silver).count() == read_silver(spark, batch.path).count()
    rejected = read_stream_silver(spark, silver, "rejected")
    assert rejected.count() == spark.read.parquet(batch.quarantine).count()
    assert {o["rule"]: o["failed"] for o in batch.outcomes} == \
        {k: seen[k] + more[k] for k in seen if k not in ("evaluated", "malformed")}


def test_late_runs_reach_gold(spark, tmp_path):
    """The newer run lands first; items that only the older has must still appear, and no newer row is replaced."""
    from sleeper.plans.gold import score_gems

    bronze, silver, ckpt, state, gold_ckpt = (str(tmp_path / n) for n in ("bronze", "silver", "ckpt", "state", "gold"))
    for lo, hi in ((1998, 9999), (0, 1997)):
        land(spark, bronze, lo, hi)
        run_silver_increment(spark, bronze, silver, ckpt)
        gold = run_gold_increment(spark, silver, state, gold_ckpt)
    gold = run_gold_increment(spark, silver, state, gold_ckpt)  # nothing new: the same
    want = score_gems(read_stream_silver(spark, silver))
    cols = ["appid", "total_resenas", "hidden_gem_score"]
    assert sorted(map(tuple, gold.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))
    assert len([n for n in os.listdir(state) if n.startswith("version=")]) <= 2


def test_a_run_landed_again_replaces_itself(spark, tmp_path):
    root = str(tmp_path / "bronze")
    land(spark, root, 1997, 1999)
    before = read_bronze(spark, root).count()
    land(spark, root, 1998, 1998)
    assert read_bronze(spark, root).count() == before
    df = spark.createDataFrame([(1, "A")], "appid int, nombre string")
    for _ in range(2):
        write_bronze(df, str(tmp_path / "one"), run_ts="2026-01-01 00:00:00")
    assert read_bronze(spark, str(tmp_path / "one")).count() == 1


def test_upsert_writes_touched_buckets_only(spark, tmp_path):
    from sleeper.sinks.files import parquet_upsert

    path = str(tmp_path / "t")
    rows = spark.range(200).select(F.col("id").alias("appid"), F.lit("old").alias("nombre"), F.lit(1).alias("v"))
    parquet_upsert(rows, path, "appid", buckets=8)
    def files():
        return {os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}
    before = files()
    parquet_upsert(spark.createDataFrame([(5, "new", 2)], "appid long, nombre string, v int"), path, "appid", ["nombre"], 8)
    assert len(before - files()) == 1  # one bucket rewritten
    got = {r["appid"]: (r["nombre"], r["v"]) for r in spark.read.parquet(path).collect()}
    assert len(got) == 200 and got[5] == ("new", 1) and got[6] == ("old", 1)
