"""The three stages end to end on driver data: extract -> Bronze -> Silver -> Gold."""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import functions as F

from sleeper.config import ScoreParams
from sleeper.plans import landing as L
from sleeper.plans import queries as Q
from sleeper.plans.runs import extract_run, gold_run, insight_report, silver_run

from conftest import SF_SMALL


def test_three_stages(spark, tmp_path):
    bronze, silver, gold, hist, table = (str(tmp_path / n) for n in ("bronze", "silver", "gold", "hist", "table"))
    profile = Q.DRIVER_PROFILE.with_overrides(target=50, max_evaluations=None)
    res = extract_run(spark, Q.candidate_sources(spark, SF_SMALL), L.details_payloads(spark, SF_SMALL),
                      L.reviews_payloads(spark, SF_SMALL), L.players_payloads(spark, SF_SMALL), bronze,
                      profile, run_ts=dt.datetime(2026, 4, 5, 10, 20, 30))
    accepted = res.entries.count()
    run = os.path.join(bronze, "2026-04-05_10-20-30")
    assert os.path.isdir(os.path.join(run, "_meta"))
    meta = spark.read.json(os.path.join(run, "_meta")).first()
    assert meta["total_resultados"] == accepted
    assert meta["fecha_ejecucion"] == "2026-04-05T10:20:30"

    s = silver_run(spark, bronze, silver)
    passed = spark.read.parquet(s.path).count()
    assert passed + (spark.read.parquet(s.quarantine).count() if os.path.isdir(s.quarantine) else 0) == accepted

    params = ScoreParams(price_cap=1000.0, tier_s=0.55, tier_a=0.50)
    g = gold_run(spark, s.path, gold, params, history_path=hist, table_path=table, update_cols=["nombre"],
                 run_date=dt.date(2026, 4, 5))
    assert g.count() == g.select("appid").distinct().count() == passed
    assert spark.read.parquet(hist).where(F.col("run_date") == "2026-04-05").count() == passed
    assert spark.read.parquet(table).count() == passed
    report = insight_report(g, k=5)
    assert report["top"].count() == min(5, passed)
    assert set(report) == {"top", "top_per_genre", "genres", "tiers"}
    again = insight_report(g, history=spark.read.parquet(hist))
    assert again["rising"].count() == 0  # one run: nothing has risen yet
