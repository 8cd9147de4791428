"""The three stages as callable jobs: extract, Bronze -> Silver, Silver -> Gold.

    res = extract_run(spark, sources, details, reviews, players, bronze_root)
    silver = silver_run(spark, bronze_root, silver_root)
    gold = gold_run(spark, silver.path, gold_path, history_path=..., table_path=...)
    report = insight_report(gold)
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sleeper.config import Profile, ScoreParams
from sleeper.functions.runs import iso_seconds
from sleeper.operators import candidates as C
from sleeper.operators import insights
from sleeper.operators import quality as DQ
from sleeper.operators.funnel import ACCEPTED, OUTCOMES
from sleeper.plans import extract as X
from sleeper.plans.gold import GOLD_SHORT, publish_gold, score_gems, to_gold
from sleeper.plans.silver import SilverResult, bronze_to_silver
from sleeper.session import materialize
from sleeper.sinks.files import parquet_upsert, write_bronze, write_run_metadata
from sleeper.sources.files import read_silver


def run_metadata(spark: SparkSession, res: X.ExtractResult, tagged_sources: DataFrame, profile: Profile,
                 run_ts: dt.datetime | None = None, reported_total: DataFrame | None = None,
                 profile_name: str = "default") -> DataFrame:
    """One-row run document: time, profile and its parameters, the store's reported
    total (a one-row frame), per-source unique ids, combined candidates (after the
    cap), funnel counters and the result count. Every value is a scalar subquery over
    the run's data."""
    names = [r["source"] for r in tagged_sources.select("source", "prio").distinct().orderBy("prio").collect()]
    # one aggregate per input, each returning a struct: four small jobs in all
    per_source = tagged_sources.select(F.struct(*[
        F.count_distinct(F.when(F.col("source") == n, F.col("appid"))).alias(f"{n}_ids_unicos")
        for n in names])).scalar()
    combined = res.candidates.select(F.count(F.lit(1))).scalar()
    total = [reported_total.scalar().alias("total_reportado")] if reported_total is not None else []
    fuentes = F.struct(*total, *[per_source.getField(f"{n}_ids_unicos").alias(f"{n}_ids_unicos") for n in names],
                       combined.alias("candidatos_unicos_combinados"))
    ev = res.funnel.where("evaluated")
    stats = ev.select(F.struct(F.count(F.lit(1)).alias("evaluados"),
                               *[F.count_if(F.col("outcome") == o).alias(o) for o in OUTCOMES if o != ACCEPTED]
                               )).scalar()
    # fixed values: the key names of the document
    params = F.struct(*[F.lit(v).alias(k) for k, v in profile.as_dict().items()])
    ts = F.lit(run_ts).cast("timestamp") if run_ts is not None else F.current_timestamp()
    return spark.range(1).select(
        iso_seconds(ts).alias("fecha_ejecucion"), F.lit(profile_name).alias("perfil_activo"), params.alias("parametros"), fuentes.alias("fuentes"),
        stats.alias("estadisticas_evaluacion"),
        res.entries.select(F.count(F.lit(1))).scalar().alias("total_resultados"))


def extract_run(spark: SparkSession, sources: list[tuple[str, DataFrame]] | DataFrame, details: DataFrame,
                reviews: DataFrame, players: DataFrame, bronze_root: str, profile: Profile = Profile(),
                run_ts: dt.datetime | None = None) -> X.ExtractResult:
    """Candidates -> funnel -> Bronze JSONL in ``<bronze_root>/<run>/`` plus
    ``<run>/_meta`` (skipped by Bronze readers)."""
    run_ts = run_ts or dt.datetime.now().replace(microsecond=0)
    tagged = sources if isinstance(sources, DataFrame) else C.tag_sources(sources)
    tagged = materialize(tagged, "sources")
    res = X.evaluate_candidates(X.select_candidates(tagged, profile), details, reviews, players, profile)
    write_bronze(res.entries, bronze_root, run_ts=run_ts)
    write_run_metadata(run_metadata(spark, res, tagged, profile, run_ts), bronze_root,
                       run_ts.strftime("%Y-%m-%d_%H-%M-%S"))
    return res


def extract_run_from_pages(spark: SparkSession, search: DataFrame, charts: DataFrame, ranks: DataFrame,
                           details: DataFrame, reviews: DataFrame, players: DataFrame, bronze_root: str,
                           profile: Profile = Profile(), run_ts: dt.datetime | None = None,
                           profile_name: str = "default") -> X.ExtractResult:
    """:func:`extract_run` from landed store, chart and ranked-list pages."""
    run_ts = run_ts or dt.datetime.now().replace(microsecond=0)
    src = X.sources_from_pages(search, charts, ranks, profile)
    res = X.evaluate_candidates(X.select_candidates(src.tagged, profile), details, reviews, players, profile,
                                src.chart_ranks)
    write_bronze(res.entries, bronze_root, run_ts=run_ts)
    write_run_metadata(run_metadata(spark, res, src.tagged, profile, run_ts, src.reported_total, profile_name),
                       bronze_root, run_ts.strftime("%Y-%m-%d_%H-%M-%S"))
    return res


def silver_run(spark: SparkSession, bronze_root: str, silver_root: str, rules=DQ.RULES_SILVER,
               quarantine: bool = True) -> SilverResult:
    return bronze_to_silver(spark, bronze_root, silver_root, rules, quarantine)


def gold_run(spark: SparkSession, silver_path: str, gold_path: str, params: ScoreParams = ScoreParams(),
             history_path: str | None = None, table_path: str | None = None,
             update_cols: list[str] | None = None, run_date: dt.date | None = None) -> DataFrame:
    """Dedup -> score -> Gold snapshot (+ score history, + keyed upsert of the
    5-column projection). The Gold rows are written once and every sink reads them."""
    gold = materialize(to_gold(score_gems(read_silver(spark, silver_path), params)), "gold")
    publish_gold(gold, gold_path, history_path, run_date or dt.date.today())
    if table_path is not None:
        parquet_upsert(gold.select(*GOLD_SHORT), table_path, "appid", update_cols)
    return spark.read.parquet(gold_path)


def insight_report(gold: DataFrame, k: int = 50, per_genre: int = 3,
                   history: DataFrame | None = None) -> dict[str, DataFrame]:
    """Q1 top gems overall and per genre, Q2 genre concentration, tier mix and, with the score
    history (appid, run_date, hidden_gem_score), Q3 the items that rise."""
    rising = {} if history is None else {"rising": insights.rising(history, run="run_date")}
    return rising | {
        "top": insights.top_gems(gold, k),
        "top_per_genre": insights.rank_within(insights.explode_genres(gold), "genero", per_genre),
        "genres": insights.genre_concentration(gold),
        "tiers": insights.tier_distribution(gold),
    }
