"""Registered queries: each takes (spark, sf_dir) and returns a lazy DataFrame.

They run the library's operators over the driver tables (see ``workload``).
Column names match the DuckDB oracles in ``oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sleeper.config import Profile, ScoreParams
from sleeper.functions.ids import safe_int
from sleeper.functions.price import parse_price
from sleeper.functions.text import is_target_label, normalize_text, slug, split_list
from sleeper.operators import candidates as C
from sleeper.operators import insights
from sleeper.operators import quality as DQ
from sleeper.operators.dedup import latest_per_key
from sleeper.operators.funnel import funnel_stats
from sleeper.operators.mapping import apply_mapping
from sleeper.operators.score import score_items
from sleeper.operators.upsert import upsert
from sleeper.plans import extract as X
from sleeper.plans import landing as L
from sleeper.plans import workload as W
from sleeper.session import materialize
from sleeper.sources import payloads as P

DRIVER_SCORE = ScoreParams(price_cap=W.DRIVER_PRICE_CAP, tier_s=W.DRIVER_TIER_S,
                           tier_a=W.DRIVER_TIER_A)

SCORE_COLS = ["appid", "nombre", "generos", "precio", "total_resenas", "resenas_positivas",
              "resenas_negativas", "puntuacion", "quality_score", "obscurity_score", "price_score",
              "hidden_gem_score", "tier"]


SCORE_INPUT = ["precio", "total_resenas", "resenas_positivas"]


def gold_catalog(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    """The catalogue is read twice (the max subquery and the scoring pass), so what the
    score needs and ``cols`` are written once rather than re-aggregating lineitem per reader."""
    return score_items(materialize(W.catalog(spark, sf_dir).select(*cols, *SCORE_INPUT), "catalog"), DRIVER_SCORE)


def silver_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots with the price text parsed (the Silver price column)."""
    snaps = W.snapshots(spark, sf_dir)
    return snaps.withColumns({"precio_raw": F.col("precio"), "precio": parse_price("precio", "es_gratis")})


def score_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every run scored against that run's own maximum."""
    snaps = silver_snapshots(spark, sf_dir).select("appid", "run", *SCORE_INPUT)
    return score_items(materialize(snaps, "snapshots"), DRIVER_SCORE, by=["run"])


def q_hgs_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_catalog(spark, sf_dir, "appid", "nombre", "generos", "resenas_negativas", "puntuacion").select(*SCORE_COLS)


def q_hgs_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = gold_catalog(spark, sf_dir, "appid", "nombre", "generos").select("appid", "nombre", "generos", "hidden_gem_score", "tier")
    return insights.top_gems(g, 20)


def q_hgs_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every item of the catalogue in the order of q_hgs_topk."""
    g = gold_catalog(spark, sf_dir, "appid").select("appid", "hidden_gem_score", "tier")
    return insights.top_gems(g, None)


def q_tier_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.tier_distribution(gold_catalog(spark, sf_dir))


def q_genre_concentration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.genre_concentration(gold_catalog(spark, sf_dir, "generos"))


def q_rank_within_genre(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = insights.explode_genres(gold_catalog(spark, sf_dir, "appid", "nombre", "generos"))
    return insights.rank_within(g, "genero", 3).select(
        "genero", "appid", "nombre", "hidden_gem_score", "tier", "group_rank")


def q_rising(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = score_history(spark, sf_dir).select("appid", "run", "hidden_gem_score")
    return insights.rising(h).select("appid", "run", "prev_score", "hidden_gem_score",
                                     "score_delta", "rise_streak")


def q_latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    snaps = W.snapshots(spark, sf_dir).select("appid", "run", "nombre", "total_resenas", "resenas_positivas",
                                              "puntuacion")
    return latest_per_key(snaps, ["appid"], ["run"])


# Candidate sources over the whole lineitem table: the most-sold parts, the parts
# with the largest quantity and the most-returned parts (ties by part key).
DRIVER_PROFILE = Profile(target=3, max_candidates=400, max_evaluations=300, min_review_score=8,
                         min_total_reviews=20, max_total_reviews=45, allow_very_positive=True,
                         max_current_players=18)


def candidate_sources(spark: SparkSession, sf_dir: str, limits: tuple = (300, 300, 100)) -> DataFrame:
    """Tagged (source, prio, appid, pos): three ranked lists from one lineitem pass."""
    li = W.table(spark, sf_dir, "lineitem")
    per_part = li.groupBy(F.col("l_partkey").alias("appid")).agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum("l_quantity").alias("qty"),
        F.count_if(F.col("l_returnflag") == "R").alias("returns"))
    key = F.col("appid")
    values = {"top_lines": -F.col("lines"), "top_quantity": -F.col("qty"), "top_returns": -F.col("returns")}
    return C.top_ranked_many(per_part, [(n, k, [v, key]) for (n, v), k in zip(values.items(), limits)])


def q_candidates_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first two lists whole and the first 1,500 of the third, merged without a cap."""
    merged = C.merge_sources(candidate_sources(spark, sf_dir, (None, None, 1500)))
    return merged.withColumn("sources", F.array_join("sources", ","))


def driver_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.select_candidates(candidate_sources(spark, sf_dir), DRIVER_PROFILE)


def landed_payloads(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(details, reviews, players) payload tables; the two that need lineitem
    statistics share one aggregate."""
    stats = materialize(L.item_stats(spark, sf_dir), "item_stats")
    return (L.details_payloads(spark, sf_dir), L.reviews_payloads(spark, sf_dir, stats),
            L.players_payloads(spark, sf_dir, stats))


def driver_extract(spark: SparkSession, sf_dir: str) -> X.ExtractResult:
    return X.evaluate_candidates(driver_candidates(spark, sf_dir), *landed_payloads(spark, sf_dir),
                                 DRIVER_PROFILE)


def q_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = driver_candidates(spark, sf_dir)
    return c.select("candidate_rank", "appid", "first_source", "first_pos",
                    F.array_join("sources", ",").alias("sources"))


def q_funnel_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = driver_extract(spark, sf_dir).funnel
    return f.where("evaluated").select("candidate_rank", "appid", "outcome")


def q_funnel_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return funnel_stats(driver_extract(spark, sf_dir).funnel)


def q_funnel_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return driver_extract(spark, sf_dir).entries


def q_flatten_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part's landed payloads parsed back and flattened to a Bronze record."""
    items = W.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("appid"))
    from sleeper.operators.funnel import build_entry, enrich
    details, reviews, players = landed_payloads(spark, sf_dir)
    latest = P.latest_payloads(items, {"details": details, "reviews": reviews, "players": players})
    e = enrich(items, latest)
    return build_entry(e)


def q_ranked_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First two entries of every ranked list; the last occurrence of an id wins."""
    r = P.parse_ranks(L.ranks_payloads(spark, sf_dir), limit=2, list_cols=["list_id", "list_page"])
    last = r.groupBy("appid").agg(F.max(F.struct("list_id", "list_page", "pos", "rank")).alias("last"))
    return last.select("appid", "last.list_id", "last.list_page", "last.rank")


def q_search_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.session_first_ids(L.search_pages(spark, sf_dir))


def q_search_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each session reports to hold, beside :func:`q_search_pages` one session a nation whose pages list nothing."""
    pages = L.search_pages(spark, sf_dir)
    nothing = W.table(spark, sf_dir, "nation").select(
        (-1 - F.col("n_nationkey")).cast(pages.schema["session_id"].dataType).alias("session_id"),
        F.lit(0).cast(pages.schema["page_idx"].dataType).alias("page_idx"),
        F.to_json(F.struct((F.col("n_nationkey") + 5).cast("string").alias("total_count"),
                           F.lit("<p>nothing found</p>").alias("results_html"))).alias("payload"))
    return P.session_first(pages.unionByName(nothing))[1]


def q_html_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    # one crawl session per site: pages of a host in page order, each site stopping
    # at its first page without links
    host = F.regexp_extract(F.col("url"), r"^[a-z]+://([^/?#]+)", 1)
    pages = W.table(spark, sf_dir, "pages").select(
        host.alias("session_id"), F.col("page_id").alias("page_idx"), "html")
    out = P.chart_page_links(pages, r'href="/([^"]+)"', as_ids=False)
    return out.select(F.col("page_idx").alias("page_id"), "pos", F.col("value").alias("link"))


def q_parse_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = W.table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    text = F.when(key % 97 == 3, F.lit("Free")).otherwise(W.price_text(F.col("p_retailprice"), key % 6))
    return p.select(key.alias("appid"), (key % 6).alias("price_style"),
                    parse_price(text, is_free=(key % 2 == 0)).alias("precio"))


def q_normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = W.table(spark, sf_dir, "documents").select("doc_id", "text")
    n = d.withColumn("norm", normalize_text("text"))
    return n.select("doc_id", F.md5("norm").alias("norm_md5"), F.octet_length("norm").alias("norm_bytes"),
                    is_target_label("text", allow_very_positive=True).alias("is_label"))


def q_safe_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = W.table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k")
    return e.select("event_id",
                    safe_int(k).alias("v_plain"),
                    safe_int(F.concat(F.lit(" "), k, F.lit(" "))).alias("v_padded"),
                    safe_int(F.concat(k, F.lit(".5"))).alias("v_fraction"),
                    safe_int(F.concat(F.lit("x"), k)).alias("v_junk"))


def q_slug(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = W.table(spark, sf_dir, "part")
    text = F.when(F.col("p_partkey") % 89 == 0, F.lit("!!! ?")).otherwise(
        F.concat(F.col("p_name"), F.lit("! #"), F.col("p_brand"), F.lit(" (v"),
                 F.col("p_size").cast("string"), F.lit(")")))
    return p.select(F.col("p_partkey").alias("appid"), slug(text).alias("slug"))


def q_dq_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return DQ.outcomes(silver_snapshots(spark, sf_dir), DQ.RULES_SILVER)


def q_dq_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    _passed, rejected = DQ.split(silver_snapshots(spark, sf_dir), DQ.RULES_SILVER)
    return rejected.select("appid", "run", F.array_join("failed_rules", ", ").alias("failed_rules"))


def q_dq_passed(spark: SparkSession, sf_dir: str) -> DataFrame:
    passed, _rejected = DQ.split(silver_snapshots(spark, sf_dir), DQ.RULES_SILVER)
    return passed.groupBy("run").agg(F.count(F.lit(1)).alias("rows"))


def q_readme_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return DQ.outcomes(silver_snapshots(spark, sf_dir), DQ.RULES_README)


ORDERS_MAPPING = [
    ("o_orderkey", "bigint", "order_id", "bigint"),
    ("o_custkey", "bigint", "customer_id", "int"),
    ("o_orderstatus", "string", "status", "string"),
    ("o_totalprice", "double", "total_price", "double"),
    ("o_orderdate", "timestamp", "order_date", "date"),
    ("o_orderpriority", "string", "priority_level", "int"),
]


def q_apply_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_mapping(W.table(spark, sf_dir, "orders"), ORDERS_MAPPING)


def _gold_between(snaps: DataFrame, lo: int, hi: int) -> DataFrame:
    latest = materialize(latest_per_key(snaps.where(F.col("run").between(lo, hi)), ["appid"], ["run"]),
                         "latest")
    g = score_items(latest, DRIVER_SCORE)
    return g.select(F.col("appid").cast("long").alias("appid"), "nombre", "precio", "hidden_gem_score", "tier")


def _gold_target_and_updates(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Gold as of runs up to 1999 (the table) and as of runs 2000+ (the updates),
    both from one materialized snapshot table."""
    snaps = materialize(silver_snapshots(spark, sf_dir).select("appid", "run", "nombre", *SCORE_INPUT), "snapshots")
    return _gold_between(snaps, 0, 1999), _gold_between(snaps, 2000, 9999)


def q_upsert_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, updates = _gold_target_and_updates(spark, sf_dir)
    return upsert(target, updates, "appid")


def q_upsert_name_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, updates = _gold_target_and_updates(spark, sf_dir)
    return upsert(target, updates, "appid", update_cols=["nombre"])


# ---------------------------------------------------------------------------
# jobs over landed files (each writes under the shared checkpoint dir, then reads back)
# ---------------------------------------------------------------------------

def _land_snapshots(spark: SparkSession, sf_dir: str, root: str | None = None, lo: int = 0,
                    hi: int = 9999, snaps: DataFrame | None = None) -> str:
    """Land the snapshot runs lo..hi as Bronze JSONL (one folder per run) in one job."""
    from sleeper.sinks.files import write_bronze
    from sleeper.session import scratch_path

    root = root or scratch_path(spark, "bronze")
    snaps = (snaps if snaps is not None else W.snapshots(spark, sf_dir)).where(F.col("run").between(lo, hi))
    snaps = snaps.withColumn("run_ts", F.to_timestamp(F.format_string("%d-01-01", F.col("run")))).drop("run")
    write_bronze(snaps, root, run_ts_col="run_ts")
    return root


def q_bronze_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sleeper.functions.runs import run_folder
    from sleeper.schemas import BRONZE_COLUMNS
    from sleeper.sources.files import read_bronze

    b = read_bronze(spark, _land_snapshots(spark, sf_dir))
    return b.select(*BRONZE_COLUMNS, run_folder("run_ts").alias("run_folder"))


def q_parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue written as Snappy Parquet in several files (``maxRecordsPerFile``)
    and read back by the recursive multi-file scan: every row comes back."""
    from sleeper.sinks.files import write_parquet
    from sleeper.session import scratch_path
    from sleeper.sources.files import read_parquet_tree

    path = scratch_path(spark, "catalog_parquet")
    cat = W.catalog(spark, sf_dir)
    write_parquet(cat, path, max_records_per_file=500)
    return read_parquet_tree(spark, path, cat.schema)


def _silver(spark: SparkSession, sf_dir: str):
    from sleeper.plans.silver import bronze_to_silver
    from sleeper.session import scratch_path

    return bronze_to_silver(spark, _land_snapshots(spark, sf_dir), scratch_path(spark, "silver"))


def q_bronze_to_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sleeper.functions.runs import run_folder
    from sleeper.sources.files import read_silver

    s = read_silver(spark, _silver(spark, sf_dir).path)
    return s.select("appid", run_folder("run_ts").alias("run_folder"), "nombre", "precio", "precio_raw",
                    "total_resenas", "resenas_positivas", "puntuacion")


def q_silver_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule counters collected by Observation during the Silver write (no second scan)."""
    res = _silver(spark, sf_dir)
    return spark.createDataFrame(res.outcomes, "rule string, evaluated long, failed long, "
                                               "pass_ratio double, outcome string").select(
        "rule", "evaluated", "failed", "outcome")


def q_gold_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sleeper.plans.gold import publish_gold, score_gems, to_gold
    from sleeper.session import scratch_path
    from sleeper.sources.files import read_silver

    silver = read_silver(spark, _silver(spark, sf_dir).path)
    gold_path = scratch_path(spark, "gold")
    publish_gold(to_gold(score_gems(silver, DRIVER_SCORE)), gold_path)
    return spark.read.parquet(gold_path).drop("updated_at")


def q_score_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sleeper.sinks.files import append_history
    from sleeper.session import scratch_path

    path = scratch_path(spark, "history")
    h = score_history(spark, sf_dir).select(
        F.col("appid").cast("long").alias("appid"), "hidden_gem_score", "tier",
        F.make_date(F.col("run"), F.lit(1), F.lit(1)).alias("run_date"))
    append_history(h, path)
    return spark.read.parquet(path).select("appid", "run_date", "hidden_gem_score", "tier")


def q_gold_upsert_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish runs up to 1999, then upsert 2000+ with the name-only policy."""
    from sleeper.sinks.files import parquet_upsert
    from sleeper.session import scratch_path

    path = scratch_path(spark, "gold_table")
    target, updates = _gold_target_and_updates(spark, sf_dir)
    parquet_upsert(target, path, "appid")
    return parquet_upsert(updates, path, "appid", update_cols=["nombre"]).read()


def q_table_reopened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table made with 5 buckets, opened again with another number and by its path alone, and upserted each time:
    the recorded contract holds, so no key is there twice. A version that was never made current is not read."""
    from sleeper.sinks.tables import KeyedTable
    from sleeper.session import scratch_path

    path = scratch_path(spark, "reopened")
    target, updates = _gold_target_and_updates(spark, sf_dir)
    KeyedTable.create_if_absent(spark, path, target.schema, "appid", buckets=5).upsert(target)
    again = KeyedTable.create_if_absent(spark, path, updates.schema, "appid", buckets=7)
    again.write(again.bucketed(updates))  # as a writer that ends here leaves it
    again.upsert(updates, update_cols=["nombre"])
    table = KeyedTable.open(spark, path)
    table.upsert(updates)
    return table.read()


def q_run_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The extract run's metadata document: parameters, source counts, funnel counters."""
    from sleeper.plans.runs import run_metadata
    from sleeper.sinks.files import write_run_metadata
    from sleeper.session import scratch_path

    sources = materialize(candidate_sources(spark, sf_dir), "sources")
    res = X.evaluate_candidates(X.select_candidates(sources, DRIVER_PROFILE), *landed_payloads(spark, sf_dir),
                                DRIVER_PROFILE)
    meta = run_metadata(spark, res, sources, DRIVER_PROFILE)
    path = write_run_metadata(meta, scratch_path(spark, "bronze_meta"), "run")
    back = spark.read.schema(meta.schema).json(path)
    return back.select("fuentes.*", "estadisticas_evaluacion.*", "total_resultados")


def q_stream_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three landing waves out of order, the oldest run in a folder without a run's name, each
    followed by an availableNow Silver increment and a Gold increment; the result equals the
    batch Gold."""
    from sleeper.session import scratch_path
    from sleeper.streaming.incremental import run_gold_increment, run_silver_increment

    bronze, silver, state = (scratch_path(spark, n) for n in ("bronze", "silver", "latest"))
    silver_ckpt, gold_ckpt = scratch_path(spark, "silver_ckpt"), scratch_path(spark, "gold_ckpt")
    snaps = materialize(W.snapshots(spark, sf_dir), "snapshots")  # the source of all three waves
    oldest = snaps.agg(F.min("run")).first()[0] or 0
    gold = None
    for lo, hi in ((2000, 9999), (oldest, 1997), (1998, 1999)):
        if lo == oldest:
            snaps.where(F.col("run") == oldest).drop("run").write.option("ignoreNullFields", "false") \
                .json(f"{bronze}/unnamed")
        _land_snapshots(spark, sf_dir, bronze, lo + (lo == oldest), hi, snaps)
        run_silver_increment(spark, bronze, silver, silver_ckpt)
        gold = run_gold_increment(spark, silver, state, gold_ckpt, DRIVER_SCORE)
    return gold.select(F.col("appid").cast("long").alias("appid"), "nombre", "precio", "total_resenas",
                       "hidden_gem_score", "tier")


def q_gold_waves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per landing wave, none in the order of its runs: the items that came, the items that Gold holds, and the
    maximum that its scores are measured by; all scores are made again only in waves that move it."""
    from sleeper.session import scratch_path
    from sleeper.streaming.incremental import run_gold_delta, run_silver_increment

    bronze, silver, state = (scratch_path(spark, n) for n in ("bronze", "silver", "gold_state"))
    silver_ckpt, gold_ckpt = scratch_path(spark, "silver_ckpt"), scratch_path(spark, "gold_ckpt")
    snaps = materialize(W.snapshots(spark, sf_dir), "snapshots")
    seen = []
    for wave, (lo, hi) in enumerate(((0, 1995), (1997, 9999), (1996, 1996))):
        _land_snapshots(spark, sf_dir, bronze, lo, hi, snaps)
        run_silver_increment(spark, bronze, silver, silver_ckpt)
        got = run_gold_delta(spark, silver, state, gold_ckpt, DRIVER_SCORE)
        seen.append((wave, got.arrived, got.rows.count(), got.maximum, got.rescored_all))
    return spark.createDataFrame(seen, "wave int, arrived long, items long, maximum int, rescored boolean")


def q_rising_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`q_rising` kept run by run: the runs come one or two at a time, two of them late, one again."""
    from sleeper.plans.rising import advance, read_changes
    from sleeper.session import scratch_path

    h = materialize(score_history(spark, sf_dir).select("appid", "run", "hidden_gem_score"), "history")
    root = scratch_path(spark, "rising")
    for lo, hi in ((0, 1993), (1995, 1995), (1997, 9999), (1996, 1996), (1994, 1994), (1997, 1997)):
        advance(h.where(F.col("run").between(lo, hi)), root)
    return read_changes(spark, root).where("score_delta > 0").select(
        F.col("appid").cast("int").alias("appid"), "run", "prev_score", "hidden_gem_score", "score_delta", "rise_streak")


def _history_of_runs(spark: SparkSession, sf_dir: str) -> str:
    """Outcomes of two Silver runs and of a stream's batch; the first run is replayed once."""
    from sleeper.plans.silver import bronze_to_silver
    from sleeper.session import scratch_path
    from sleeper.streaming.incremental import run_silver_increment

    path = scratch_path(spark, "dq_history")
    snaps = materialize(W.snapshots(spark, sf_dir), "snapshots")
    for run, lo, hi in (("early", 0, 1996), ("late", 1997, 9999), ("early", 0, 1996)):
        bronze_to_silver(spark, _land_snapshots(spark, sf_dir, None, lo, hi, snaps), scratch_path(spark, "silver"),
                         table_rules=TABLE_RULES, best_effort=True, history_path=path, run=run)
    run_silver_increment(spark, _land_snapshots(spark, sf_dir, None, 0, 9999, snaps), scratch_path(spark, "silver"),
                         scratch_path(spark, "silver_ckpt"), history_path=path)
    return path


# One rule on the table that holds and one that the withheld names and prices break.
TABLE_RULES = (DQ.column_count_above(0), DQ.row_count_at_least(1), DQ.pass_share_at_least(0.999))


def q_dq_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The committed outcomes of every row and table rule by run."""
    from sleeper.sinks.outcomes import read_outcomes

    return read_outcomes(spark, _history_of_runs(spark, sf_dir)).select(
        "run", "scope", "rule", "evaluated", "failed", "outcome")


def q_table_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table rules of one Silver run in best-effort mode: their values from the write's own counters."""
    from sleeper.plans.silver import bronze_to_silver
    from sleeper.session import scratch_path

    res = bronze_to_silver(spark, _land_snapshots(spark, sf_dir), scratch_path(spark, "silver"),
                           table_rules=TABLE_RULES, best_effort=True)
    return spark.createDataFrame([(o["rule"], o["value"], o["outcome"]) for o in res.table_outcomes],
                                 "rule string, value double, outcome string")


# Thresholds under which every outcome of the funnel occurs; nothing is capped.
OPEN_PROFILE = Profile(target=2 ** 31 - 1, max_candidates=0, max_evaluations=None, min_review_score=8,
                       min_total_reviews=26, max_total_reviews=32, allow_very_positive=True, max_current_players=14)
PAGE_PROFILE = OPEN_PROFILE.with_overrides(store_pages=30, chart_pages=25)


def q_chart_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numeric chart ids in five sessions, each stopping at its first page without links."""
    from sleeper.functions.ids import CHART_LINK_PATTERN

    out = P.chart_page_links(L.chart_pages(spark, sf_dir, sessions=5), CHART_LINK_PATTERN)
    return out.select("session_id", "page_idx", "pos", F.col("value").alias("appid"))


def page_sources(spark: SparkSession, sf_dir: str) -> X.PageSources:
    return X.sources_from_pages(L.store_pages(spark, sf_dir), L.chart_pages(spark, sf_dir), L.top_list(spark, sf_dir),
                                PAGE_PROFILE)


def session_sources(spark: SparkSession, sf_dir: str) -> X.PageSources:
    """The lists of many sessions and ranked lists, whose number grows with part, supplier and customer."""
    return X.sources_from_pages(L.store_pages(spark, sf_dir, session_pages=PAGE_PROFILE.store_pages),
                                L.chart_pages(spark, sf_dir, session_pages=PAGE_PROFILE.chart_pages),
                                L.top_lists(spark, sf_dir), PAGE_PROFILE)


def q_candidates_from_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _page_candidates(session_sources(spark, sf_dir))


def q_candidates_from_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _page_candidates(page_sources(spark, sf_dir))


def _page_candidates(src: X.PageSources) -> DataFrame:
    c = X.select_candidates(src.tagged, PAGE_PROFILE)
    return c.select("candidate_rank", "appid", "first_source", F.array_join("sources", ",").alias("sources"))


def _extract_from_pages(spark: SparkSession, sf_dir: str, sources=page_sources) -> tuple[X.PageSources, X.ExtractResult]:
    src = sources(spark, sf_dir)
    cands = X.select_candidates(src.tagged, PAGE_PROFILE)
    return src, X.evaluate_candidates(cands, *landed_payloads(spark, sf_dir), PAGE_PROFILE, src.chart_ranks)


def q_entries_from_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`q_entries_from_pages` over many sessions and ranked lists."""
    return q_entries_from_pages(spark, sf_dir, session_sources)


def q_entries_from_pages(spark: SparkSession, sf_dir: str, sources=page_sources) -> DataFrame:
    """Accepted items with the lists they came from and their rank in the ranked list."""
    return _extract_from_pages(spark, sf_dir, sources)[1].entries.select(
        "appid", "nombre", "total_resenas", F.array_join("sources", ",").alias("sources"), "chart_rank")


def q_metadata_from_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run document of :func:`q_entries_from_sessions`."""
    return q_metadata_from_pages(spark, sf_dir, session_sources)


def q_metadata_from_pages(spark: SparkSession, sf_dir: str, sources=page_sources) -> DataFrame:
    """The run document of :func:`q_entries_from_pages`: profile, a parameter, reported total, counts."""
    from sleeper.plans.runs import run_metadata

    src, res = _extract_from_pages(spark, sf_dir, sources)
    meta = run_metadata(spark, res, src.tagged, PAGE_PROFILE, reported_total=src.reported_total, profile_name="pages")
    return meta.select("perfil_activo", F.col("parametros.store_pages").alias("store_pages"), "fuentes.*",
                       F.col("estadisticas_evaluacion.evaluados").alias("evaluados"), "total_resultados")


def q_funnel_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part through the funnel, without a cap, a budget or a target; all outcomes occur."""
    parts = W.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("appid"), F.col("p_partkey").alias("pos"))
    cands = X.select_candidates([("parts", parts)], OPEN_PROFILE)
    return funnel_stats(X.evaluate_candidates(cands, *landed_payloads(spark, sf_dir), OPEN_PROFILE).funnel)


def q_ranked_list_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All entries of every ranked list; the third of each is no integer and goes."""
    r = P.parse_ranks(L.ranks_payloads(spark, sf_dir), list_cols=["list_id", "list_page"])
    return r.groupBy("list_id").agg(F.count(F.lit(1)).alias("ids"), F.max("rank").alias("last_rank"))


def faulty_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.faulty_snapshots(spark, sf_dir).withColumn("precio", parse_price("precio", "es_gratis"))


def q_dq_outcomes_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in which every one of the rules fails somewhere."""
    return DQ.outcomes(faulty_silver(spark, sf_dir), DQ.RULES_SILVER)


def q_dq_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row, passed or not, with its outcome and the rules it fails, and its genres as an array."""
    rows = DQ.audit(faulty_silver(spark, sf_dir), DQ.RULES_SILVER)
    return rows.select("desarrolladores", "run", "outcome", F.size("failed_rules").alias("failed"),
                       F.size(split_list("generos")).alias("genres")).groupBy("run", "outcome").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("failed").alias("failed"), F.sum("genres").alias("genres"))


def q_readme_rules_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return DQ.outcomes(faulty_silver(spark, sf_dir), DQ.RULES_README)


def q_price_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Currency names with points before and after the number, signs on either side, spaces in it."""
    p = W.table(spark, sf_dir, "part")
    fixed = F.format_string("%.2f", F.col("p_retailprice"))
    comma, whole = F.replace(fixed, F.lit("."), F.lit(",")), F.format_string("%.0f", F.floor("p_retailprice").cast("double"))
    style = F.col("p_partkey") % 8
    text = (F.when(style == 0, F.concat(F.lit("S/."), whole)).when(style == 1, F.concat(F.lit("Rs. "), whole))
            .when(style == 2, F.concat(comma, F.lit(" pуб."))).when(style == 3, F.concat(F.lit("-"), fixed))
            .when(style == 4, F.concat(F.lit("- $ "), fixed)).when(style == 5, F.concat(fixed, F.lit(".")))
            .when(style == 6, F.concat(F.lit("CHF 1'"), F.substring(fixed, 1, 6))).otherwise(F.concat(F.lit("€"), comma)))
    return p.select(F.col("p_partkey").alias("appid"), parse_price(text).alias("precio"))


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: fn for name, fn in globals().items() if name.startswith("q_") and callable(fn)}
