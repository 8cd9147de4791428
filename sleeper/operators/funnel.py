"""First-fail evaluation funnel with a result target and an evaluation budget."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sleeper.config import Profile
from sleeper.functions.ids import safe_int
from sleeper.functions.text import is_target_label, join_list, pluck
from sleeper.operators.ordering import kth_smallest

# Outcome names, in the order the checks run.
ERROR_DETAILS = "error_detalles"
NOT_A_GAME = "descartado_no_juego"
ERROR_REVIEWS = "error_resenas"
BAD_LABEL = "descartado_label"
LOW_SCORE = "descartado_puntaje"
REVIEW_COUNT = "descartado_cantidad_resenas"
TOO_MANY_PLAYERS = "descartado_jugadores_actuales"
ACCEPTED = "accepted"
OUTCOMES = (ERROR_DETAILS, NOT_A_GAME, ERROR_REVIEWS, BAD_LABEL, LOW_SCORE, REVIEW_COUNT,
            TOO_MANY_PLAYERS, ACCEPTED)
EVALUATED = "evaluados"
ITEM_TYPE = "game"


def classify(profile: Profile) -> Column:
    """First failing check of an enriched candidate row, else 'accepted'.

    Expects details_ok, details (struct), reviews_ok, summary (struct), players.
    """
    s = F.col("summary")
    score = s.getField("review_score")
    total = F.coalesce(s.getField("total_reviews"), F.lit(0))
    players_ok = F.lit(True)
    if profile.max_current_players is not None and not profile.skip_current_players:
        players_ok = F.col("players").isNull() | (F.col("players") <= profile.max_current_players)
    return (F.when(~F.coalesce(F.col("details_ok"), F.lit(False)), F.lit(ERROR_DETAILS))
             .when(F.coalesce(F.col("details").getField("type"), F.lit("")) != ITEM_TYPE, F.lit(NOT_A_GAME))
             .when(~F.coalesce(F.col("reviews_ok"), F.lit(False)), F.lit(ERROR_REVIEWS))
             .when(~is_target_label(s.getField("review_score_desc"), profile.allow_very_positive),
                   F.lit(BAD_LABEL))
             .when(F.coalesce(score < profile.min_review_score, F.lit(True)), F.lit(LOW_SCORE))
             .when(~total.between(profile.min_total_reviews, profile.max_total_reviews), F.lit(REVIEW_COUNT))
             .when(~players_ok, F.lit(TOO_MANY_PLAYERS))
             .otherwise(F.lit(ACCEPTED)))


def enrich(candidates: DataFrame, payloads: DataFrame, key: str = "appid") -> DataFrame:
    """Candidates left-joined with their latest details / reviews / players payloads
    (one row per key, see ``sources.payloads.latest_payloads``) and parsed into
    details_ok, details, reviews_ok, summary and players."""
    from sleeper.sources.payloads import details_columns, players_column, reviews_columns

    j = candidates.join(payloads, key, "left")
    return j.select(*[F.col(c) for c in candidates.columns],
                    *details_columns(F.col("details"), F.col(key)),
                    *reviews_columns(F.col("reviews")),
                    players_column(F.col("players")))


def stop_rank(classified: DataFrame, profile: Profile, rank: str = "candidate_rank") -> Column:
    """Last evaluated rank: the budget, or the rank of the ``target``-th acceptance.

    Walking the list in order, row ``i`` is evaluated iff ``i <= max_evaluations``
    and fewer than ``target`` rows before it were accepted. Because acceptance is
    decided per row, that is ``i <= min(max_evaluations, r_T)`` where ``r_T`` is
    the rank of the ``target``-th accepted row: an order statistic, not a running
    window over the whole list, and no list of ``target`` rows. A target or a budget of 0 evaluates nothing; a
    budget of None has no limit.
    """
    if profile.target <= 0:
        return F.lit(0)
    accepted = classified.where(F.col("outcome") == ACCEPTED)
    return F.least(F.lit(profile.max_evaluations).cast("long"), kth_smallest(accepted, rank, profile.target))


def run_funnel(enriched: DataFrame, profile: Profile, rank: str = "candidate_rank") -> DataFrame:
    """Adds ``outcome`` and ``evaluated``; rows beyond the stop are not evaluated."""
    classified = enriched.withColumn("outcome", classify(profile))
    cut = stop_rank(classified, profile, rank)
    return classified.withColumn("evaluated", F.coalesce(F.col(rank) <= cut, F.lit(True)))


def funnel_stats(funnel: DataFrame) -> DataFrame:
    """Long-form counters over evaluated rows: (outcome, n), plus ('evaluados', total)."""
    ev = funnel.where("evaluated")
    by_outcome = ev.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))
    total = ev.agg(F.count(F.lit(1)).alias("n")).select(F.lit(EVALUATED).alias("outcome"), "n")
    return by_outcome.unionByName(total)


def build_entry(df: DataFrame, key: str = "appid", more: list[Column] | None = None) -> DataFrame:
    """Flatten an enriched row into the Bronze record (16 fields + the free flag).

    An id that the record's type can't hold is NULL and fails the completeness rule
    of the id, instead of ending the job."""
    d = F.col("details")
    s = F.col("summary")
    meta = d.getField("metacritic")
    return df.select(
        F.col(key).try_cast("int").alias("appid"),
        F.coalesce(d.getField("name"), F.concat(F.lit("App "), F.col(key).cast("string"))).alias("nombre"),
        F.col("players").try_cast("int").alias("jugadores_actuales_api"),
        join_list(d.getField("developers")).alias("desarrolladores"),
        join_list(d.getField("publishers")).alias("editores"),
        join_list(pluck(d.getField("genres"), "description")).alias("generos"),
        d.getField("release_date").getField("date").alias("fecha_lanzamiento"),
        d.getField("price_overview").getField("final_formatted").alias("precio"),
        safe_int(meta.getField("score")).try_cast("int").alias("metacritic_score"),
        meta.getField("url").alias("metacritic_url"),
        F.coalesce(d.getField("short_description"), F.lit("")).alias("descripcion_corta"),
        s.getField("total_reviews").alias("total_resenas"),
        s.getField("total_positive").alias("resenas_positivas"),
        s.getField("total_negative").alias("resenas_negativas"),
        s.getField("review_score").alias("puntuacion"),
        s.getField("review_score_desc").alias("descripcion_puntuacion"),
        d.getField("is_free").alias("es_gratis"),
        *(more or []),
    )
