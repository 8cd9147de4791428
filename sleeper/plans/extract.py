"""Extract stage as Spark jobs: candidates (JOB-1) and the evaluation funnel (JOB-2)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sleeper.config import Profile
from sleeper.functions.ids import CHART_LINK_PATTERN
from sleeper.operators import candidates as C
from sleeper.operators import funnel as FN
from sleeper.operators.dedup import latest_per_key
from sleeper.session import materialize
from sleeper.sources import payloads as P


@dataclass
class ExtractResult:
    candidates: DataFrame   # candidate_rank, appid, first_source, first_pos, sources
    funnel: DataFrame       # candidates + outcome + evaluated
    entries: DataFrame      # accepted rows as 16-column Bronze records
    stats: DataFrame        # (outcome, n) over evaluated rows


#: The landed lists in the order in which they are merged, and the head of the ranked list.
STORE, CHARTS, TOP_LIST = "store", "charts", "top_list"
TOP_LIST_HEAD = 100


@dataclass
class PageSources:
    tagged: DataFrame       # (source, prio, appid, pos), each id at its first place in each list
    chart_ranks: DataFrame  # (appid, chart_rank): rank in the ranked list, the last entry of an id wins
    reported_total: DataFrame  # one row: what the store says it holds


def sources_from_pages(search: DataFrame, charts: DataFrame, ranks: DataFrame, profile: Profile,
                       head: int = TOP_LIST_HEAD) -> PageSources:
    """The three id lists of a run from its landed pages.

    ``search`` (session_id, page_idx, payload): store result pages, of which the
    profile reads ``store_pages`` up to the first without ids. ``charts``
    (session_id, page_idx from 1 on, html): ``chart_pages`` pages of links, likewise.
    ``ranks`` (payload): the ranked list, of which the first ``head`` entries count.
    A place in a list is page and place on it in one number.
    """
    store, totals = P.session_first(search, max_pages=profile.store_pages)
    store = materialize(store, "store_ids")
    links = P.chart_page_links(charts, CHART_LINK_PATTERN, max_pages=profile.chart_pages)
    top = materialize(P.parse_ranks(ranks, limit=head), "top_list")
    lists = [(STORE, store.select("appid", P.place("first_page", "first_pos").alias("pos"))),
             (CHARTS, links.select(F.col("value").alias("appid"), P.place("page_idx", "pos").alias("pos"))),
             (TOP_LIST, top.select("appid", "pos"))]
    tagged = C.first_occurrence(C.tag_sources(lists).where(F.col("appid").isNotNull()), by=["source", "prio"])
    last = latest_per_key(top, ["appid"], ["pos"], tiebreak=False)
    return PageSources(materialize(tagged, "sources"), last.select("appid", F.col("rank").alias("chart_rank")),
                       totals.agg(F.max("reported_total").alias("reported_total")))


def select_candidates(sources: list[tuple[str, DataFrame]] | DataFrame, profile: Profile,
                      materialized: bool = True) -> DataFrame:
    """JOB-1. ``sources``: [(name, DataFrame(appid, pos)), ...] in priority order, or
    a tagged DataFrame (source, prio, appid, pos). Duplicates within a source keep
    their first position. The (bounded) result is materialized once because the
    funnel reads it from several branches."""
    tagged = sources if isinstance(sources, DataFrame) else C.tag_sources(sources)
    firsts = C.first_occurrence(tagged, by=["source", "prio"])
    cands = C.merge_sources(firsts, profile.max_candidates)
    return materialize(cands, "candidates") if materialized else cands


def evaluate_candidates(cands: DataFrame, details: DataFrame, reviews: DataFrame,
                        players: DataFrame, profile: Profile, chart_ranks: DataFrame | None = None) -> ExtractResult:
    """JOB-2 over landed payload tables (appid, payload[, fetched_at]). With ``chart_ranks`` the
    entries also carry ``sources`` (array of the lists an item came from) and ``chart_rank``."""
    raws = {"details": details, "reviews": reviews, "players": players}
    latest = P.latest_payloads(cands, raws, order_by=["fetched_at"])
    enriched = FN.enrich(cands, latest)
    # read by the stop-rank subquery and by every output: parse and join once
    enriched = materialize(enriched, "enriched")
    funnel = FN.run_funnel(enriched, profile)
    accepted = funnel.where(F.col("evaluated") & (F.col("outcome") == FN.ACCEPTED))
    more = []
    if chart_ranks is not None:
        accepted = accepted.join(chart_ranks, "appid", "left")
        more = [F.col("sources"), F.col("chart_rank")]
    return ExtractResult(cands, funnel, FN.build_entry(accepted, more=more), FN.funnel_stats(funnel))
