"""Candidate selection: ranked id lists from several sources, merged in priority order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sleeper.operators.ordering import ONE_TASK, position_within, with_position

# Groups of one list that are cut to its limit before the last ranking step.
GROUPS = 64


def top_ranked_many(df: DataFrame, lists: list[tuple[str, int | None, list[Column]]], key: str = "appid",
                    pos: str = "pos", one_task: int = ONE_TASK) -> DataFrame:
    """Several top-k lists from one input in one pass: (source, prio, key, pos).

    ``lists`` is ``[(name, k, values), ...]`` in priority order, where ``values``
    are ascending sort values ending in ``key`` (negate a metric for "largest
    first") and a ``k`` of None keeps the whole list. The input is exploded to one row
    per (list, key) carrying that list's sort key, then ranked per list in two steps:
    inside groups of each list (by the key's hash), which trims before the shuffle
    (WindowGroupLimit), then among the first ``max(k)`` of every group.
    If GROUPS of them give one list more than ``one_task`` rows, there are as many groups as
    shuffle partitions, and the last step deals each list by range over all tasks
    (:func:`ordering.position_within`) instead of ranking it in one.
    """
    limits = [k for _, k, _ in lists]
    kmax = None if None in limits else max(limits)
    wide = kmax is None or kmax * GROUPS > one_task
    entries = []
    for prio, (name, _k, order) in enumerate(lists):
        sort = F.struct(*[o.alias(f"_s{i}") for i, o in enumerate(order)])
        entries.append(F.struct(F.lit(name).alias("source"), F.lit(prio).alias("prio"), sort.alias("sort")))
    ex = df.select(F.col(key), F.explode(F.array(*entries)).alias("e")).select(key, "e.*")
    if kmax is not None:
        groups = max(GROUPS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))) if wide else GROUPS
        ex = ex.withColumn("_group", F.pmod(F.xxhash64(key), F.lit(groups)))
        inside = Window.partitionBy("source", "_group").orderBy("sort")
        ex = ex.withColumn("_r", F.row_number().over(inside)).where(F.col("_r") <= kmax).drop("_r", "_group")
    if wide:
        ranked = position_within(ex, "source", ["sort"], pos)
    else:
        last = Window.partitionBy("source").orderBy("sort")
        ranked = ex.withColumn(pos, F.row_number().over(last)).where(F.col(pos) <= kmax)
    kept = F.create_map(*[x for name, k, _ in lists for x in (F.lit(name), F.lit(k).cast("long"))])
    limit = F.element_at(kept, F.col("source"))
    return (ranked.where(limit.isNull() | (F.col(pos) <= limit))
                  .select("source", "prio", key, F.col(pos).cast("long").alias(pos)))


def first_occurrence(ids: DataFrame, key: str = "appid", pos: str = "pos",
                     by: list[str] | None = None) -> DataFrame:
    """Ordered distinct, keep first: one row per key (per ``by`` group) at its first position."""
    return ids.groupBy(*(by or []), key).agg(F.min(pos).alias(pos))


def tag_sources(sources: list[tuple[str, DataFrame]], key: str = "appid", pos: str = "pos") -> DataFrame:
    """``[(name, DataFrame(key, pos)), ...]`` in priority order -> (source, prio, key, pos)."""
    tagged = None
    for prio, (name, df) in enumerate(sources):
        t = df.select(F.lit(name).alias("source"), F.lit(prio).alias("prio"), F.col(key),
                      F.col(pos).cast("long").alias(pos))
        tagged = t if tagged is None else tagged.unionByName(t)
    return tagged


def merge_sources(sources: list[tuple[str, DataFrame]] | DataFrame, max_candidates: int = 0,
                  key: str = "appid", pos: str = "pos") -> DataFrame:
    """Union of id lists in priority order, duplicates merged.

    ``sources`` is ``[(name, DataFrame(key, pos)), ...]`` in priority order, or an
    already tagged DataFrame (source, prio, key, pos).
    Result: candidate_rank (1-based, first-seen order), key, first_source,
    first_pos and ``sources`` (sorted names of every list the id appears in).
    The per-key aggregate is partial+final; ``collect_set`` holds at most one
    entry per source. With ``max_candidates > 0`` only that prefix is kept.
    """
    tagged = sources if isinstance(sources, DataFrame) else tag_sources(sources, key, pos)
    merged = tagged.groupBy(key).agg(
        F.min(F.struct("prio", pos, "source")).alias("first"),
        F.array_sort(F.collect_set("source")).alias("sources"),
    ).select(key, F.col("first.prio").alias("prio"), F.col(f"first.{pos}").alias("first_pos"),
             F.col("first.source").alias("first_source"), "sources")
    ranked = with_position(merged, [F.col("prio"), F.col("first_pos"), F.col(key)], "candidate_rank")
    if max_candidates > 0:
        ranked = ranked.where(F.col("candidate_rank") <= max_candidates)
    return ranked.select("candidate_rank", key, "first_source", "first_pos", "sources")
