"""The three questions asked of the Gold output.

Q1 top gems overall and per genre, Q2 genres that concentrate gems,
Q3 items whose score rises between runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sleeper.functions.scores import round_half_even
from sleeper.functions.text import split_list
from sleeper.operators.ordering import ONE_TASK, with_position

GEM_TIERS = ("S", "A")


def top_gems(df: DataFrame, k: int | None, score: str = "hidden_gem_score", key: str = "appid",
             rank_col: str = "gem_rank", one_task: int = ONE_TASK) -> DataFrame:
    """Top ``k`` by score (ties by key), or all rows in that order if ``k`` is None.

    Planned as TakeOrderedAndProject: each task keeps its own top ``k`` and only those
    reach the final merge. More than ``one_task`` rows are ranked by range over all tasks."""
    order = [F.col(score).desc_nulls_last(), F.col(key).asc()]
    if k is None or k > one_task:
        ranked = with_position(df, order, rank_col)
        return ranked if k is None else ranked.where(F.col(rank_col) <= k)
    top = df.orderBy(*order).limit(k)
    return top.withColumn(rank_col, F.row_number().over(Window.orderBy(*order)).cast("long"))


def rank_within(df: DataFrame, group: str, k: int, score: str = "hidden_gem_score",
                rank_col: str = "group_rank") -> DataFrame:
    """Rows ranked ``<= k`` within each group (``rank``, so ties are all kept).

    The filter on the rank lets the optimizer insert a partial WindowGroupLimit
    before the shuffle, so a hot group sends at most ``k`` rows (plus ties) per
    map task instead of all of its rows.
    """
    w = Window.partitionBy(group).orderBy(F.col(score).desc_nulls_last())
    ranked = df.withColumn(rank_col, F.rank().over(w)).where(F.col(rank_col) <= k)
    return ranked.withColumn(rank_col, F.col(rank_col).cast("long"))


def explode_genres(df: DataFrame, genres: str = "generos", out: str = "genero") -> DataFrame:
    return df.withColumn(out, F.explode(split_list(genres)))


def genre_concentration(df: DataFrame, genres: str = "generos", score: str = "hidden_gem_score",
                        tier: str = "tier", gem_tiers: tuple[str, ...] = GEM_TIERS,
                        digits: int = 4) -> DataFrame:
    """Per genre: items, gems (tier in ``gem_tiers``), gem share and mean score."""
    g = explode_genres(df, genres)
    agg = g.groupBy("genero").agg(
        F.count(F.lit(1)).alias("items"),
        F.count_if(F.col(tier).isin(*gem_tiers)).alias("gems"),
        F.avg(score).alias("_avg"),
    )
    return agg.select(
        "genero", "items", "gems",
        round_half_even(F.col("gems") / F.col("items"), digits).alias("gem_share"),
        round_half_even("_avg", digits).alias("avg_score"),
    )


def tier_distribution(df: DataFrame, score: str = "hidden_gem_score", tier: str = "tier",
                      digits: int = 4) -> DataFrame:
    return df.groupBy(tier).agg(
        F.count(F.lit(1)).alias("items"),
        F.min(score).alias("min_score"),
        F.max(score).alias("max_score"),
        round_half_even(F.avg(score), digits).alias("avg_score"),
    )


def score_changes(history: DataFrame, key: str = "appid", run: str = "run",
                  score: str = "hidden_gem_score", digits: int = 4) -> DataFrame:
    """Per key and run: previous score, delta, and the length of the rising streak.

    The window is partitioned by item; each item has one row per run after
    dedup, so a partition holds at most the number of runs.
    """
    w = Window.partitionBy(key).orderBy(run)
    out = history.withColumn("prev_score", F.lag(score).over(w))
    out = out.withColumn("score_delta", round_half_even(F.col(score) - F.col("prev_score"), digits))
    rising = F.coalesce(F.col("score_delta") > 0, F.lit(False))
    # Streak: consecutive rising runs ending here (gaps-and-islands on non-rising runs).
    out = out.withColumn("_breaks", F.sum(F.when(rising, 0).otherwise(1)).over(
        w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    streak_w = Window.partitionBy(key, "_breaks").orderBy(run)
    out = out.withColumn("rise_streak",
                         F.when(rising, F.row_number().over(streak_w) - 1).otherwise(0).cast("long"))
    return out.drop("_breaks")


def rising(history: DataFrame, key: str = "appid", run: str = "run",
           score: str = "hidden_gem_score", digits: int = 4) -> DataFrame:
    """Runs where an item's score went up since its previous run."""
    return score_changes(history, key, run, score, digits).where(F.col("score_delta") > 0)
