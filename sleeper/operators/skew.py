"""Joins that stand hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot from this share of all rows on; by counting, at most 1 / HOT_SHARE keys are.
HOT_SHARE = 1 / 1000


def join_sites(left: DataFrame, sites: DataFrame, keys: list[str], count: str, how: str = "inner") -> DataFrame:
    """``left`` joined with ``sites``, which has one row per key and, in ``count``,
    how many rows of ``left`` hold the key.

    Keys with HOT_SHARE or more of all rows are at most 1/HOT_SHARE many, so they
    are broadcast and their rows stay where they are; all other keys are small
    enough for a shuffle join. Keys must not be null (wrap those that may be in a
    struct). ``sites`` and ``left`` should be written frames: both are read twice.
    """
    total = sites.agg(F.coalesce(F.sum(count), F.lit(0)).alias("t")).first()["t"]
    floor = max(1, int(total * HOT_SHARE))
    hot = F.broadcast(sites.where(F.col(count) > floor))
    cold = sites.where(F.col(count) <= floor)
    spread = left.join(hot.select(*keys), keys, "left_anti").join(cold, keys, how)
    return left.join(hot, keys, "inner").unionByName(spread)
