"""The k-th smallest value against a sorted list and the running window, and its plan."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from sleeper.config import Profile
from sleeper.operators import funnel as FN
from sleeper.operators.ordering import kth_smallest
from test_plans import plan


def value(spark, df, k, n=None):
    return spark.range(1).select(kth_smallest(df, "v", k, n)).first()[0]


@pytest.mark.parametrize("seed", range(3))
def test_kth_smallest_is_the_sorted_lists(spark, seed):
    rng = random.Random(seed)
    values = [rng.choice([None, *range(rng.choice([3, 1000]))]) for _ in range(200)]
    df = spark.createDataFrame([(v,) for v in values], "v long").repartition(5)
    known = sorted(v for v in values if v is not None)
    for k in (1, 2, len(known) // 2, len(known), len(known) + 1, 10 ** 9):
        assert value(spark, df, k, rng.choice([1, 7])) == (known[k - 1] if k <= len(known) else None)
    assert value(spark, df.limit(0), 1) is None


def test_stop_rank_is_the_running_windows(spark):
    rng = random.Random(4)
    rows = [(i + 1, rng.choice([FN.ACCEPTED, FN.LOW_SCORE])) for i in range(150)]
    df = spark.createDataFrame(rows, "candidate_rank long, outcome string")
    running = F.sum((F.col("outcome") == FN.ACCEPTED).cast("int")).over(
        Window.orderBy("candidate_rank").rowsBetween(Window.unboundedPreceding, -1))
    for target in (0, 1, 40, 75, 10 ** 9):
        for budget in (None, 0, 60):
            profile = Profile(target=target, max_evaluations=budget, max_candidates=0)
            cut = FN.stop_rank(df, profile)
            got = df.where(F.coalesce(F.col("candidate_rank") <= cut, F.lit(True))).count()
            want = df.withColumn("seen", F.coalesce(running, F.lit(0))).where(
                (F.col("seen") < target) & (F.col("candidate_rank") <= (len(rows) if budget is None else budget))).count()
            assert got == want, (target, budget)


def test_a_large_target_is_no_list(spark):
    df = spark.range(1000).select(F.col("id").alias("candidate_rank"), F.lit(FN.ACCEPTED).alias("outcome"))
    cut = FN.stop_rank(df, Profile(target=10 ** 9, max_evaluations=None, max_candidates=0))
    p = plan(df.where(F.coalesce(F.col("candidate_rank") <= cut, F.lit(True))))
    assert "CollectLimit" not in p and "TakeOrdered" not in p and "GlobalLimit" not in p
