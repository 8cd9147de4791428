"""Candidates (F11), first-fail funnel and stop rules (F9), distributed positions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from sleeper.config import Profile
from sleeper.operators import candidates as C
from sleeper.operators import funnel as FN
from sleeper.operators import insights
from sleeper.operators.ordering import kth_smallest, position_within, with_position

from conftest import rows


def ids(spark, values):
    return spark.createDataFrame([(v, i) for i, v in enumerate(values)], "appid long, pos long")


def test_candidates_merge_in_priority_order(spark):
    srcs = [("store", C.first_occurrence(ids(spark, [3, 1, 3]))),
            ("charts", C.first_occurrence(ids(spark, [1, 7]))),
            ("api", C.first_occurrence(ids(spark, [9, 3])))]
    got = rows(C.merge_sources(srcs), "candidate_rank", "appid", "sources")
    assert got == [(1, 3, ["api", "store"]), (2, 1, ["charts", "store"]), (3, 7, ["charts"]), (4, 9, ["api"])]
    capped = rows(C.merge_sources(srcs, max_candidates=3), "candidate_rank", "appid")
    assert capped == [(1, 3), (2, 1), (3, 7)]


def test_with_position_matches_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("k"), F.col("id"))
    dist = with_position(df, ["k", "id"], "p", num_partitions=7)
    ref = df.withColumn("p", F.row_number().over(Window.orderBy("k", "id")))
    assert rows(dist, "k", "p") == rows(ref, "k", "p")


def test_position_within_matches_row_number(spark):
    """Half of the rows in one group, many small groups, rows without a group, ties in the first sort value."""
    g = F.when(F.col("id") % 2 == 0, F.lit("hot")).when(F.col("id") % 7 > 0, F.concat(F.lit("g"), F.col("id") % 50))
    df = spark.range(0, 5000).select(g.alias("g"), (F.col("id") * 7919 % 100).alias("k"), F.col("id"))
    got = position_within(df, "g", [F.col("k").desc(), "id"], "p", num_partitions=7)
    ref = df.withColumn("p", F.row_number().over(Window.partitionBy("g").orderBy(F.col("k").desc(), "id")))
    assert got.columns == ["g", "k", "id", "p"]
    assert rows(got) == rows(ref)
    assert rows(position_within(df.limit(0), "g", ["id"], "p")) == []


def test_ranked_lists_by_range_equal_those_of_one_task(spark):
    df = spark.range(0, 3000).select(F.col("id").alias("appid"), (F.col("id") % 13).alias("a"),
                                     (F.col("id") * 31 % 101).alias("b"))

    def lists(*limits):
        return [(n, k, [-F.col(n), F.col("appid")]) for n, k in zip("ab", limits)]

    ranked = [df.select(F.lit(n).alias("source"), F.lit(i).alias("prio"), "appid",
                        F.row_number().over(Window.orderBy(-F.col(n), "appid")).cast("long").alias("pos"))
              for i, n in enumerate("ab")]
    whole = ranked[0].unionByName(ranked[1])

    def expected(a, b):
        return rows(whole.where(F.col("pos") <= F.when(F.col("source") == "a", F.lit(a)).otherwise(F.lit(b))))

    assert rows(C.top_ranked_many(df, lists(70, 9))) == expected(70, 9)
    assert rows(C.top_ranked_many(df, lists(70, 9), one_task=100)) == expected(70, 9)
    assert rows(C.top_ranked_many(df, lists(None, 9))) == expected(3000, 9)
    by_range = C.top_ranked_many(df, lists(None, None))
    assert rows(by_range) == expected(3000, 3000)
    plan = by_range._jdf.queryExecution().executedPlan().toString()
    assert "row_number" not in plan  # no task ranks a list: what windows there are sum the partitions' counts


def test_large_k_is_ranked_by_range(spark):
    df = spark.range(0, 2000).select(F.col("id").alias("appid"), (F.col("id") * 7 % 11).cast("double").alias("s"))
    df = df.withColumn("s", F.when(F.col("appid") % 10 > 0, F.col("s")))
    small = insights.top_gems(df, 500, score="s")
    assert rows(insights.top_gems(df, 500, score="s", one_task=100)) == rows(small)
    whole = insights.top_gems(df, None, score="s")
    assert rows(whole.where("gem_rank <= 500")) == rows(small) and whole.count() == 2000
    assert whole.schema["gem_rank"].dataType == small.schema["gem_rank"].dataType


def test_kth_smallest(spark):
    df = spark.range(1, 101).withColumnRenamed("id", "r")
    assert spark.range(1).select(kth_smallest(df, "r", 7)).first()[0] == 7
    assert spark.range(1).select(kth_smallest(df, "r", 500)).first()[0] is None


SCHEMA = ("candidate_rank int, appid long, details_ok boolean, type string, reviews_ok boolean, "
          "label string, score int, total int, players int")


def enriched(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    return df.select(
        "candidate_rank", "appid", "details_ok",
        F.when(F.col("type").isNotNull(), F.struct(F.col("type").alias("type"))).alias("details"),
        "reviews_ok",
        F.struct(F.col("label").alias("review_score_desc"), F.col("score").alias("review_score"),
                 F.col("total").alias("total_reviews")).alias("summary"),
        "players")


OK = ("Overwhelmingly Positive", 9, 100, None)
F9 = [
    (False, None, True, *OK, "error_detalles"),
    (True, None, True, *OK, "descartado_no_juego"),
    (True, "dlc", True, *OK, "descartado_no_juego"),
    (True, "game", True, "Very Positive", 9, 100, None, "descartado_label"),
    (True, "game", True, "Overwhelmingly Positive", 8, 100, None, "descartado_puntaje"),
    (True, "game", True, "Overwhelmingly Positive", None, 100, None, "descartado_puntaje"),
    (True, "game", True, "Overwhelmingly Positive", 9, 79, None, "descartado_cantidad_resenas"),
    (True, "game", True, "Overwhelmingly Positive", 9, 25001, None, "descartado_cantidad_resenas"),
    (True, "game", True, "Overwhelmingly Positive", 9, None, None, "descartado_cantidad_resenas"),
    (True, "game", True, "Overwhelmingly Positive", 9, 100, 100, "descartado_jugadores_actuales"),
    (True, "game", True, "Overwhelmingly Positive", 9, 100, None, "accepted"),
    (True, "game", True, "Mixed", 3, 100, None, "descartado_label"),
    (True, "game", False, None, None, None, None, "error_resenas"),
]


def test_first_fail_outcomes(spark):
    data = [(i + 1, 100 + i, *r[:-1]) for i, r in enumerate(F9)]
    prof = Profile(max_current_players=50, target=1000, max_evaluations=None)
    out = FN.run_funnel(enriched(spark, data), prof)
    got = {r["candidate_rank"]: r["outcome"] for r in out.collect()}
    assert [got[i + 1] for i in range(len(F9))] == [r[-1] for r in F9]


def accepted_rows(spark, n):
    return enriched(spark, [(i + 1, 200 + i, True, "game", True, *OK) for i in range(n)])


def test_stop_after_target(spark):
    out = FN.run_funnel(accepted_rows(spark, 4), Profile(target=2))
    assert rows(out.where("evaluated"), "candidate_rank") == [(1,), (2,)]
    stats = dict(rows(FN.funnel_stats(out), "outcome", "n"))
    assert stats == {"accepted": 2, "evaluados": 2}


def test_stop_at_budget(spark):
    out = FN.run_funnel(accepted_rows(spark, 4), Profile(target=50, max_evaluations=3))
    assert rows(out.where("evaluated"), "candidate_rank") == [(1,), (2,), (3,)]


def test_funnel_properties_on_driver_data(spark):
    from sleeper.plans.queries import DRIVER_PROFILE, driver_extract
    from conftest import SF_SMALL

    res = driver_extract(spark, SF_SMALL)
    stats = dict(rows(FN.funnel_stats(res.funnel), "outcome", "n"))
    evaluated = stats.pop("evaluados")
    assert evaluated == sum(stats.values())
    assert stats.get("accepted", 0) <= DRIVER_PROFILE.target
    assert evaluated <= DRIVER_PROFILE.max_evaluations
    assert res.entries.count() == stats.get("accepted", 0)


def test_unparseable_payloads_are_failed_fetches(spark):
    from sleeper.sources import payloads as P

    df = spark.createDataFrame([(1, '{"query_summary": {"total_reviews": 3}}'), (2, '{"query_summ'), (3, None)],
                               "appid long, payload string")
    got = {r["appid"]: (r["reviews_ok"], r["summary"]) for r in P.parse_reviews(df).collect()}
    assert got[1][0] and got[1][1]["total_reviews"] == 3
    assert got[2] == (False, None) and got[3] == (False, None)
    det = spark.createDataFrame([(1, '{"1": {"success": true, "data": {"type": "game"}}}'), (2, '{"2": {"succ')],
                                "appid long, payload string")
    got = {r["appid"]: (r["details_ok"], r["details"]) for r in P.parse_details(det).collect()}
    assert got[1][0] and got[1][1]["type"] == "game"
    assert got[2] == (False, None)


def test_refetched_payloads_do_not_duplicate_candidates(spark):
    from sleeper.sources import payloads as P

    cands = spark.createDataFrame([(1, 10), (2, 20)], "candidate_rank long, appid long")
    det = spark.createDataFrame([(10, '{"10": {"success": true, "data": {"type": "game"}}}', 1),
                                 (10, '{"10": {"success": true, "data": {"type": "dlc"}}}', 2),
                                 (99, '{"99": {"success": true, "data": {"type": "game"}}}', 1)],
                                "appid long, payload string, fetched_at int")
    rev = spark.createDataFrame([(20, '{"query_summary": {"total_reviews": 5}}')], "appid long, payload string")
    latest = P.latest_payloads(cands, {"details": det, "reviews": rev, "players": rev.limit(0)},
                               order_by=["fetched_at"])
    out = FN.enrich(cands, latest)
    got = {r["appid"]: r for r in out.collect()}
    assert sorted(got) == [10, 20]
    assert got[10]["details"]["type"] == "dlc" and got[10]["reviews_ok"] is False
    assert got[20]["details_ok"] is False and got[20]["summary"]["total_reviews"] == 5


def test_candidate_cap_over_many_ids(spark):
    n = 10_500
    ids_df = spark.range(n).select((F.col("id") * 7919 % n).alias("appid"), F.col("id").alias("pos"))  # 7919 is coprime with n
    for cap in (3, n - 400, n + 1):
        got = C.merge_sources([("s", ids_df)], max_candidates=cap)
        assert got.agg(F.count("*"), F.min("candidate_rank"), F.max("candidate_rank")).first() == (min(cap, n), 1, min(cap, n))
        first = got.where("candidate_rank = 1").first()
        assert (first["appid"], first["first_pos"]) == (0, 0)


def test_zero_target_or_budget_evaluates_nothing(spark):
    for profile in (Profile(target=0), Profile(max_evaluations=0), Profile(target=0, max_evaluations=None)):
        assert FN.run_funnel(accepted_rows(spark, 4), profile).where("evaluated").count() == 0
    assert FN.run_funnel(accepted_rows(spark, 4), Profile(max_evaluations=None)).where("evaluated").count() == 4


def test_loose_numbers_and_large_ids(spark):
    from sleeper.sources import payloads as P

    sent = ['{"query_summary": {"total_reviews": "120", "review_score": 9.0, "total_positive": 5}}',
            '{"query_summary": {"total_reviews": 120.7, "review_score": "x", "total_positive": " 5 "}}']
    df = spark.createDataFrame(list(enumerate(sent)), "appid long, payload string")
    got = {r["appid"]: r["summary"] for r in P.parse_reviews(df).collect()}
    assert [(got[i]["total_reviews"], got[i]["review_score"], got[i]["total_positive"]) for i in (0, 1)] == \
        [(120, 9, 5), (120, None, 5)]
    big = 2 ** 31 + 5
    det = spark.createDataFrame([(big, f'{{"{big}": {{"success": true, "data": {{"name": "n", '
                                       '"metacritic": {"score": "88"}}}}')], "appid long, payload string")
    e = P.parse_details(det).select("*", F.lit(None).cast("struct<total_reviews:int,total_positive:int,"
                                    "total_negative:int,review_score:int,review_score_desc:string>").alias("summary"),
                                    F.lit(None).cast("long").alias("players"))
    r = FN.build_entry(e).first()
    assert (r["appid"], r["nombre"], r["metacritic_score"]) == (None, "n", 88)
