"""Plan-shape assertions: the physical plans the scale design depends on."""

from __future__ import annotations

from sleeper.plans import queries as Q

from conftest import SF_SMALL


def plan(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_global_max_is_a_scalar_subquery_not_a_window_or_cross_join(spark):
    p = plan(Q.q_hgs_score(spark, SF_SMALL))
    assert "Subquery" in p
    assert "Window" not in p
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_scan_reads_only_needed_columns(spark):
    from sleeper.plans import workload as W

    p = plan(W.catalog(spark, SF_SMALL))
    schemas = [line for line in p.splitlines() if line.startswith("ReadSchema") and "l_" in line]
    assert schemas and all("l_extendedprice" not in s and "l_comment" not in s for s in schemas)


def test_top_k_is_take_ordered(spark):
    from sleeper.plans import extract as X

    assert "TakeOrderedAndProject" in plan(Q.q_hgs_topk(spark, SF_SMALL))
    cands = X.select_candidates(Q.candidate_sources(spark, SF_SMALL), Q.DRIVER_PROFILE, materialized=False)
    assert "row_number" not in plan(cands)  # positions come from range partitions, not from one task
    p = plan(Q.candidate_sources(spark, SF_SMALL))
    assert p.count("WindowGroupLimit") >= 2  # each list trimmed by group, before either shuffle
    scans = [ln for ln in p.splitlines() if ln.startswith("(") and "Scan parquet" in ln]
    assert len(scans) == 1  # all three lists from one lineitem pass


def test_rank_within_group_limits_before_the_shuffle(spark):
    p = plan(Q.q_rank_within_genre(spark, SF_SMALL))
    assert "WindowGroupLimit" in p
    # the partial limit sits below the exchange that feeds the final window
    lines = [ln for ln in p.splitlines() if ln.startswith("(")]
    first_limit = min(i for i, ln in enumerate(lines) if "WindowGroupLimit" in ln)
    exchanges = [i for i, ln in enumerate(lines) if "Exchange" in ln]
    assert any(i > first_limit for i in exchanges)


def test_dedup_is_an_aggregate_not_a_window(spark):
    p = plan(Q.q_latest_snapshot(spark, SF_SMALL))
    assert "max_by" in p
    assert "row_number" not in p


def test_funnel_stop_is_bounded(spark):
    p = plan(Q.q_funnel_rows(spark, SF_SMALL))
    assert "TakeOrdered" not in p and "CollectLimit" not in p  # the target-th acceptance is searched in one partition
    assert "RunningWindowFunction" not in p


def test_silver_checks_and_write_are_one_scan(spark, tmp_path):
    from sleeper.operators import quality as DQ
    from sleeper.plans.silver import check_rows, to_silver_rows
    from sleeper.sinks.files import write_bronze
    from sleeper.sources.files import read_bronze

    root = str(tmp_path / "bronze")
    write_bronze(spark.createDataFrame([(1, "A")], "appid int, nombre string"), root, run_ts="2026-01-01 00:00:00")
    rows = to_silver_rows(read_bronze(spark, root))
    observed, _obs = DQ.observe(check_rows(rows), DQ.RULES_SILVER)
    p = plan(observed)
    scans = [ln for ln in p.splitlines() if ln.startswith("(") and "Scan json" in ln]
    assert len(scans) == 1
    assert "CollectMetrics" in p  # the rule counters are collected by the same plan


def test_scale_conf_sizes_shuffles_from_the_data():
    from sleeper.session import scale_conf

    big = scale_conf(100 << 40)  # 100 TB
    assert int(big["spark.sql.shuffle.partitions"]) == 409_600  # 256 MB each; AQE merges small ones
    mid = scale_conf(1 << 40)    # 1 TB
    assert int(mid["spark.sql.shuffle.partitions"]) == 4096
    assert scale_conf(10)["spark.sql.shuffle.partitions"] == "1"
