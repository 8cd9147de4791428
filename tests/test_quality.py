"""Data-quality rules (FIXTURES F8), routing and outcome counters."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from sleeper.operators import quality as DQ

SCHEMA = ("appid int, nombre string, precio decimal(10,2), total_resenas int, resenas_positivas int, "
          "resenas_negativas int, puntuacion int, metacritic_score int, jugadores_actuales_api int")
BASE = dict(appid=1, nombre="A", precio=Decimal("1.00"), total_resenas=10, resenas_positivas=8,
            resenas_negativas=2, puntuacion=9, metacritic_score=80, jugadores_actuales_api=5)
CASES = [
    ({}, []),
    ({"total_resenas": 9}, ['ColumnValues "total_resenas" >= 10']),
    ({"nombre": None}, ['IsComplete "nombre"']),
    ({"total_resenas": None}, ['IsComplete "total_resenas"']),
    ({"metacritic_score": 101}, ['ColumnValues "metacritic_score" between 0 and 100']),
    ({"metacritic_score": None, "jugadores_actuales_api": None}, []),
    ({"puntuacion": -1, "resenas_negativas": -1},
     ['ColumnValues "puntuacion" between 0 and 100', 'ColumnValues "resenas_negativas" >= 0']),
    ({"resenas_positivas": 11}, []),
]
COLS = [c.split()[0] for c in SCHEMA.split(", ")]


def frame(spark):
    data = []
    for i, (change, _) in enumerate(CASES):
        row = dict(BASE, **change)
        row["appid"] = i
        data.append(tuple(row[c] for c in COLS))
    return spark.createDataFrame(data, SCHEMA)


def test_rule_set_has_thirteen_rules():
    assert len(DQ.RULES_SILVER) == 13


def test_failed_rules_per_row(spark):
    got = {r["appid"]: r["failed_rules"] for r in DQ.evaluate(frame(spark), DQ.RULES_SILVER).collect()}
    for i, (_, expected) in enumerate(CASES):
        assert got[i] == expected, CASES[i]


def test_readme_rule_positive_le_total(spark):
    got = {r["appid"]: r["failed_rules"] for r in DQ.evaluate(frame(spark), DQ.RULES_README).collect()}
    assert got[7] == ["positive <= total", "positive pct between 0 and 100"]  # 11 of 10 is 110%
    assert got[0] == []


def test_split_partitions_input(spark):
    df = frame(spark)
    passed, rejected = DQ.split(df, DQ.RULES_SILVER)
    assert passed.count() + rejected.count() == df.count()
    assert passed.columns == df.columns
    assert sorted(r["appid"] for r in passed.collect()) == [0, 5, 7]


def test_outcomes_and_observation_agree(spark):
    df = frame(spark)
    table = {r["rule"]: (r["evaluated"], r["failed"], r["outcome"]) for r in DQ.outcomes(df, DQ.RULES_SILVER).collect()}
    observed, obs = DQ.observe(df, DQ.RULES_SILVER)
    observed.write.format("noop").mode("overwrite").save()  # the counters ride on this action
    for o in DQ.observed_outcomes(obs, DQ.RULES_SILVER):
        assert table[o["rule"]] == (o["evaluated"], o["failed"], o["outcome"])
    assert table['IsComplete "appid"'] == (8, 0, "Passed")
    assert table['ColumnValues "total_resenas" >= 10'] == (8, 1, "Failed")


def test_nulls_fail_option(spark):
    df = spark.createDataFrame([(None,), (5,)], "x int")
    rule = DQ.column_between("x", 0, 10, nulls="fail")
    got = [r["f"] for r in df.select(rule.failure().alias("f")).collect()]
    assert got == [True, False]
    excl = DQ.column_between("x", 0, 5, inclusive=False)
    assert [r["f"] for r in df.select(excl.failure().alias("f")).collect()] == [False, True]


def test_column_count_rule(spark):
    assert DQ.column_count_gt(frame(spark), 0)
    assert not DQ.column_count_gt(spark.range(1).select(F.lit(1).alias("a")).drop("a"), 0)
