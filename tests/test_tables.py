"""Keyed tables: the recorded contract, versions that switch at once, what is refused."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sleeper.sinks.files import parquet_upsert
from sleeper.sinks.tables import KeyedTable, TableMismatch, VersionTaken, publish, read_text

SCHEMA = "appid long, nombre string, v int"


@pytest.fixture
def table(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"n{i}", i) for i in range(50)], SCHEMA)
    t = KeyedTable.create_if_absent(spark, str(tmp_path / "t"), rows.schema, "appid", buckets=4)
    t.upsert(rows)
    return t


def contents(t):
    return sorted(map(tuple, t.read().collect()))


def test_another_bucket_number_changes_nothing(spark, tmp_path):
    rows = spark.createDataFrame([(i, "a", 1) for i in range(50)], SCHEMA)
    path = str(tmp_path / "t")
    parquet_upsert(rows, path, "appid", buckets=4)
    t = parquet_upsert(rows.withColumn("v", F.lit(2)), path, "appid", buckets=6)
    assert t.buckets == 4
    assert contents(t) == [(i, "a", 2) for i in range(50)]


def test_drift_and_bad_keys_are_refused(spark, table):
    before, version = contents(table), table.manifest().version
    for rows, schema in (([(1, "x", 1, 1)], f"{SCHEMA}, more int"), ([(1, "x")], "appid long, nombre string"),
                         ([(1, "x", 1)], "appid long, nombre string, v long"), ([(1, "x", 1), (1, "y", 2)], SCHEMA),
                         ([(None, "x", 1)], SCHEMA)):
        with pytest.raises(TableMismatch):
            table.upsert(spark.createDataFrame(rows, schema))
    with pytest.raises(TableMismatch):
        table.upsert(spark.createDataFrame([(1, "x", 1)], SCHEMA), update_cols=["nobody"])
    other = spark.createDataFrame([], "appid long, nombre string, v double").schema
    with pytest.raises(TableMismatch, match="v: int expected, double found"):
        KeyedTable.create_if_absent(spark, table.path, other, "appid")
    with pytest.raises(TableMismatch, match="key"):
        KeyedTable.create_if_absent(spark, table.path, table.schema, "nombre")
    assert contents(table) == before and table.manifest().version == version


def test_a_writer_that_stops_before_the_switch_changes_nothing(spark, table):
    before = contents(table)
    new = table.bucketed(spark.createDataFrame([(1, "half", 0)], SCHEMA))
    table.write(new)  # all files of the new version lie there
    reopened = KeyedTable.open(spark, table.path)
    assert contents(reopened) == before
    reopened.upsert(spark.createDataFrame([(1, "whole", 0)], SCHEMA))
    assert contents(table) == sorted([(1, "whole", 0), *(r for r in before if r[0] != 1)])


def test_the_second_of_two_writers_is_refused(spark, table):
    base = table.manifest()
    rows = table.bucketed(spark.createDataFrame([(1, "late", 0)], SCHEMA))
    late = table.write(rows)
    table.upsert(spark.createDataFrame([(2, "first", 0)], SCHEMA))
    now = contents(table)
    with pytest.raises(VersionTaken):
        table.commit(base, late, {r["bucket"]: {} for r in rows.select("bucket").collect()})
    assert contents(table) == now


def test_readers_of_the_version_before_go_on(spark, table):
    old, reader = contents(table), table.read()
    table.upsert(spark.createDataFrame([(i, "new", 9) for i in range(60)], SCHEMA))
    table.vacuum(keep=2)
    assert sorted(map(tuple, reader.collect())) == old
    assert contents(table) == [(i, "new", 9) for i in range(60)]
    table.vacuum(keep=1)
    assert table.versions() == [2] and contents(table) == [(i, "new", 9) for i in range(60)]


def test_only_touched_buckets_get_a_new_folder(spark, table):
    before = table.manifest()
    table.upsert(spark.createDataFrame([(7, "x", 0)], SCHEMA), update_cols=["nombre"])
    after = table.manifest()
    assert sum(before.buckets[b]["folder"] != after.buckets[b]["folder"] for b in before.buckets) == 1
    assert (7, "x", 7) in contents(table)
    table.upsert(spark.createDataFrame([], SCHEMA))
    assert table.manifest() == after


def test_composite_keys_and_empty_tables(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a", 1), (1, "b", 2)], SCHEMA)
    t = KeyedTable.create_if_absent(spark, str(tmp_path / "c"), rows.schema, ["appid", "nombre"], 3)
    assert t.read().collect() == [] and t.read().schema.names == rows.schema.names
    t.upsert(rows)
    t.upsert(spark.createDataFrame([(1, "b", 5)], SCHEMA))
    assert contents(t) == [(1, "a", 1), (1, "b", 5)]


def test_publish_is_once(spark, tmp_path):
    path = str(tmp_path / "d" / "f.json")
    assert publish(spark, path, "é1") and not publish(spark, path, "2")
    assert read_text(spark, path) == "é1"
    assert [p.name for p in (tmp_path / "d").iterdir() if not p.name.startswith(".")] == ["f.json"]
