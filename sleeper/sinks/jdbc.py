"""Keyed upsert into a JDBC table (create-if-absent, then merge by key)."""

from __future__ import annotations

import re

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from sleeper.operators.upsert import upsert


def _reader(spark: SparkSession, url: str, props: dict[str, str]):
    r = spark.read.format("jdbc").option("url", url)
    for k, v in props.items():
        r = r.option(k, v)
    return r


def table_exists(spark: SparkSession, url: str, table: str, props: dict[str, str]) -> bool:
    try:
        _reader(spark, url, props).option("query", f"SELECT * FROM {table} WHERE 1 = 0").load().schema
        return True
    except PySparkException as e:
        # what drivers say of a missing table, by SQLSTATE class 42 or in words; anything else is no answer
        if re.search(r"(?i)does not exist|doesn't exist|not found|no such table|unknown table|invalid object|\b42[PS]0[12]\b",
                     str(e)):
            return False
        raise


def create_if_absent(df: DataFrame, url: str, table: str, column_types: str | None = None,
                     props: dict[str, str] | None = None) -> None:
    """Create ``table`` with ``df``'s columns (``column_types`` overrides the DDL
    types, e.g. ``"appid BIGINT NOT NULL, precio NUMERIC(8,2)"``)."""
    props = props or {}
    spark = df.sparkSession
    if table_exists(spark, url, table, props):
        return
    w = df.limit(0).write.format("jdbc").option("url", url).option("dbtable", table)
    if column_types:
        w = w.option("createTableColumnTypes", column_types)
    for k, v in props.items():
        w = w.option(k, v)
    w.mode("append").save()


def jdbc_upsert(updates: DataFrame, url: str, table: str, key: str, update_cols: list[str] | None = None,
                column_types: str | None = None, props: dict[str, str] | None = None,
                batchsize: int = 10000, num_partitions: int = 8) -> DataFrame:
    """Insert new keys, update ``update_cols`` of existing ones; returns the merged table.

    The merge is a full outer join in Spark. Its result is written once under the
    shared checkpoint dir before the table is truncated and rewritten, so the
    write never re-reads the table it is replacing.
    """
    props = props or {}
    spark = updates.sparkSession
    create_if_absent(updates, url, table, column_types, props)
    current = _reader(spark, url, props).option("dbtable", table).load()
    merged = upsert(current, updates.select(*current.columns), key, update_cols)
    from sleeper.session import materialize

    merged = materialize(merged, "jdbc_upsert")
    w = (merged.repartition(num_partitions).write.format("jdbc").option("url", url).option("dbtable", table)
         .option("truncate", "true").option("batchsize", str(batchsize)))
    for k, v in props.items():
        w = w.option(k, v)
    w.mode("overwrite").save()
    return _reader(spark, url, props).option("dbtable", table).load()
