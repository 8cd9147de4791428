"""History of data-quality outcomes: one entry a run and batch, replaced when it is run again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sleeper.sinks.tables import KeyedTable

ENTRY = "run string, batch long, outcomes array<struct<scope:string,rule:string,evaluated:long,failed:long,outcome:string>>"
ROW, TABLE = "row", "table"


def row_outcomes(counters: dict[str, int], rules) -> list[tuple]:
    """(scope, rule, evaluated, failed, outcome) of the row rules from counters by rule name."""
    n = counters["evaluated"]
    return [(ROW, r.name, n, counters[r.name], "Passed" if counters[r.name] == 0 else "Failed") for r in rules]


def whole_outcomes(outcomes: list[dict], evaluated: int) -> list[tuple]:
    """Likewise of the table rules; a rule on the whole fails once or not at all."""
    return [(TABLE, o["rule"], evaluated, int(o["outcome"] == "Failed"), o["outcome"]) for o in outcomes]


def record_outcomes(spark: SparkSession, path: str, entries: list[tuple[str, int, list[tuple]]]) -> None:
    """Commit ``(run, batch, outcomes)`` entries in one version. An entry of the same run and batch is replaced as a
    whole, so a replay counts nothing twice, also under another rule set."""
    if not entries:
        return
    rows = spark.createDataFrame(list({(e[0], e[1]): e for e in entries}.values()), ENTRY)  # the last of a key
    table = KeyedTable.create_if_absent(spark, path, rows.schema, ["run", "batch"], buckets=8)
    table.upsert(rows)
    table.vacuum()


def read_outcomes(spark: SparkSession, path: str) -> DataFrame:
    """(run, batch, scope, rule, evaluated, failed, outcome) of all entries."""
    entries = KeyedTable.open(spark, path).read()
    return entries.select("run", "batch", F.explode("outcomes").alias("o")).select("run", "batch", "o.*")
