"""Score changes kept run by run, so that Q3 does not window over the whole history each time.

State is a keyed table with the last run of each item, its score and rising streak. A
run that is newer than all an item has is settled by one join with it. Only items that
get a run they have already passed (one that lands late, or again), or several runs at
once, are worked out again from their own history. The changes lie in one folder a run,
as :func:`sleeper.operators.insights.score_changes` gives them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sleeper.functions.scores import round_half_even
from sleeper.operators.dedup import latest_per_key
from sleeper.operators.insights import score_changes
from sleeper.session import materialize
from sleeper.sinks.files import path_exists
from sleeper.sinks.tables import KeyedTable

STATE = "appid long, run int, hidden_gem_score double, rise_streak long"
CHANGES = "appid long, hidden_gem_score double, prev_score double, score_delta double, rise_streak long, run int"
_COLUMNS = ["appid", "run", "hidden_gem_score", "prev_score", "score_delta", "rise_streak"]


def read_changes(spark: SparkSession, root: str) -> DataFrame:
    """(appid, run, hidden_gem_score, prev_score, score_delta, rise_streak) of every run so far."""
    path = f"{root.rstrip('/')}/changes"
    if not path_exists(spark, path):
        return spark.createDataFrame([], CHANGES).select(*_COLUMNS)
    return spark.read.schema(CHANGES).parquet(path).select(*_COLUMNS)


def advance(scores: DataFrame, root: str, digits: int = 4, buckets: int = 32) -> dict[str, int]:
    """Add ``scores`` (appid, run, hidden_gem_score), one row an item and run at most, of any runs in any order.

    A row of an item and run that is there already replaces it. Returns how many items were settled by
    their state (``settled``) and how many from their history (``again``). A call that fails
    between its two writes is mended by calling again with the same scores.
    """
    spark = scores.sparkSession
    state = KeyedTable.create_if_absent(spark, f"{root.rstrip('/')}/state", spark.createDataFrame([], STATE).schema,
                                        "appid", buckets)
    rows = materialize(scores.select(F.col("appid").cast("long").alias("appid"), F.col("run").cast("int").alias("run"),
                                     "hidden_gem_score"), "new_scores")
    last = state.read().select("appid", F.col("run").alias("last_run"), F.col("hidden_gem_score").alias("last_score"),
                               F.col("rise_streak").alias("last_streak"))
    items = rows.groupBy("appid").agg(F.count(F.lit(1)).alias("n"), F.min("run").alias("first"))
    items = materialize(items.join(last, "appid", "left").withColumn(
        "again", (F.col("n") > 1) | F.coalesce(F.col("first") <= F.col("last_run"), F.lit(False))), "items")

    delta = round_half_even(F.col("hidden_gem_score") - F.col("last_score"), digits)
    settled = rows.join(items.where(~F.col("again")), "appid").select(
        "appid", "run", "hidden_gem_score", F.col("last_score").alias("prev_score"), delta.alias("score_delta"),
        F.when(delta > 0, F.col("last_streak") + 1).otherwise(0).cast("long").alias("rise_streak"))
    anew = items.where("again").select("appid")
    mine = rows.join(anew, "appid", "left_semi")
    past = read_changes(spark, root).join(anew, "appid", "left_semi").select("appid", "run", "hidden_gem_score")
    history = mine.unionByName(past.join(mine.select("appid", "run"), ["appid", "run"], "left_anti"))
    worked = score_changes(history, digits=digits).withColumn("rise_streak", F.col("rise_streak").cast("long"))
    # a late run changes nothing that came before it
    late = rows.groupBy("appid").agg(F.min("run").alias("from"))
    worked = worked.join(late, "appid").where(F.col("run") >= F.col("from")).select(*_COLUMNS)
    out = materialize(settled.select(*_COLUMNS).unionByName(worked), "changes")

    runs = [r["run"] for r in out.select("run").distinct().collect()]  # a row a run
    if runs:
        kept = read_changes(spark, root).where(F.col("run").isin(runs)).join(out.select("appid", "run"), ["appid", "run"], "left_anti")
        whole = materialize(out.unionByName(kept), "runs")
        whole.repartition("run", F.pmod(F.xxhash64("appid"), F.lit(buckets))).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("run").parquet(f"{root.rstrip('/')}/changes")
        newest = latest_per_key(out, ["appid"], ["run"], tiebreak=False)
        state.upsert(newest.select("appid", "run", "hidden_gem_score", "rise_streak"))
        state.vacuum()
    counts = {r["again"]: r["n"] for r in items.groupBy("again").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {"settled": counts.get(False, 0), "again": counts.get(True, 0)}
