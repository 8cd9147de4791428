"""Silver -> Gold (JOB-4 score, JOB-5 publish)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sleeper import schemas as T
from sleeper.config import ScoreParams
from sleeper.functions.runs import now_ntz
from sleeper.operators.dedup import latest_per_key
from sleeper.operators.score import score_items
from sleeper.session import materialize
from sleeper.sinks.files import append_history, write_parquet

GOLD_COLUMNS = [f.name for f in T.GOLD.fields]
# What Gold reads of Silver: the dedup carries no other column.
GOLD_INPUT = ["appid", "nombre", "generos", "precio", "puntuacion", "total_resenas", "resenas_positivas", "run_ts",
              "source_file"]
GOLD_SHORT = ["appid", "nombre", "precio", "hidden_gem_score", "tier"]  # the 5-column projection


def latest_snapshot(silver: DataFrame, key: str = "appid") -> DataFrame:
    """Latest row per item across all runs: newest run, then newest file, then a
    content hash so ties resolve the same way every time."""
    return latest_per_key(silver, [key], ["run_ts", "source_file"])


def score_gems(silver: DataFrame, params: ScoreParams = ScoreParams(), materialized: bool = True) -> DataFrame:
    """JOB-4: dedup to the latest snapshot, then score with the global maximum.

    The deduplicated snapshot feeds both the max and the scoring pass, so it is
    written once (one row per item) instead of deduplicating Silver twice."""
    latest = latest_snapshot(silver.select(*GOLD_INPUT))
    if materialized:
        latest = materialize(latest, "latest")
    return score_items(latest, params)


def to_gold(scored: DataFrame) -> DataFrame:
    """Typed Gold rows (the 10-column schema). Out-of-range values become NULL."""
    return scored.select(
        F.col("appid").cast("long").alias("appid"),
        "nombre", "generos",
        F.col("precio").try_cast(T.GOLD["precio"].dataType).alias("precio"),
        F.col("puntuacion").cast("int").alias("puntuacion"),
        F.col("total_resenas").cast("int").alias("total_resenas"),
        F.col("resenas_positivas").cast("int").alias("resenas_positivas"),
        F.col("hidden_gem_score").try_cast(T.GOLD["hidden_gem_score"].dataType).alias("hidden_gem_score"),
        F.col("tier"),
        now_ntz().alias("updated_at"),
    )


def publish_gold(gold: DataFrame, gold_path: str, history_path: str | None = None,
                 run_date=None) -> None:
    """Overwrite the Gold snapshot; append this run to the score history."""
    write_parquet(gold, gold_path)
    if history_path is not None:
        hist = gold.select("appid", "hidden_gem_score", "tier",
                           F.lit(run_date).cast("date").alias("run_date"))
        append_history(hist, history_path)
