"""Incremental Bronze -> Silver -> Gold with Structured Streaming.

ST-1: a file stream over the Bronze root picks up only run folders it has not
seen (the checkpoint records processed files); ``trigger(availableNow=True)``
processes everything landed so far and stops, which suits scheduled runs.
The Parquet file sink commits through its own metadata log, so a replayed
micro-batch does not duplicate rows.

Rows go to ``<silver_root>/dq_status=passed`` or ``=rejected`` in the same pass, and
the rule counters are collected with it (as the batch job does).

ST-2: Gold is a keyed table of the latest row of each item with its score, in buckets
by the key's hash. A second stream takes from Silver exactly the files that are
committed there and that it has not merged yet, whatever run they belong to, so
a run that lands late, or in a folder without a run's name, is merged like any
other. Only the buckets that new rows fall into are merged and written. All scores
hang together by one number, the largest review count: each bucket's is noted in the
table's manifest, so the new one is known from the touched buckets alone, and only
when it has moved are the other buckets rescored.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from sleeper import schemas as T
from sleeper.config import ScoreParams
from sleeper.operators import quality as DQ
from sleeper.operators.dedup import latest_per_key
from sleeper.operators.score import score_items
from sleeper.plans.gold import GOLD_INPUT
from sleeper.plans.silver import STATUS, check_rows, to_silver_rows
from sleeper.session import materialize
from sleeper.sinks.outcomes import record_outcomes, row_outcomes
from sleeper.sinks.tables import BUCKET, KeyedTable
from sleeper.sources.files import bronze_reader, with_lineage

METRICS = "silver_dq"
_SILVER_COLUMNS = [f.name for f in T.SILVER.fields]
_ROUTED = StructType([*T.SILVER.fields, StructField("failed_rules", ArrayType(StringType())),
                      StructField(STATUS, StringType())])


def silver_stream(spark: SparkSession, bronze_root: str, silver_root: str, checkpoint: str,
                  rules=DQ.RULES_SILVER, available_now: bool = True,
                  max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the incremental Bronze -> Silver stream: passed and rejected rows, by ``dq_status``."""
    r = bronze_reader(spark, stream=True)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    checked = check_rows(to_silver_rows(with_lineage(r.json(bronze_root))), rules)
    checked = checked.observe(METRICS, *DQ.routed_counts(rules))
    status = F.when(F.size("failed_rules") == 0, F.lit("passed")).otherwise(F.lit("rejected"))
    w = (checked.select(*_SILVER_COLUMNS, "failed_rules", status.alias(STATUS))
         .writeStream.format("parquet").option("path", silver_root).partitionBy(STATUS)
         .option("checkpointLocation", checkpoint).option("compression", "snappy").outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def _finish(q: StreamingQuery) -> StreamingQuery:
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return q


def run_silver_increment(spark: SparkSession, bronze_root: str, silver_root: str, checkpoint: str,
                         rules=DQ.RULES_SILVER, history_path: str | None = None, run: str = "stream") -> dict[str, int]:
    """Process what has landed; returns the counters of its rows (``evaluated``, ``malformed``, and
    each rule's failures by name). With ``history_path`` the outcomes of every micro-batch are committed
    there under ``run`` and the batch's number, which a batch keeps when it is run again."""
    q = _finish(silver_stream(spark, bronze_root, silver_root, checkpoint, rules))
    seen = [(p.batchId, p.observedMetrics[METRICS].asDict()) for p in q.recentProgress if METRICS in p.observedMetrics]
    if history_path is not None:
        record_outcomes(spark, history_path, [(run, b, row_outcomes(DQ.routed_outcomes([m], rules), rules))
                                              for b, m in seen if m["evaluated"]])
    return DQ.routed_outcomes([m for _, m in seen], rules)


def read_stream_silver(spark: SparkSession, silver_root: str, status: str = "passed") -> DataFrame:
    """The rows that the stream has committed (its log decides, not the files that lie there)."""
    rows = spark.read.schema(_ROUTED).parquet(silver_root).where(F.col(STATUS) == status)
    return rows.select(*_SILVER_COLUMNS, *(["failed_rules"] if status == "rejected" else []))


def merge_latest(previous: DataFrame | None, delta: DataFrame, key: str = "appid") -> DataFrame:
    """Latest row per key over (previous latest table + newly arrived rows).

    Only the delta and the previous latest table (one row per item) are read,
    not the whole Silver history. A row without a run is older than any other."""
    both = delta if previous is None else previous.unionByName(delta)
    return latest_per_key(both, [key], ["run_ts", "source_file"])


INCREMENT = "increment"
#: Folder of the Gold table in the state folder, and the count its scores hang together by.
GOLD_TABLE, TOTAL = "gold", "total_resenas"


@dataclass
class GoldIncrement:
    rows: DataFrame        # the whole Gold table after the increment
    arrived: int           # items that the increment brought rows of
    rewritten: int         # items whose rows were written
    maximum: int           # what obscurity is measured by
    rescored_all: bool     # did it move (or the parameters), so that every bucket was written


def _new_rows(spark: SparkSession, silver_root: str, state_root: str, checkpoint: str, number: int) -> DataFrame:
    """What Gold needs of the Silver files committed since the last increment. A stream copies it to
    ``<state_root>/delta``, marked with the increment's number. If an increment fails, the next one has the same
    number: what was copied already is merged with what it copies itself."""
    new = spark.readStream.schema(_ROUTED).parquet(silver_root).where(F.col(STATUS) == "passed")
    new = new.select(*GOLD_INPUT, F.lit(number).alias(INCREMENT))
    _finish(new.writeStream.format("parquet").option("path", f"{state_root}/delta").partitionBy(INCREMENT)
            .option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start())
    return spark.read.schema(new.schema).parquet(f"{state_root}/delta").where(F.col(INCREMENT) == number).drop(INCREMENT)


def run_gold_delta(spark: SparkSession, silver_root: str, state_root: str, checkpoint: str,
                   params: ScoreParams = ScoreParams(), buckets: int = 32) -> GoldIncrement:
    """Merge what Silver has committed since the last call into the Gold table and rescore what that changes.

    ``buckets`` counts when the table is made. The version becomes current at once, with its
    maximum and parameters; a call that fails leaves the table as it was.
    """
    inputs = [f for f in T.SILVER.fields if f.name in GOLD_INPUT]
    empty = spark.createDataFrame([], StructType(inputs)).select(*GOLD_INPUT)
    table = KeyedTable.create_if_absent(spark, f"{state_root}/{GOLD_TABLE}",
                                        score_items(empty, params, maximum=1).schema, "appid", buckets)
    base = table.manifest()
    delta = _new_rows(spark, silver_root, state_root, checkpoint, base.version + 1)

    def bucketed(rows: DataFrame) -> DataFrame:
        return rows.select(*GOLD_INPUT, table.bucket().alias(BUCKET))

    new = materialize(bucketed(merge_latest(None, delta)), "gold_delta")
    arrived = {r[BUCKET]: r["n"] for r in new.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("n")).collect()}
    before = {b: x["max"] for b, x in base.buckets.items()}
    same_params = base.notes.get("params") in (None, asdict(params))
    if not arrived and same_params:
        maximum = base.notes.get("max", 1)
        return GoldIncrement(table.read(base), 0, 0, maximum, False)

    current = bucketed(table.read(base, arrived))
    merged = materialize(merge_latest(current, new), "gold_merged")
    sizes = {r[BUCKET]: {"max": r["m"] or 0, "rows": r["n"]} for r in merged.groupBy(BUCKET).agg(
        F.max(TOTAL).alias("m"), F.count(F.lit(1)).alias("n")).collect()}  # a row a bucket
    maximum = max(1, *(x["max"] for x in sizes.values()), *(m for b, m in before.items() if b not in sizes), 1)
    rescore = maximum != base.notes.get("max", maximum) or not same_params
    if rescore:
        rest = {b: {"max": x["max"], "rows": x["rows"]} for b, x in base.buckets.items() if b not in sizes}
        merged = merged.unionByName(bucketed(table.read(base, rest)))
        sizes |= rest
    folder = table.write(score_items(merged, params, maximum=maximum).select(*table.schema.names, BUCKET))
    now = table.commit(base, folder, sizes, {"max": maximum, "params": asdict(params)})
    table.vacuum()
    return GoldIncrement(table.read(now), sum(arrived.values()), sum(x["rows"] for x in sizes.values()), maximum, rescore)


def run_gold_increment(spark: SparkSession, silver_root: str, state_root: str, checkpoint: str,
                       params: ScoreParams = ScoreParams()) -> DataFrame:
    """The Gold rows of :func:`run_gold_delta`."""
    return run_gold_delta(spark, silver_root, state_root, checkpoint, params).rows
