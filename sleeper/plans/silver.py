"""Bronze -> Silver (JOB-3): map, parse price, check rules, write Parquet.

One scan and one write job: the per-rule counters ride along on the write
through ``Observation`` instead of a separate ``count()`` pass.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sleeper import schemas as T
from sleeper.functions.price import parse_price
from sleeper.operators import quality as DQ
from sleeper.operators.mapping import apply_mapping
from sleeper.sinks.files import write_parquet
from sleeper.sinks.outcomes import record_outcomes, row_outcomes, whole_outcomes
from sleeper.sources.files import CORRUPT, read_bronze

STATUS = "dq_status"
MALFORMED = "Malformed record"


@dataclass
class SilverResult:
    path: str                 # the Silver table (passed rows)
    quarantine: str | None    # rejected rows, with failed_rules
    outcomes: list[dict]      # per-rule counters, collected during the write
    malformed: int = 0        # lines that are no JSON: rejected, and counted under no rule
    table_outcomes: list[dict] = field(default_factory=list)  # of the rules on the table as a whole


def to_silver_rows(bronze: DataFrame) -> DataFrame:
    """Mapped Silver columns with the parsed price, raw price text and lineage."""
    out = apply_mapping(bronze, T.SILVER_MAPPING, keep=["run_ts", "source_file", CORRUPT])
    return out.withColumns({"precio_raw": F.col("precio"), "precio": parse_price("precio", "es_gratis")})


def check_rows(df: DataFrame, rules=DQ.RULES_SILVER) -> DataFrame:
    """Attach failed rule names; a malformed JSON line always fails."""
    ev = DQ.evaluate(df, rules)
    if CORRUPT in df.columns:
        ev = ev.withColumn("failed_rules", F.when(F.col(CORRUPT).isNotNull(),
                                                  F.array(F.lit(MALFORMED))).otherwise(F.col("failed_rules")))
    return ev


def bronze_to_silver(spark: SparkSession, bronze_root: str, silver_root: str, rules=DQ.RULES_SILVER,
                     quarantine: bool = True, max_records_per_file: int | None = 1_000_000,
                     table_rules=DQ.RULES_TABLE, best_effort: bool = False, history_path: str | None = None,
                     run: str = "batch", batch: int = 0) -> SilverResult:
    """Read every Bronze run, map, check and write.

    With ``quarantine`` the passed and rejected rows are written by the same job,
    partitioned by ``dq_status`` (``passed`` / ``rejected``); the Silver table is
    the ``passed`` partition. ``table_rules`` on the schema are evaluated before anything is
    written, those on row counts from the counters of the write itself; one that fails ends the
    run, unless ``best_effort`` only reports it. With ``history_path`` all outcomes are
    committed there under ``run`` and ``batch``, also those of a run that a rule ends.
    """
    rows = to_silver_rows(read_bronze(spark, bronze_root))
    DQ.table_outcomes(table_rules, len(rows.columns), best_effort=best_effort)  # schema only, no job
    checked, obs = DQ.observe(check_rows(rows, rules), rules, name="silver_dq")
    status = F.when(F.size("failed_rules") == 0, F.lit("passed")).otherwise(F.lit("rejected"))
    cols = [f.name for f in T.SILVER.fields]
    if quarantine:
        out = checked.select(*cols, "failed_rules", status.alias(STATUS))
        write_parquet(out, silver_root, partition_by=[STATUS], max_records_per_file=max_records_per_file)
        path, qpath = f"{silver_root.rstrip('/')}/{STATUS}=passed", f"{silver_root.rstrip('/')}/{STATUS}=rejected"
    else:
        out = checked.where(F.size("failed_rules") == 0).select(*cols)
        write_parquet(out, silver_root, max_records_per_file=max_records_per_file)
        path, qpath = silver_root, None
    seen, passed = DQ.routed_outcomes([obs.get], rules), int(obs.get["passed"])
    whole = DQ.table_outcomes(table_rules, len(rows.columns), seen["evaluated"], passed, best_effort=True)
    if history_path is not None:
        record_outcomes(spark, history_path,
                        [(run, batch, row_outcomes(seen, rules) + whole_outcomes(whole, seen["evaluated"]))])
    DQ.table_outcomes(table_rules, len(rows.columns), seen["evaluated"], passed, best_effort=best_effort)
    return SilverResult(path, qpath, DQ.observed_outcomes(obs, rules), seen["malformed"], whole)
