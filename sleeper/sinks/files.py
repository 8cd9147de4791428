"""Writers for the landed layers. Each call is a single Spark job."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sleeper.functions.runs import run_folder

RUN_DIR_COL = "run"


def path_exists(spark, path: str) -> bool:
    """Whether ``path`` exists on its file system (local, HDFS or object store)."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)


def list_folders(spark, path: str) -> list[str]:
    """Names of the folders in ``path`` (none if it does not exist)."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(jpath) if s.isDirectory()] if fs.exists(jpath) else []


def delete_path(spark, path: str) -> None:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def write_bronze(df: DataFrame, root: str, run_ts=None, run_ts_col: str | None = None,
                 files_per_run: int = 8) -> None:
    """JSON Lines (UTF-8, compact) with NULL fields kept as keys.

    One run: ``run_ts`` (a Python datetime/str) names the folder
    ``<root>/<yyyy-MM-dd_HH-mm-ss>/``. Many runs at once: ``run_ts_col`` names a
    timestamp column and each run lands under ``<root>/run=<folder>/`` in one job, in at
    most ``files_per_run`` files. A run that is landed again replaces its own folder
    and no other.
    """
    root = root.rstrip("/")
    w = None
    if run_ts_col is not None:
        out = df.withColumn(RUN_DIR_COL, run_folder(run_ts_col)).drop(run_ts_col)
        salt = F.pmod(F.xxhash64(*[c for c in out.columns if c != RUN_DIR_COL]), F.lit(files_per_run))
        out = out.repartition(F.col(RUN_DIR_COL), salt)
        w = out.write.partitionBy(RUN_DIR_COL).option("partitionOverwriteMode", "dynamic")
        path = root
    else:
        ts = run_ts if isinstance(run_ts, dt.datetime) else dt.datetime.fromisoformat(str(run_ts))
        folder = ts.strftime("%Y-%m-%d_%H-%M-%S")
        w = df.write
        path = f"{root}/{folder}"
    w.mode("overwrite").option("ignoreNullFields", "false").option("compression", "none").json(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None,
                  max_records_per_file: int | None = None, single_file: bool = False) -> None:
    """Snappy Parquet. ``single_file`` is for small outputs only (it funnels the
    last stage into one task); large outputs size files with ``maxRecordsPerFile``."""
    if single_file:
        df = df.coalesce(1)
    w = df.write.mode(mode).option("compression", "snappy")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", str(max_records_per_file))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def append_history(df: DataFrame, path: str, run_col: str = "run_date") -> None:
    """Score history: append-only, partitioned by run so a run reads one folder.

    With dynamic partition overwrite a replayed run replaces its own partition
    instead of duplicating it."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(run_col).parquet(path))


def write_run_metadata(meta: DataFrame, root: str, run_folder_name: str) -> str:
    """One JSON document under ``<root>/<run>/_meta`` (skipped by Bronze readers)."""
    path = f"{root.rstrip('/')}/{run_folder_name}/_meta"
    meta.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return path


def parquet_upsert(updates: DataFrame, path: str, key: str, update_cols: list[str] | None = None, buckets: int = 32):
    """Keyed upsert into a Parquet table (insert new keys, update ``update_cols``); returns the table.

    A table that is not there yet is made from ``updates``' columns with ``buckets``
    buckets; one that is there keeps the contract it was made with, whatever
    ``buckets`` says (see :class:`sleeper.sinks.tables.KeyedTable`). Only the buckets that
    ``updates`` reaches are read and written; the old contents are deleted once the new ones
    are current, so a write that fails leaves the table as it was.
    """
    from sleeper.sinks.tables import KeyedTable

    table = KeyedTable.create_if_absent(updates.sparkSession, path, updates.schema, key, buckets)
    table.upsert(updates, update_cols)
    table.vacuum(keep=1)
    return table
