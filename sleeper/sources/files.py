"""Readers for the landed layers: Bronze JSONL and Silver/Gold Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sleeper import schemas as T
from sleeper.functions.runs import run_ts_from_path

CORRUPT = "_corrupt_record"


def bronze_reader(spark: SparkSession, schema: StructType = T.BRONZE, stream: bool = False):
    """JSON Lines reader with an explicit schema, recursive file lookup and a
    corrupt-record column. Folders whose names start with '_' (run metadata) are
    skipped by Spark's file listing."""
    full = StructType(list(schema.fields) + [StructField(CORRUPT, StringType())])
    r = (spark.readStream if stream else spark.read).schema(full)
    return (r.option("recursiveFileLookup", "true")
             .option("mode", "PERMISSIVE")
             .option("columnNameOfCorruptRecord", CORRUPT)
             .option("multiLine", "false"))


def with_lineage(df: DataFrame) -> DataFrame:
    """Add run_ts (from the run folder in the path) and source_file."""
    return df.withColumns({"run_ts": run_ts_from_path(), "source_file": F.col("_metadata.file_path")})


def read_bronze(spark: SparkSession, root: str, schema: StructType = T.BRONZE) -> DataFrame:
    """Every Bronze JSONL record under ``root`` (all runs) with its lineage."""
    return with_lineage(bronze_reader(spark, schema).json(root))


def read_parquet_tree(spark: SparkSession, root: str, schema: StructType | None = None) -> DataFrame:
    """Every ``*.parquet`` file under ``root`` (recursively). Zero-byte files are
    skipped. A missing root gives an empty typed frame when ``schema`` is given."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    r = r.option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
    try:
        return r.parquet(root)
    except Exception as e:  # noqa: BLE001
        if schema is not None and "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], schema)
        raise


def read_silver(spark: SparkSession, root: str) -> DataFrame:
    return read_parquet_tree(spark, root, T.SILVER)
