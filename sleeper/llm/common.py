"""Helpers the operators of this package share: row identity, written
intermediates, joins that stand hot keys, Arrow record batches."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sleeper.operators.skew import join_sites  # noqa: F401  for the operators
from sleeper.session import scratch_path, setting

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(c: F.Column) -> F.Column:
    """``c`` with A-Z lower-cased and every other character as it is; null is empty."""
    return F.translate(F.coalesce(c, F.lit("")), UPPER, LOWER)


def keep(df: DataFrame, name: str, batch: int | None = None, **options) -> DataFrame:
    """``df`` written once under the shared checkpoint folder and read back.

    Cuts the lineage: a lost executor costs a reread, not the work before it.
    ``batch`` is the number of rows that go to Python at once, for large rows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    # the shuffle files of this write are of no use after it
    conf = {"spark__sql__classic__shuffleDependency__fileCleanup__enabled": "true"}
    if batch:
        conf["spark__sql__execution__arrow__maxRecordsPerBatch"] = str(batch)
    with setting(spark, **conf):
        df.write.options(**({"compression": "zstd"} | options)).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_kept(*frames: DataFrame) -> None:
    """Delete the files of frames made by :func:`keep` that nothing reads any more."""
    for df in frames:
        spark = df.sparkSession
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            p = jvm.org.apache.hadoop.fs.Path(folder)
            p.getFileSystem(conf).delete(p, True)


def _is_scan(df: DataFrame) -> bool:
    """Does ``df`` only project or filter one scan of files? Then a row's place in its file names it."""
    tree = df._jdf.queryExecution().analyzed().toString().splitlines()
    return all(re.match(r"[\s:+-]*(Project|Filter|Relation|SubqueryAlias|View)\b", line) for line in tree if line)


def with_row_id(df: DataFrame, *cols, file: str = "_file", row: str = "_row") -> DataFrame:
    """The columns ``cols`` of ``df`` plus ``_file`` and ``_row``, an identity for each
    row that holds over several scans: the place in the Parquet file, or, where
    ``df`` is not a plain scan of files, a number given once in a written copy."""
    if _is_scan(df):
        try:
            return df.select(*cols, F.xxhash64("_metadata.file_path").alias(file),
                             F.col("_metadata.row_index").alias(row))
        except AnalysisException:  # not Parquet, or a column of the name _metadata
            pass
    return keep(df.select(*cols, F.lit(0).cast("long").alias(file), F.monotonically_increasing_id().alias(row)), "rows")


def keep_rows(docs: DataFrame, decide: Callable[[DataFrame], DataFrame], *cols) -> DataFrame:
    """The rows of ``docs`` that ``decide`` does not reject, with their columns as they are.

    ``decide`` gets ``cols`` with each row's identity and returns the identities
    (``_file``, ``_row``) of the rows that go.
    """
    names = docs.columns
    file, row = (next(n for n in (f"{x}{i}" for i in range(len(names) + 1)) if n not in names) for x in ("_f", "_r"))
    whole = with_row_id(docs, "*", file=file, row=row)
    gone = decide(whole.select(*cols, F.col(file).alias("_file"), F.col(row).alias("_row")))
    gone = gone.select(F.col("_file").alias(file), F.col("_row").alias(row))
    return whole.join(gone, [file, row], "left_anti").select(*[F.col(f"`{n}`") for n in names])


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterable], schema: str,
                rows: int = 512) -> DataFrame:
    """``mapInArrow`` over slices of at most ``rows`` rows; ``fn`` gets and gives record batches."""

    def run(batches):
        yield from fn(s for b in batches for s in (b.slice(i, rows) for i in range(0, b.num_rows, rows)))

    return df.mapInArrow(run, schema)


def texts_of(column: pa.Array) -> list[str]:
    """The strings of an Arrow column, null as the empty text."""
    return [x or "" for x in column.to_pylist()]
