"""Exact dedup against a persistent digest index.

The index is a bucketed table, sorted by digest inside each bucket. A batch of
documents is reduced to one row per digest, stripped of what the index holds by a
sort-merge anti join (the index side is read in its buckets, without a shuffle),
and what is new is appended. DataFrame and SQL operations only.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sleeper.llm.common import ascii_lower, join_sites, keep, with_row_id
from sleeper.session import scratch_path
from sleeper.sinks.tables import CONTRACT, record_once


class DigestIndex:
    """Digests of all texts seen so far, on a path every executor can reach.

    Opening an existing path goes on with what it holds, in the number of buckets it was
    made with, which is recorded beside the data: ``buckets`` (by default the
    session's shuffle partitions) counts only where there is no index yet.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None):
        self.spark = spark
        self.path = path or scratch_path(spark, "digests")
        wanted = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.buckets = record_once(spark, f"{self.path.rstrip('/')}/{CONTRACT}", {"key": ["digest"], "buckets": wanted})["buckets"]
        self.table = f"digests_{uuid.uuid4().hex}"
        spark.sql(f"CREATE TABLE {self.table} (digest BINARY, keep_id BIGINT, batch STRING) USING parquet "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.path}'")

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def append(self, rows: DataFrame) -> None:
        """Add (digest, keep_id, batch), one file per bucket."""
        rows.select("digest", "keep_id", "batch").repartition(self.buckets, "digest") \
            .sortWithinPartitions("digest").write.mode("append").insertInto(self.table)

    def close(self) -> None:
        """Forget the table's name; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")


def digests(rows: DataFrame) -> DataFrame:
    """(_file, _row, doc_id, digest): SHA-256 of the text with A-Z lower-cased, null as empty."""
    return rows.select("_file", "_row", "doc_id",
                       F.unhex(F.sha2(ascii_lower(F.col("text")).cast("binary"), 256)).alias("digest"))


def dedup(docs: DataFrame, index: DigestIndex, batch: str = "0", id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """:func:`dedup_rows` over any frame with an id and a text column."""
    return dedup_rows(with_row_id(docs, F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")),
                      index, batch)


def dedup_rows(docs: DataFrame, index: DigestIndex, batch: str = "0") -> DataFrame:
    """Deduplicate a batch (_file, _row, doc_id, text) within itself and against the index, and append what is new.

    Returns one row per row of ``docs``: ``_file``, ``_row``, ``doc_id``,
    ``digest``, ``keep_id``, ``group_size`` (rows of the batch with this text),
    ``kept``. Of equal texts the row with the largest ``doc_id`` stays, unless an
    earlier batch already brought the text: then none does, and ``keep_id`` is the
    earlier document. A null id is below every other; of rows with the same text
    and the same id, one stays. Null text equals empty text. An empty batch gives
    no rows. Very long texts are hashed whole, and only their digest is shuffled. Other
    columns of ``docs`` are never read. A batch run again under its name gives the same rows
    and appends nothing twice.
    """
    rows = keep(digests(docs), "digests_batch")
    groups = rows.groupBy("digest").agg(F.max(F.struct("doc_id", "_file", "_row")).alias("top"),
                                        F.count("*").alias("group_size"))
    seen = index.read()
    groups = keep(
        groups.select("digest", "group_size", F.col("top.doc_id").alias("own_id"),
                      F.col("top._file").alias("top_file"), F.col("top._row").alias("top_row"))
        .join(seen.where(F.col("batch") != batch).select("digest", F.col("keep_id").alias("old_id"),
                                                         F.lit(True).alias("old")).hint("merge"),
              "digest", "left"), "digest_groups")
    fresh = groups.where(F.col("old").isNull()).join(seen.select("digest").hint("merge"), "digest", "left_anti")
    index.append(fresh.select("digest", F.col("own_id").alias("keep_id"), F.lit(batch).alias("batch")))
    return join_sites(rows, groups, ["digest"], "group_size").select(
        "_file", "_row", "doc_id", "digest",
        F.when(F.col("old"), F.col("old_id")).otherwise(F.col("own_id")).alias("keep_id"), "group_size",
        (F.col("old").isNull() & (F.col("_file") == F.col("top_file")) & (F.col("_row") == F.col("top_row")))
        .alias("kept"))
