"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again.

Every stage works on all rows its predecessor kept and, but for the last, returns
the columns of ``documents``. Rows are told apart by their place in the files, so
repeated ids, nulls in any column and further columns pass through as they are. Null and
empty texts are judged like other texts (they are copies of each other, have no benchmark
window and no tokens), very long texts are read whole by every stage, and ties between copies are
decided by id and then by place. An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sleeper.llm import bpe, decontaminate, exact_dedup, quality, simhash
from sleeper.llm.common import keep, keep_rows, table
from sleeper.llm.queries import vocabulary


def _rows(*more) -> list:
    return [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *more]


def accept(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier holds for toxic or of low quality go."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    site = [F.col("source").cast("string").alias("host"), F.col("lang").cast("string").alias("path")]
    return keep_rows(docs, lambda rows: quality.judge_rows(rows, model).where(~F.col("kept")), *_rows(*site))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for the case of A-Z, the row with the largest id stays."""
    def copies(rows: DataFrame) -> DataFrame:
        index = exact_dedup.DigestIndex(spark)
        found = exact_dedup.dedup_rows(rows, index)
        index.close()
        return found.where(~F.col("kept"))

    return keep_rows(docs, copies, *_rows())


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by fingerprints at most 2 bits apart, the one with the smallest id stays."""
    return keep_rows(docs, lambda rows: simhash.near_duplicate_rows(rows, shingle=3, max_bits=2).where(~F.col("kept")),
                     *_rows())


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    benchmark = table(spark, sf_dir, "benchmark")
    return keep_rows(docs, lambda rows: decontaminate.contamination_rows(rows, benchmark).where(F.size("hits") > 0),
                     *_rows())


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every remaining text encoded and decoded again."""
    got = bpe.round_trip(docs, vocabulary())
    return got.select("doc_id", "n_tokens", "ids_sha256", F.sha2(F.col("text"), 256).alias("decoded_sha256"))


STAGES = [("quality classifier", accept), ("exact dedup", exact), ("simhash near-dedup", near),
          ("benchmark decontamination", clean), ("bpe encoding and decoding", tokens)]

#: SQL can't express the stages; the pipeline is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
