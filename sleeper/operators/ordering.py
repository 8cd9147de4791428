"""Positions in a global order without funnelling all rows into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sleeper.session import materialize

#: Rows that one task may be given to rank; more are dealt by range.
ONE_TASK = 1 << 17


def with_position(df: DataFrame, order: list[Column | str], name: str = "position",
                  num_partitions: int | None = None) -> DataFrame:
    """1-based position of each row in ``order`` (which must end in a unique column).

    Range-partition by the order, sort inside partitions, count rows per
    partition (one small row each), turn the counts into offsets and add
    them back. ``row_number()`` over an unpartitioned window would instead
    move every row into a single task. The partitioned rows are written once
    with their (partition, local index) so the counts and the offsets come from
    the same partitioning, even when the input order is not deterministic.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = [F.col(o) if isinstance(o, str) else o for o in order]
    ranged = (df.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
                .withColumn("_pid", F.spark_partition_id())
                .withColumn("_local", F.monotonically_increasing_id()))
    ranged = materialize(ranged, "positions")
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_pid", (F.sum("_n").over(Window.orderBy("_pid")) - F.col("_n")).alias("_off"))
    # One row per partition: a bounded broadcast.
    out = ranged.join(F.broadcast(offsets), "_pid")
    local = F.col("_local") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return out.withColumn(name, F.col("_off") + local + 1).drop("_pid", "_local", "_off")


def position_within(df: DataFrame, group: str, order: list[Column | str], name: str = "position",
                    num_partitions: int | None = None) -> DataFrame:
    """1-based position of each row inside its ``group``, in ``order`` (which must end in a unique column).

    As :func:`with_position`, dealt by range of (group, order): a group that holds most
    of the rows lies in many partitions, and the rows it has in each of them are summed up in
    order (one count a group and partition: together no more than groups and partitions).
    A window over the group would bring it whole into one task.
    Rows without a group are a group of their own.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = [F.col(group), *[F.col(o) if isinstance(o, str) else o for o in order]]
    ranged = (df.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
                .withColumn("_pid", F.spark_partition_id())
                .withColumn("_local", F.monotonically_increasing_id()))
    ranged = materialize(ranged, "positions")
    runs = ranged.groupBy("_pid", F.col(group).alias("_g")).agg(F.count(F.lit(1)).alias("_n"),
                                                               F.min("_local").alias("_begin"))
    before = F.sum("_n").over(Window.partitionBy("_g").orderBy("_pid")) - F.col("_n")
    runs = runs.select(F.col("_pid").alias("_p"), "_g", (before - F.col("_begin")).alias("_shift"))
    out = ranged.join(runs, (F.col("_pid") == F.col("_p")) & F.col(group).eqNullSafe(F.col("_g")))
    return out.withColumn(name, F.col("_local") + F.col("_shift") + 1).drop("_pid", "_local", "_p", "_g", "_shift")


def kth_smallest(df: DataFrame, order: str, k: int, num_partitions: int | None = None) -> Column:
    """Scalar subquery: the ``k``-th smallest value of ``order`` (NULL if fewer rows are not null).

    The values are dealt by range and sorted in their partitions, the partitions'
    sizes summed up in order (one row a partition), and only the partition in which the
    ``k``-th row lies is searched for it. So ``k`` may be any number: no task keeps ``k``
    rows, and neither does the driver. Equal values are dealt to several partitions.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    values = df.where(F.col(order).isNotNull()).select(F.col(order).alias("_v"),
                                                       F.monotonically_increasing_id().alias("_t"))
    ranged = (values.repartitionByRange(n, "_v", "_t").sortWithinPartitions("_v")
              .select("_v", F.spark_partition_id().alias("_pid"), F.monotonically_increasing_id().alias("_local")))
    ranged = materialize(ranged, "order_statistic")
    sizes = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_pid", "_n", (F.sum("_n").over(Window.orderBy("_pid")) - F.col("_n")).alias("_before"))
    hit = before.where((F.col("_before") < k) & (F.col("_before") + F.col("_n") >= k))  # one row or none
    local = F.col("_local") - F.shiftleft(F.col("_pid").cast("long"), 33)
    inside = ranged.join(F.broadcast(hit), "_pid").where(F.col("_before") + local + 1 == k)
    return inside.agg(F.max("_v")).scalar()
