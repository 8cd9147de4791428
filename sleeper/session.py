"""Session construction and shared scratch locations."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession


#: Scratch paths handed out and not deleted yet.
_SCRATCH: list[str] = []


def scale_conf(input_bytes: int, shuffle_bytes_per_partition: int = 256 << 20,
               split_bytes: int = 256 << 20, max_partitions: int = 500_000) -> dict[str, str]:
    """Shuffle and scan sizing from the input size.

    AQE coalesces small shuffle partitions but never splits large ones (except
    skewed join partitions), so the initial count must come from the data: about
    ``input_bytes / shuffle_bytes_per_partition`` (100 TB -> ~400k, capped), with
    AQE merging towards its advisory size where the shuffled data is smaller than
    the input. Scan splits of ``split_bytes`` keep per-task input bounded.
    """
    n = max(1, min(max_partitions, -(-input_bytes // shuffle_bytes_per_partition)))
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
    }


def build_session(master: str | None = None, app: str = "sleeper",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None, input_bytes: int | None = None) -> SparkSession:
    """Session with AQE on, UI off, UTC clock and Arrow transfer enabled.

    ``master`` is only set for local runs; on a cluster the launcher decides.
    ``input_bytes`` sizes shuffles and scan splits for the data (see :func:`scale_conf`).
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # whole documents go through the one text UDF: keep Arrow batches modest
        "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    }
    if input_bytes:
        conf.update(scale_conf(input_bytes))
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    It is read from the session. Only when it is unset (local tests) is a
    private folder created and registered as the checkpoint dir.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="sleeper-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path under the checkpoint root."""
    path = os.path.join(checkpoint_root(spark), "sleeper", f"{name}-{uuid.uuid4().hex}")
    _SCRATCH.append(path)
    return path


def purge_scratch(spark: SparkSession) -> int:
    """Delete every scratch path this process has handed out, when no frame over them is
    needed any more; returns how many there were."""
    conf, jvm = spark._jsc.hadoopConfiguration(), spark._jvm
    done = len(_SCRATCH)
    while _SCRATCH:
        p = jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        p.getFileSystem(conf).delete(p, True)
    return done


def materialize(df, name: str = "stage", **options):
    """Write ``df`` once as Parquet under the shared checkpoint folder and read it back.

    For intermediates that several consumers read (a scalar subquery plus the
    main plan, or several branches): without this Spark recomputes the whole
    upstream plan per consumer. Parquet keeps it columnar (a max over one
    column reads one column), and the files outlive a lost executor.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").options(**options).parquet(path)
    return spark.read.parquet(path)


@contextmanager
def setting(spark: SparkSession, **conf: str):
    """SQL settings (dots as double underscores) for the plans that run inside."""
    names = {k.replace("__", "."): v for k, v in conf.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
