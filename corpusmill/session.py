"""Spark session and lineage helpers.

The library never creates its own session inside an operator; callers pass
one in.  ``get_spark`` is for tests, the bench and command-line use.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import weakref
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, app: str = "corpusmill",
              shuffle_partitions: int | None = None) -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder
        .master(master or f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions",
                str(shuffle_partitions or os.environ.get("CORPUSMILL_SHUFFLE_PARTITIONS", cpus)))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.optimizer.canChangeCachedPlanOutputPartitioning", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("CORPUSMILL_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def adaptive_caching(spark: SparkSession) -> None:
    """Let AQE size the partitions of persisted and checkpointed plans.

    Runtime SQL setting.  Without it a persisted frame keeps
    ``spark.sql.shuffle.partitions`` partitions however small it is, and
    every later scan of it runs that many tasks.  The operators that persist
    only reuse frames through joins and aggregations that shuffle anyway.
    """
    spark.conf.set("spark.sql.optimizer.canChangeCachedPlanOutputPartitioning", "true")


# Runtime SQL setting: the shuffle files of a query go when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries planned and run within delete their shuffle files as they end.

    Otherwise the files stay until the driver happens to collect its garbage, and those of
    all finished steps lie on the disk at once.  A query run again computes its shuffles again.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder of the session.

    On a cluster this is the shared folder named by ``spark.checkpoint.dir``;
    a cluster without that setting is an error.  Only a local master gets a
    folder under /tmp when nothing is configured.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="corpusmill-ckpt-", dir="/tmp")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def reliable_checkpoint(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Cut lineage: write the frame once to the shared checkpoint folder and read it back.

    A written table survives executor loss, unlike ``localCheckpoint``;
    ``DataFrame.checkpoint`` would compute the last stage twice.  The files
    go when the session ends or ``release`` is called, the shuffles behind them once the
    table is written.  ``compression`` is a codec of Parquet, the session's if none is named.
    """
    spark = df.sparkSession
    adaptive_caching(spark)
    path = f"{checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    with shuffles_dropped(spark):
        df.write.parquet(path, compression=compression)
    fs, hadoop_path = _file(spark, path)
    fs.deleteOnExit(hadoop_path)
    back = spark.read.schema(df.schema).parquet(path)
    _WRITTEN[back] = path
    return back


# Files behind the frames of ``reliable_checkpoint``.
_WRITTEN: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def _file(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def release(df: DataFrame) -> None:
    """Delete the files of a frame from ``reliable_checkpoint`` that nothing reads any more."""
    path = _WRITTEN.pop(df, None)
    if path:
        fs, p = _file(df.sparkSession, path)
        fs.delete(p, True)
