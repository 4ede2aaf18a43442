"""Spark session and lineage helpers.

Library code never builds its own session: every operator takes a
DataFrame.  This module is for entry points (tests, bench, jobs).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "bidscope") -> SparkSession:
    """Session tuned for the auction jobs.

    On a cluster ``master`` stays None and the launcher's settings win;
    locally we size shuffle partitions to the cores.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    parts = shuffle_partitions or max(8, 2 * cpus)
    spark = (
        builder
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BIDSCOPE_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local master may
    leave it unset (a fresh local folder is used, as in tests); elsewhere a
    machine-local folder would not be seen by the other executors, so this
    raises.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="bidscope-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder.

    Survives executor loss (unlike a local checkpoint).  Spark removes the
    files when the frame is no longer referenced
    (``spark.cleaner.referenceTracking.cleanCheckpoints``).
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
