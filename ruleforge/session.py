"""Session helpers for tests, the bench and local runs.

Library code never creates or reconfigures a session; it works with the one
it is handed. These helpers only exist so tests and ``bench.py`` start Spark
the same way.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "ruleforge", checkpoint_dir: str | None = None) -> SparkSession:
    """A local session with AQE on, the UI off and UTC as session time zone.
    ``checkpoint_dir`` sets ``spark.checkpoint.dir``; without it nothing that checkpoints will run."""
    master = master or f"local[{os.environ.get('BENCH_CPUS', '*')}]"
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
    )
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The folder ``spark.checkpoint.dir`` names: shared storage on a cluster,
    any folder the caller chose in a local session. There is no default, so
    nothing is ever written to a machine-local folder by accident.

    This is the configured folder itself (stable across applications, unlike
    ``sc.getCheckpointDir()``, which adds a fresh per-application sub-folder):
    streaming queries keep their offsets under it so a restarted application
    resumes instead of reprocessing."""
    configured = spark.conf.get("spark.checkpoint.dir", None)  # works without a SparkContext too
    if not configured:
        configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS or S3)")
    return configured


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make ``checkpoint()`` use the configured folder and return it."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(checkpoint_root(spark))
    return sc.getCheckpointDir()
