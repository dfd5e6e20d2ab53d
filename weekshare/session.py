"""Spark session helpers.

The library never creates a session behind the caller's back: every public
function takes a ``SparkSession`` or a ``DataFrame``. ``local_session`` is for
tests, the bench and ``__spark_entry__``; on a cluster, use the cluster's
session and its configuration.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings the pipeline relies on. ANSI mode stays on (Spark 4 default): the
# share division is written so that it never divides by zero.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "weekshare") -> SparkSession:
    """Local session for tests and the bench.

    ``spark.checkpoint.dir`` and the warehouse folder are set to fresh scratch
    folders only here, where no cluster names them.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        # A long-lived session runs many distinct plans; keep their generated
        # classes (a static setting, so it is set at build time).
        .config("spark.sql.codegen.cache.maxEntries", "1000")
    )
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    active = SparkSession.getActiveSession()
    if active is None or not active.sparkContext.getConf().get("spark.checkpoint.dir", None):
        builder = builder.config("spark.checkpoint.dir",
                                 tempfile.mkdtemp(prefix="weekshare-ckpt-"))
    if active is None:
        builder = builder.config("spark.sql.warehouse.dir",
                                 tempfile.mkdtemp(prefix="weekshare-warehouse-"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, name: str) -> str:
    """Path of a folder for materialised tables under ``spark.checkpoint.dir``.

    On a cluster that setting names a shared file system, so a table written
    there survives the loss of any executor. The setting is read from the
    session. Only a local-mode session without it gets a scratch folder; a
    cluster session without it is an error, never a machine-local folder.
    """
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS/S3)")
        base = tempfile.mkdtemp(prefix="weekshare-ckpt-")
        sc.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}"
