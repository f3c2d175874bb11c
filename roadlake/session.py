"""Session helpers.  Library code never creates a session; callers pass one in."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "roadlake",
                  event_log_dir: str | None = None, checkpoint: str | None = None) -> SparkSession:
    """A local session for tests and benchmarks (UI off, AQE on).

    Tests have no shared storage, so a fresh scratch folder becomes the checkpoint
    directory unless one is given.
    """
    ckpt = checkpoint or tempfile.mkdtemp(prefix="roadlake-ckpt-")
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.checkpoint.dir", ckpt)
         .config("spark.driver.memory", os.environ.get("ROADLAKE_DRIVER_MEMORY", "8g"))
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if event_log_dir:
        b = b.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log_dir)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    On a cluster that setting points at shared storage and is used as is; without it there
    is no folder that all executors see, which is an error.  Only a local session, whose
    executors are this process, falls back to a scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    d = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="roadlake-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir()
