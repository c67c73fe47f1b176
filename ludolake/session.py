"""Spark session helpers.

The library never builds its own cluster session: jobs take the caller's
``SparkSession``. ``local_session`` exists for tests and the bench only.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. They are set on the caller's session only
# when absent, so a cluster's own values win.
JOB_DEFAULTS = {
    # AQE re-plans joins from runtime sizes (broadcast only when the measured
    # side is under spark.sql.autoBroadcastJoinThreshold), coalesces small
    # shuffle partitions and splits skewed ones.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Day columns and micro timestamps are computed in UTC.
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply ``JOB_DEFAULTS`` where the session has no value yet."""
    for key, value in JOB_DEFAULTS.items():
        if spark.conf.get(key, None) in (None, ""):
            spark.conf.set(key, value)
    # Always UTC: the day of an event must not depend on the driver's zone.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and scratch tables.

    Read from ``spark.checkpoint.dir`` (or what was set on the context). Only
    a local session that has none, as in tests, gets a temp folder of its own;
    on a cluster a missing setting is an error, because executors can't see a
    folder of the driver's machine.
    """
    context = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not path:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="ludolake-ckpt-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(path)
    return path


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "ludolake") -> SparkSession:
    """A local session for tests and the bench (not for cluster jobs)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("LUDOLAKE_DRIVER_MEM", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in JOB_DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark
