"""Session helpers: a local session for tests/bench and the checkpoint folder.

On a cluster the session comes from the launcher; only ``checkpoint_dir``
is used there, and it honours ``spark.checkpoint.dir`` when the cluster
sets it (a shared folder). A private folder is created only when the
setting is absent, which is the local/test case.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: AQE for runtime re-planning (partition
# coalescing, skew-join splitting, broadcast switch), UTC so DATE casts of
# timestamps agree everywhere, dynamic partition overwrite for sinks.
JOB_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # HotSpot does not JIT methods above 8000 bytecodes; above this limit Spark
    # falls back from whole-stage codegen to split per-operator code instead of
    # running a huge generated method in the bytecode interpreter
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # a flight takes 25 bytes in Parquet and some 450 as a row: the rows of 128 MB
    # do not fit a task's memory where it sorts, groups or shuffles them
    "spark.sql.files.maxPartitionBytes": "32m",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "runway") -> SparkSession:
    """Session for tests and the bench (``local[cores]``, UI off)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("RUNWAY_DRIVER_MEMORY", "16g"))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="runway-wh-"))
    )
    for k, v in JOB_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_job_conf(spark)
    return spark


def apply_job_conf(spark: SparkSession) -> None:
    """Apply the job settings that the session's launcher did not name itself."""
    named = spark.sparkContext.getConf()
    for k, v in JOB_CONF.items():
        if not named.contains(k) and spark.conf.isModifiable(k):
            spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Uses ``spark.checkpoint.dir`` when the cluster names one. Where it is unset,
    a local session (tests) gets a private folder; a cluster must name a shared
    one, as its executors do not see each other's disks.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if not configured:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="runway-ckpt-")
        spark.sparkContext.setCheckpointDir(configured)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(configured)
    return configured
