"""Session settings every job in the library relies on.

The library never creates a cluster session on its own behalf; callers pass a
``SparkSession``.  ``configure`` applies the few semantic settings the
transforms depend on, and ``local_session`` is the helper used by tests and
the benchmark.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings the transforms depend on for correct results.
SEMANTIC_CONF = {
    # Trip timestamps are zone-less; keep every conversion in UTC.
    "spark.sql.session.timeZone": "UTC",
    # Partition values are zero-padded strings ('01'), never inferred ints.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Rewriting a month replaces that month's partition only.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# Settings for scale: runtime re-planning, skew handling, file sizing.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Bound output files so one month never becomes one giant file.
    "spark.sql.files.maxRecordsPerFile": "5000000",
}

# Settings for writing the wide rows of the trip tables by month; the
# training-data operators do without them.
WIDE_ROW_CONF = {
    # A task writes its months side by side and sorts (and spills) nothing.
    "spark.sql.maxConcurrentOutputFileWriters": "64",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the semantic and scale settings to an existing session."""
    for key, value in {**SEMANTIC_CONF, **SCALE_CONF}.items():
        spark.conf.set(key, value)
    return spark


def configure_wide(spark: SparkSession) -> SparkSession:
    """``configure``, and the settings for writes of wide rows by month."""
    for key, value in WIDE_ROW_CONF.items():
        spark.conf.set(key, value)
    return configure(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and intermediate tables.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is always
    used as given (as is a folder already set on the context).  Only when
    neither is set and the master is a single local process (tests) a private
    folder is created; on any other master that is an error, since executors
    would not see the driver's folder.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)  # for DataFrame.checkpoint()
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    # ``spark.checkpoint.dir`` is a core setting and cannot be changed on a
    # running session; the context's checkpoint folder can.
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="fareflow-ckpt-"))
    return sc.getCheckpointDir().rstrip("/")


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "fareflow") -> SparkSession:
    """A local session with the library's settings (tests, bench)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("FAREFLOW_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in {**SEMANTIC_CONF, **SCALE_CONF}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark
