"""Spark session settings and the shared scratch location.

Cluster code never picks a machine-local folder: lineage cuts and round-trip
outputs go under ``spark.checkpoint.dir``, which a cluster points at shared
storage.  Only when it is unset (local tests, the bench) is one created.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale: adaptive re-planning (coalesces small shuffle
# partitions, splits skewed join partitions), UTC so timestamps compare the
# same everywhere, and no UI server.
_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # trees down to MLlib's depth limit are serialised recursively
    "spark.driver.extraJavaOptions": "-Xss16m",
    "spark.executor.extraJavaOptions": "-Xss16m",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "stayline", local_driver_memory: str = "12g") -> SparkSession:
    """Build (or reuse) a session with the engine's settings.

    On a cluster the master and partition counts come from spark-submit; the
    arguments exist for local runs and tests.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            # Local mode runs executors inside the driver JVM; its 1 GiB
            # default heap is too small for eight concurrent tree fits.
            builder = builder.config("spark.driver.memory", local_driver_memory)
    for k, v in _SETTINGS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint directory.

    A machine-local one is made only for a ``local`` master (tests, the
    bench); on a cluster an unset ``spark.checkpoint.dir`` raises, because a
    folder of the driver's machine is invisible to the executors.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not current:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="stayline-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(current)
    return spark.sparkContext.getCheckpointDir() or current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for a written table."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "stayline", f"{name}-{uuid.uuid4().hex}")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared scratch folder: its plan runs once."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
