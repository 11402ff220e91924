"""Intermediate tables in the shared scratch folder."""

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path


def saved(frame: DataFrame, name: str):
    """(the frame written once and read back, its path): cuts the lineage, so
    that a lost executor costs at most the running step."""
    path = scratch_path(frame.sparkSession, name)
    frame.write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.parquet(path), path


def drop(spark: SparkSession, path: str) -> None:
    """Delete a table that no later step reads."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
