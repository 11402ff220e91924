"""Gapless numbers within groups, without collecting a group anywhere."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import saved


def numbered(rows: DataFrame, group: str, order: list[str], number: str = "idx", size: str = "n") -> DataFrame:
    """``rows`` with a number from 0 within ``group`` in the given order, and the group's size.

    The rows are range-partitioned by group and order, so a group that holds a
    third of them is spread over many tasks.  Spark's increasing ids tell each
    row's partition and place; one row per partition and group carries the
    place of its first row and the rows of the group before it.  The placed
    rows are a written table, so that lost executors cannot change the ids.
    ``group`` must not be null; rows equal in ``order`` are numbered in any order.
    """
    placed, _ = saved(rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
                      .withColumn("at", F.monotonically_increasing_id()), "placed")
    part = F.shiftright("at", 33)
    runs = placed.groupBy(F.col(group).alias("group_of"), part.alias("part")).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"))
    own = Window.partitionBy("group_of")
    before = F.sum("rows").over(own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select("group_of", "part", "first", F.coalesce(before, F.lit(0)).alias("before"), F.sum("rows").over(own).alias(size))
    found = placed.join(runs, (placed[group] == runs["group_of"]) & (part == runs["part"]))
    return found.withColumn(number, F.col("at") - F.col("first") + F.col("before")).drop("group_of", "part", "first", "before", "at")
