"""Connected components of an edge table by alternating star contractions."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import drop, saved

MAX_ROUNDS = 60


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in ``edges`` (columns a, b), the
    component being its smallest node.  Edges stay distributed: a round links
    each larger neighbour of a node to the smallest one (large star), then the
    smaller neighbours (small star), each with one pre-aggregated minimum and
    one join, until the edges no longer change.  Rounds are written tables.
    """
    spark = edges.sparkSession
    now, path = saved(edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), "edges")
    state = None
    for _ in range(MAX_ROUNDS):
        then, state = state, now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if state == then or state[0] == 0:
            return now.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(now.select("lo", "lo").distinct())
        least = (now.select(F.col("hi").alias("at"), "lo").union(now.select(F.col("lo").alias("at"), "lo"))
                 .groupBy("at").agg(F.min("lo").alias("least")))
        large = now.join(least, now["lo"] == least["at"]).select("hi", F.col("least").alias("lo")).distinct()
        down = large.groupBy("hi").agg(F.min("lo").alias("least"))
        small = large.join(down, "hi").where("lo <> least").select(F.col("lo").alias("hi"), F.col("least").alias("lo"))
        last = path
        now, path = saved(small.union(down.select("hi", "least")).distinct(), "edges")
        drop(spark, last)
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
