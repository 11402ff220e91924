"""Exact quantiles with linear interpolation (the NumPy/pandas default).

One path for every size: equal values are counted (map-side combined, so a
value that holds a third of the rows costs nothing extra), the distinct values
are range-partitioned, and each partition reports its row count per group.
Those counts -- one row per partition and group -- tell which partition holds
each wanted order statistic; only those partitions are searched, each by a
running sum of its own rows.  No task sees more than its range of the values.
"""

from __future__ import annotations

import math
from collections import defaultdict
from typing import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import col

ALL = "__all__"


def group_key(by: str | None):
    return col(by) if by else F.lit(ALL)


def _ranks(n: int, p: float) -> tuple[int, int, float]:
    """Zero-based lower and upper rank and the share of the upper one."""
    h = p * (n - 1)
    return math.floor(h), math.ceil(h), h - math.floor(h)


def quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: str | None = None, groups: list | None = None
              ) -> dict[object, dict[str, list[float | None]]] | dict[str, list[float | None]]:
    """Exact quantiles of several columns; NULL and NaN are skipped.

    Without ``by``: {column: [q(p) for p in probs]}.  With ``by``: the same
    per group value; ``by`` must have few distinct values (dataset families),
    which ``groups`` names where they are known.
    A column without values gives None.  Only counts per partition and the
    wanted values reach the driver."""
    columns = list(columns)
    if not columns:
        return {}
    spark = df.sparkSession
    cells = F.explode(F.array(*[F.struct(F.lit(i).alias("c"), col(name).cast("double").alias("v"))
                                for i, name in enumerate(columns)])).alias("cell")
    values = df.select(group_key(by).alias("g"), cells).select("g", "cell.c", "cell.v")
    known = values.where(F.col("v").isNotNull() & ~F.isnan("v"))
    counted = known.groupBy("g", "c", "v").agg(F.count(F.lit(1)).alias("n"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (counted.repartitionByRange(parts, "g", "c", "v")
               .select("*", F.spark_partition_id().alias("part")).persist(StorageLevel.MEMORY_AND_DISK))
    # a group no column has values in still belongs to the result
    if not by:
        groups = [ALL]
    elif groups is None:
        groups = [r["g"] for r in df.select(group_key(by).alias("g")).distinct().collect()]
    held = defaultdict(list)
    for r in ordered.groupBy("part", "g", "c").agg(F.sum("n").alias("n")).collect():
        held[r["g"], r["c"]].append((r["part"], r["n"]))
    wanted = set()
    for (g, c), pieces in held.items():
        total, before = sum(n for _, n in pieces), 0
        ranks = {k for p in probs for k in _ranks(total, p)[:2]}
        for part, n in sorted(pieces):
            wanted |= {(part, g, c, k, k - before) for k in ranks if before <= k < before + n}
            before += n
    found = {}
    if wanted:
        kind = df.select(group_key(by)).schema[0].dataType.simpleString()
        asked = F.broadcast(spark.createDataFrame(sorted(wanted, key=repr), f"part int, g {kind}, c int, k long, at long"))
        on = ["part", "g", "c"]
        here = ordered.join(asked.select(*on).distinct(), [ordered[x].eqNullSafe(asked[x]) for x in on], "left_semi")
        upto = here.withColumn("upto", F.sum("n").over(Window.partitionBy(*on).orderBy("v").rowsBetween(Window.unboundedPreceding, 0)))
        hit = upto.join(asked, [upto[x].eqNullSafe(asked[x]) for x in on]).where("at < upto and at >= upto - n")
        found = {(r["g"], r["c"], r["k"]): r["v"] for r in hit.select(upto["g"], upto["c"], "k", "v").collect()}
    ordered.unpersist()
    out: dict = {}
    for g in groups:
        out[g] = {}
        for c, name in enumerate(columns):
            total = sum(n for _, n in held[g, c])
            row = []
            for p in probs:
                low, high, share = _ranks(total, p) if total else (0, 0, 0.0)
                a, b = found.get((g, c, low)), found.get((g, c, high))
                row.append(None if not total else a if a == b else (1 - share) * a + share * b)
            out[g][name] = row
    return out if by else out[ALL]


__all__ = ["quantiles", "group_key", "ALL"]
