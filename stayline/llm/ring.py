"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Each shard owns ``virtual`` points of the ring; a key belongs to the next
point clockwise.  A shard takes at most its capacity; keys beyond it continue
clockwise to the next point whose shard has room.  With capacities n/shards
rounded down or up (adding up to n) row counts differ by at most one.

The plan is made from counts per arc: rows are sorted along the ring (range
shuffle of ids and sizes only, ties spread by row number), each sorted
partition reports its rows per arc (at most partitions + arcs rows reach the
driver), overflow is settled between arcs, and the settled runs go back as a
small table from which every row reads its shard and slot.

Defined cases: a null text has no bytes; null keys hash like any value; equal
rows share a ring position and are spread in any order, giving the same rows;
an empty table gives an empty result; other columns are not read.
"""

from bisect import bisect_left
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path

VIRTUAL = 64
MAX_PIECES = 2_000_000      # rows of the broadcast plan; each is about 50 bytes


def ring_points(spark, shards: int, virtual: int):
    """Sorted (point, shard) pairs; a point is the hash of shard and replica."""
    nodes = spark.range(shards * virtual).select(
        F.floor(F.col("id") / virtual).cast("int").alias("shard"), F.xxhash64(F.lit("node"), F.col("id")).alias("point"))
    return sorted((r["point"], r["shard"]) for r in nodes.collect())


def settle(demand: dict, owners: list, capacity: list):
    """Runs (arc, first rank, rows, shard) that use up each arc's ``demand``.

    In rounds, every waiting run asks the shard of the point it stands at;
    the shard takes what fits, and the rest moves to the next point whose
    shard has room.
    """
    room, arcs = list(capacity), len(owners)
    waiting = [(arc, arc, 0, n) for arc, n in sorted(demand.items()) if n]
    runs = []
    while waiting:
        later = []
        for at, arc, first, n in waiting:
            shard = owners[at]
            take = min(n, room[shard])
            if take:
                room[shard] -= take
                runs.append((arc, first, take, shard))
            if n > take:
                later.append((at, arc, first + take, n - take))
        open_arcs = [a for a in range(arcs) if room[owners[a]]]
        if later and not open_arcs:
            raise ValueError("the capacities are smaller than the rows")
        waiting = []
        for at, arc, first, n in later:
            k = bisect_left(open_arcs, at + 1)
            waiting.append((open_arcs[k] if k < len(open_arcs) else open_arcs[0], arc, first, n))
        waiting.sort(key=lambda x: ((x[0] - x[1]) % arcs, x[1]))      # nearest first
    return runs


def even_capacities(rows: int, shards: int) -> list:
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def assign(keyed: DataFrame, position: Column, shards: int, virtual: int = VIRTUAL, slack: float = 0.0) -> DataFrame:
    """``keyed`` with columns shard and slot (gapless from 0 in each shard).

    ``slack`` 0 gives exactly even shards; a slack of e lets each shard take
    up to (1 + e) times its even share, which lowers movement when shards change.
    """
    spark = keyed.sparkSession
    points = ring_points(spark, shards, virtual)
    owners = [s for _, s in points] + [points[0][1]]     # the stretch past the last point belongs to the first
    table = scratch_path(spark, "ring")
    row = F.struct(*[F.col(f"`{c}`") for c in keyed.columns]).alias("row")
    (keyed.select(row, position.alias("position"), F.monotonically_increasing_id().alias("tie"))
     .repartitionByRange(F.col("position"), F.col("tie")).sortWithinPartitions("position", "tie")
     .select("row", "position", F.monotonically_increasing_id().alias("place")).write.parquet(table))
    bounds = F.lit([p for p, _ in points])
    ordered = spark.read.parquet(table).select(
        "row", F.shiftright("place", 33).cast("int").alias("part"), F.col("place").bitwiseAND((1 << 33) - 1).alias("local"),
        "position").withColumn("arc", arc_of(F.col("position"), bounds, len(points)))
    counts = sorted((r["part"], r["first"], r["arc"], r["n"]) for r in
                    ordered.groupBy("part", "arc").agg(F.count(F.lit(1)).alias("n"), F.min("local").alias("first")).collect())
    total, demand = sum(c[3] for c in counts), defaultdict(int)
    for _, _, arc, n in counts:
        demand[arc] += n
    capacity = even_capacities(total, shards)
    if slack:
        capacity = [int(c * (1 + slack)) + 1 for c in capacity]
    runs, taken = defaultdict(list), [0] * shards
    for arc, first, n, shard in sorted(settle(demand, owners, capacity)):
        runs[arc].append((first, n, shard, taken[shard]))
        taken[shard] += n
    pieces, before = [], defaultdict(int)
    for part, first, arc, n in counts:
        low, high = before[arc], before[arc] + n
        before[arc] = high
        for start, size, shard, slot in runs[arc]:
            a, b = max(low, start), min(high, start + size)
            if a < b:
                pieces.append((part, arc, first + a - low, first + b - low, shard, slot + a - start))
    if len(pieces) > MAX_PIECES:
        raise ValueError(f"{len(pieces)} runs are more than the plan table may hold")
    schema = "part int, arc int, low long, high long, shard int, first_slot long"
    plan = F.broadcast(spark.createDataFrame(pieces, schema))
    return (ordered.join(plan, ["part", "arc"]).where("local >= low and local < high")
            .select("row.*", "shard", (F.col("first_slot") + F.col("local") - F.col("low")).alias("slot")))


def arc_of(position: Column, bounds: Column, n: int) -> Column:
    """Number of points below ``position``, which is the arc it lies in, found
    bit by bit in built-in functions."""
    steps = [1 << k for k in reversed(range(n.bit_length()))]
    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0),
                       lambda k, s: F.when((k + s <= n) & (F.get(bounds, k + s - 1) < position), k + s).otherwise(k))


def shard_documents(docs: DataFrame, shards: int, virtual: int = VIRTUAL, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row of ``docs``."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    keyed = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), (F.octet_length(body) + 8).cast("long").alias("size"),
                        F.crc32(body.cast("binary")).alias("text_crc32"))
    placed = assign(keyed, F.xxhash64("doc_id"), shards, virtual)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
