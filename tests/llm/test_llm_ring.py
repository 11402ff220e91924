"""Consistent-hash ring with bounded loads."""

import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F
from stayline.llm import queries, ring

from llm_cases import edge_docs, empty_docs, rows_of

SF = "/root/testdata/sf0.001"


def plain_placing(positions, shards, virtual, spark):
    """Rank by rank, one key after another in rounds, on the sorted keys."""
    points = ring.ring_points(spark, shards, virtual)
    owners = [s for _, s in points] + [points[0][1]]
    ordered = sorted(range(len(positions)), key=lambda i: positions[i])
    demand = Counter(sum(p < positions[i] for p, _ in points) for i in ordered)
    runs = ring.settle(demand, owners, ring.even_capacities(len(positions), shards))
    rank, place = Counter(), {}
    for i in ordered:
        arc = sum(p < positions[i] for p, _ in points)
        place[i] = next(s for a, first, n, s in runs if a == arc and first <= rank[arc] < first + n)
        rank[arc] += 1
    return place


@pytest.mark.parametrize("rows,shards,parts", [(500, 24, 1), (500, 7, 5), (10, 24, 3), (1, 3, 1)])
def test_law_slots_and_plan(spark, rows, shards, parts):
    docs = spark.range(rows).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id")).alias("text")).repartition(parts)
    got = ring.shard_documents(docs, shards, virtual=8).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(rows))
    counts = Counter(r["shard"] for r in got)
    assert max(counts[s] for s in range(shards)) - min(counts[s] for s in range(shards)) <= 1
    for s in range(shards):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(counts[s]))
    hashed = [r[0] for r in spark.range(rows).orderBy("id").select(F.xxhash64("id")).collect()]
    assert {r["doc_id"]: r["shard"] for r in got} == plain_placing(hashed, shards, 8, spark)


def test_limited_movement(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    keyed = docs.select("doc_id")
    place = lambda n, slack: {r["doc_id"]: r["shard"] for r in ring.assign(keyed, F.xxhash64("doc_id"), n, slack=slack).collect()}
    for slack, most in ((0.25, 0.25), (0.0, 0.45)):
        before, after = place(10, slack), place(11, slack)
        assert sum(before[k] != after[k] for k in before) / 4000 < most


def test_digests_and_edges(spark):
    docs = edge_docs(spark)
    got = ring.shard_documents(docs, 4)
    want = [(r["doc_id"], len((r["text"] or "").encode()) + 8, zlib.crc32((r["text"] or "").encode())) for r in docs.select("doc_id", "text").collect()]
    assert rows_of(got.select("doc_id", "size", "text_crc32")) == sorted(want, key=repr)
    assert ring.shard_documents(empty_docs(spark), 4).count() == 0
    hot = spark.range(900).select(F.when(F.col("id") < 300, F.lit(None)).otherwise(F.col("id")).alias("doc_id"), F.lit("same").alias("text"))
    counts = Counter(r["shard"] for r in ring.shard_documents(hot, 24).collect())
    assert set(counts.values()) <= {37, 38} and len(counts) == 24


def test_same_whatever_the_partitions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert rows_of(queries.op10(spark, SF)) == rows_of(ring.shard_documents(docs.repartition(7), 24))
