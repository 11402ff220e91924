"""SimHash: fingerprints, tiles and components against brute force."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from stayline.llm import queries, simhash
from stayline.llm.components import connected_components

from llm_cases import edge_docs, empty_docs

SF = "/root/testdata/sf0.001"


def plain_fingerprint(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """Smallest member index of each fingerprint's component, by exhaustive comparison."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 3:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def planted(seed, n):
    """Random fingerprints, chains of near ones, and a dense group."""
    pick = random.Random(seed)
    prints = [pick.getrandbits(64) for _ in range(n)]
    for _ in range(n // 4):
        prints.append(prints[pick.randrange(len(prints))] ^ sum(1 << b for b in pick.sample(range(64), pick.randrange(1, 5))))
    centre = pick.getrandbits(64)
    return list(dict.fromkeys(prints + [centre ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(a)] + [0, 1]))


def test_fingerprints(spark):
    docs = edge_docs(spark)
    got = {(r["doc_id"], r["text"]): r["f"] & (2**64 - 1) for r in docs.select("doc_id", "text", simhash.fingerprints()("text").alias("f")).collect()}
    short = {k: v for k, v in got.items() if len(k[1] or "") < 10_000}
    assert short == {k: plain_fingerprint(k[1]) for k in short}


def test_long_text_in_parts(monkeypatch):
    text = " ".join(str(i % 97) for i in range(1000))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "HASHES", 64)
    assert simhash.fingerprint(text) == whole == plain_fingerprint(text)


@pytest.mark.parametrize("tile", [16, 64])
def test_links_give_the_components(spark, monkeypatch, tile):
    for name, value in (("LEAST_TILE", tile), ("MOST_TILE", tile), ("BLOCK", 8)):
        monkeypatch.setattr(simhash, name, value)
    prints = planted(tile, 300)
    frame = spark.createDataFrame([(int(np.uint64(p).astype(np.int64)),) for p in prints], "fp long")
    found = {r["node"]: r["component"] for r in connected_components(simhash.links(frame, len(prints))).collect()}
    groups = {}
    for p, c in zip(prints, plain_components(prints)):
        signed = int(np.uint64(p).astype(np.int64))
        groups.setdefault(c, set()).add(found.get(signed, signed))
    assert all(len(g) == 1 for g in groups.values())
    assert len(set().union(*groups.values())) == len(groups)


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(200, 230)] + [(7, 7)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 200 for i in [*range(200, 230), 500]}}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_query_against_brute_force(spark):
    docs = sorted(spark.read.parquet(f"{SF}/documents.parquet").collect(), key=lambda r: r["doc_id"])
    prints = [plain_fingerprint(r["text"]) for r in docs]
    want = {(r["doc_id"], f"{p:016x}", docs[c]["doc_id"]) for r, p, c in zip(docs, prints, plain_components(prints))}
    assert {tuple(r) for r in queries.op2(spark, SF).collect()} == want


def test_edge_cases_and_one_row_per_group(spark):
    docs = edge_docs(spark)
    got = simhash.near_duplicates(docs)
    assert got.count() == docs.count()
    zero = got.where("fp = 0").select("component_id").distinct().collect()
    assert [r[0] for r in zero] == [0]
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    classes = got.select("component_id").distinct().count()
    assert kept.count() == classes
    assert kept.where("doc_id = 4").count() == 1 and kept.where("doc_id = 5").count() == 0
    only_nulls = docs.where("doc_id is null")
    assert simhash.near_duplicates(only_nulls).where("component_id is null").count() == 2
    assert simhash.keep_first(only_nulls.unionAll(only_nulls)).count() == 2
    assert simhash.near_duplicates(empty_docs(spark)).count() == 0 and simhash.keep_first(empty_docs(spark)).count() == 0


def test_hot_group(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 1000, F.lit("same words in a third of all rows")).otherwise(F.concat(F.lit("w "), F.sha2(F.col("id").cast("string"), 256), F.lit(" z"))).alias("text"))
    assert simhash.keep_first(docs).count() == 2001
