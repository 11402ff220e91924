"""Benchmark decontamination against plain window search."""

import hashlib
import random
import re

import numpy as np
from stayline.llm import decontam, queries

from llm_cases import edge_docs, empty_docs

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SF = "/root/testdata/sf0.001"


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(text, items, size=10):
    own, hit, found = words(text), set(), set()
    for name, other in items:
        other = words(other)
        n = min(size, len(other))
        windows = {tuple(other[i:i + n]) for i in range(len(other) - n + 1)} if n else set()
        for i in range(len(own) - n + 1):
            if n and tuple(own[i:i + n]) in windows:
                hit.update(range(i, i + n))
                found.add(name or "")
    return len(own), len(hit), sorted(found), *longest(own, [words(other) for _, other in items], size)


def longest(own, items, size):
    """(words, place) of the first of the longest matches that hold a window."""
    best = (0, None)
    for i in range(len(own)):
        for other in items:
            n = min(size, len(other))
            for j in range(len(other) - n + 1 if n else 0):
                k = 0
                while i + k < len(own) and j + k < len(other) and own[i + k] == other[j + k]:
                    k += 1
                if k >= n and k > best[0]:
                    best = (k, i)
    return best


def made(seed):
    """Texts over few words, so that windows overlap and repeat; items longer and shorter than a window."""
    pick = random.Random(seed)
    text = lambda n: " ".join(pick.choice(["a", "B", "é", "c9", "d-e", "ÿ"]) for _ in range(n))
    items = [(f"i{k}", text(pick.randrange(1, 30))) for k in range(12)] + [("i1", text(14)), (None, text(12)), ("z", ""), ("y", None), ("x", "...")]
    docs = [(k, text(pick.randrange(0, 120))) for k in range(60)]
    docs += [(100 + k, text(5) + " " + (t or "") + " " + text(5)) for k, (_, t) in enumerate(items)]
    return docs + [(200, None), (201, ""), (None, items[0][1])], items


def test_against_plain_search(spark, monkeypatch):
    for block in (decontam.BLOCK_WORDS, 20):
        monkeypatch.setattr(decontam, "BLOCK_WORDS", block)
        rows, items = made(5)
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        bench = spark.createDataFrame(items, "item_id string, text string")
        got = {(r["row"]["doc_id"], r["row"]["text"]): tuple(r["found"]) for r in decontam.searched(docs, bench, 10).collect()}
        for doc_id, text in rows:
            assert got[doc_id, text] == plain(text, items), text


def test_query(spark):
    items = [(str(r["item_id"]), r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op9(spark, SF).collect()
    assert len(rows) == len(texts) and any(r["contaminated"] for r in rows)
    for r in rows:
        if not r["contaminated"] and r["doc_id"] % 10:      # the plain search is slow
            continue
        n, hit, found, most, at = plain(texts[r["doc_id"]], items)
        assert (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"], r["longest"], r["longest_at"]) == (n, hit, len(found), hit > 0, most, -1 if at is None else at)
        assert r["items_sha256"] == hashlib.sha256(",".join(found).encode()).hexdigest()


def test_longest_matches(spark):
    rows, items = made(9)
    docs = spark.createDataFrame([r for r in rows if r[0] is not None], "doc_id long, text string").repartition(2)
    kept = [(n, t) for n, t in items if n not in (None, "i1")]
    got = {(r["item_id"], r["item_start"]): r["n_words"] for r in decontam.longest_matches(docs, spark.createDataFrame(kept, "item_id string, text string")).collect()}
    want = {}
    for name, text in kept:
        own = words(text)
        size = min(10, len(own))
        for i in range(len(own) - size + 1 if own else 0):
            best = 0
            for _, t in rows:
                other = words(t) if t else []
                for j in range(len(other)):
                    k = 0
                    while i + k < len(own) and j + k < len(other) and own[i + k] == other[j + k]:
                        k += 1
                    best = max(best, k)
            if best >= size:
                want[name, i] = best
    assert got == want


def test_long_text_in_parts(monkeypatch):
    text = "Ab, é9 " * 500
    whole = [w for part in decontam.words_of(text) for w in part]
    monkeypatch.setattr(decontam, "PART", 64)
    assert [w for part in decontam.words_of(text) for w in part] == whole == [w.encode() for w in words(text)]


def test_edge_cases(spark):
    bench = spark.createDataFrame([("a", "quick brown fox jumps over the lazy dog and runs"), ("b", None)], "item_id string, text string")
    docs = edge_docs(spark)
    kept = decontam.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    assert kept.count() == docs.count() - 4
    assert decontam.decontaminate(docs, bench.limit(0)).count() == docs.count()
    assert decontam.searched(empty_docs(spark), bench).count() == 0


def test_long_items_take_little_memory():
    pick = random.Random(2)
    text = [f"w{pick.randrange(500)}".encode() for _ in range(30_000)]
    block = decontam.Block([("long", text), ("short", text[7:9])], 10)
    shard = decontam.Shard([b" ".join(text[100:20_000]).decode(), b" ".join(text[5:40]).decode()], block)
    _, names, matches = shard.found(block)
    assert names == [["long"], ["long", "short"]]
    owner, place, n = (np.concatenate(x) for x in zip(*matches))
    assert n[(owner == 0) & (place == 0)].max() == 19_900 and n[(owner == 1) & (place == 0)].max() == 35
    assert max(r[2] for r in shard.longest(block)) == 19_900
