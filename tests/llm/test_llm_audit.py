"""Source divergence, Merkle manifest and Jaccard join against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayline.llm import divergence, jaccard, merkle, queries
from stayline.llm.numbering import numbered

from conftest import SF0001
from llm_cases import LONG, TEXTS, edge_docs, empty_docs, rows_of


def corpus(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return docs.withColumns({c: F.lit(1) for c in ("row", "tree", "idx", "n", "h", "term", "point", "region", "a", "b", "at", "value")}).repartition(5)


def varied(n=120):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(["Ax", "bee", "çé", "d1e", "die", "x-y", "\n"]) for _ in range(rng.randrange(40))), rng.choice(["en", "de", None]),
             rng.choice(["s0", "s1", "s0", "ü", None, ""]), rng.randrange(9)) for i in range(n)]
    rows += [(i, t, "en", "s0", None) for i, t in enumerate(TEXTS)] + [rows[3], rows[3], (None, None, None, None, None), (None, "x", "fr", "lone", 2), (500, "", "it", "a", 0), (501, None, "it", "b", 0)]
    return rows


# ------------------------------------------------------------ op11 --

def plain_divergence(rows, least=10, top=10):
    count, docs_with = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source, _ in rows:
        words = re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        count[lang or "", source or ""].update(words)
        docs_with[lang or ""].update(set(words))
    out = []
    for lang in {g[0] for g in count}:
        kept = sorted(t for t, n in docs_with[lang].items() if n >= least)
        groups = {s: c for (la, s), c in count.items() if la == lang}
        groups[None] = sum(groups.values(), Counter())
        p = {}
        for s, c in groups.items():
            whole = sum(c[t] for t in kept) + 2 * len(kept)
            p[s] = [1 + 10 ** 9 * (c[t] + 2) // whole for t in kept]
        f = lambda x, y: (x - y) ** 2 // (x + y)
        for s in set(groups) - {None}:
            found = [(sum(map(f, p[s], p[o])), o) for o in groups if o not in (s, None)]
            out += [(lang, s, "pair", o, v, k + 1) for k, (v, o) in enumerate(sorted(found, key=lambda x: (-x[0], x[1].encode())))]
            found = [(f(x, y), t) for x, y, t in zip(p[s], p[None], kept) if groups[s][t] and x > y]
            out += [(lang, s, "term", t, v, k + 1) for k, (v, t) in enumerate(sorted(found, key=lambda x: (-x[0], x[1].encode()))[:top])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("least", [1, 10])
def test_divergence_equals_plain_python(spark, least):
    rows = varied()
    assert rows_of(divergence.divergence(corpus(spark, rows), least)) == plain_divergence(rows, least)


def test_divergence_in_small_blocks_and_pieces(spark, monkeypatch):
    rows = varied() + [(700, LONG + "Zebra" * 50, "en", "s9", 1)]
    monkeypatch.setattr(divergence, "BLOCK", 1)
    monkeypatch.setattr(divergence, "PIECE", 97)
    monkeypatch.setattr(divergence, "HELD", 3)
    assert rows_of(divergence.divergence(corpus(spark, rows), 2)) == plain_divergence(rows, 2)


def test_divergence_of_nothing(spark):
    assert divergence.divergence(corpus(spark, varied()).limit(0)).count() == 0


def test_shares_are_exact_for_huge_counts():
    n, total, terms = np.array([0, 10 ** 12 + 7, 9 * 10 ** 12]), 9 * 10 ** 12 + 10 ** 12 + 7, 2_000_001
    assert divergence.share(n, total, terms).tolist() == [1 + 10 ** 9 * (int(x) + 2) // (total + 2 * terms) for x in n]


def test_gallop_finds_common_ids():
    rng = np.random.default_rng(0)
    for many in (0, 1, 50, 400):
        a, b = (np.unique(rng.integers(0, 500, k)) for k in (many, 60))
        x, y = divergence.gallop(a, b)
        assert a[x].tolist() == b[y].tolist() == np.intersect1d(a, b).tolist()


# ------------------------------------------------------------ op12 --

def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def plain_tree(level, arity):
    """(root, path of every leaf)."""
    paths, place = [[] for _ in level], list(range(len(level)))
    while len(level) > 1:
        for path, i in zip(paths, place):
            first = i - i % arity
            path.append(("".join(level[first:i]), "".join(level[i + 1:first + arity])))
        level = [H(*level[i:i + arity]) for i in range(0, len(level), arity)]
        place = [i // arity for i in place]
    return (level[0] if level else None), paths


def plain_manifest(rows, tampered, arity=3):
    trees = defaultdict(list)
    for doc_id, text, lang, source, n in rows:
        leaf = plain_leaf((doc_id, source, lang, n, text))
        changed = plain_leaf((doc_id, source, lang, n, text.replace("\n", ""))) if text is not None and tampered(doc_id) else leaf
        trees[(source is not None, (source or "").encode())].append((doc_id is not None, doc_id or 0, leaf, changed, doc_id))
    done = []
    for key in sorted(trees):
        own = sorted(trees[key])
        done.append((own, *plain_tree([x[2] for x in own], arity)))
    root, above = plain_tree([d[1] for d in done], arity)
    out = []
    for (own, subroot, paths), top in zip(done, above):
        for (_, _, leaf, changed, doc_id), path in zip(own, paths):
            folded = changed
            for before, after in path + top:
                folded = H(before, folded, after)
            out.append((doc_id, leaf, subroot, root, H(*[b + a for b, a in path + top]), folded, folded == root))
    return sorted(out, key=repr)


@pytest.mark.parametrize("arity", [2, 3, 5])
def test_manifest_equals_plain_python(spark, arity):
    rows = varied(70)
    odd = lambda i: i is not None and zlib.crc32(str(i).encode()) % 2 == 0
    found = merkle.manifest(corpus(spark, rows), F.crc32(F.col("doc_id").cast("string")) % 2 == 0, arity)
    want = plain_manifest(rows, odd, arity)
    assert rows_of(found) == want and {r[6] for r in want} == {True, False}


def test_manifest_of_one_source_one_row_and_nothing(spark):
    docs = corpus(spark, [(7, "a\nb", "en", None, 3)])
    row = merkle.manifest(docs).first()
    assert row["leaf"] == row["subroot"] == row["root"] == row["folded_root"] and row["verified"] and row["proof_sha256"] == H("")
    assert merkle.manifest(docs.limit(0)).count() == 0
    many = [(i, f"t{i}", "en", "one", i) for i in range(28)]
    assert rows_of(merkle.manifest(corpus(spark, many))) == plain_manifest(many, lambda i: False)


def test_siblings_by_exclusive_or_and_by_offsets(spark):
    ids = spark.range(12)
    assert [r[0] for r in ids.select(merkle.sibling(F.col("id"), 1, 2)).collect()] == [i ^ 1 for i in range(12)]
    assert [r[0] for r in ids.select(merkle.sibling(F.col("id"), 2, 3)).collect()] == [i - i % 3 + (i % 3 + 2) % 3 for i in range(12)]


def test_numbers_are_gapless_within_groups(spark):
    rows = spark.range(1000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 7)).alias("g"), F.xxhash64("id").alias("v"))
    got = defaultdict(list)
    for r in numbered(rows, "g", ["v"]).collect():
        got[r["g"]].append((r["idx"], r["v"], r["n"]))
    for own in got.values():
        own.sort()
        assert [x[0] for x in own] == list(range(len(own))) and [x[1] for x in own] == sorted(x[1] for x in own) and {x[2] for x in own} == {len(own)}


# ------------------------------------------------------------ op13 --

def plain_jaccard(rows, percent=80):
    sets = []
    for _, text in rows:
        words = re.split(r"[ \t\n\r\x0b\x0c]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        words = [w for w in words if w]
        sets.append({" ".join(words)} if 0 < len(words) < 5 else {" ".join(words[i:i + 5]) for i in range(len(words) - 4)})
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return sorted(((d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=repr)


def related(seed=3, families=6, each=25):
    """Families of texts at every distance around the threshold, passages that many share, and chains."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(5000)}"
    passage = [word() for _ in range(30)]
    rows = []
    for f in range(families):
        base = [word() for _ in range(rng.choice([12, 40, 90]))]
        for _ in range(each):
            own = list(base)
            for _ in range(rng.randrange(5)):
                own[rng.randrange(len(own))] = word()
            rows.append(" ".join(own))
            base = own if f % 2 else base
    rows += [" ".join(passage + [word() for _ in range(rng.randrange(1, 6))]) for _ in range(each * 2)]
    rows += [" ".join([word() for _ in range(rng.randrange(40))] + passage[:rng.randrange(30)]) for _ in range(each)]
    rows += [rows[0].upper(), rows[0], rows[1].replace(" ", " \n\t "), "a b", "A  b", "a b c", LONG, LONG + " end", *TEXTS]
    return [(i, t) for i, t in enumerate(rows)] + [(0, rows[0]), (None, rows[0]), (None, None), (None, "only null")]


@pytest.mark.parametrize("small, pivots, percent", [(8, 4, 80), (2, 1, 80), (3, 2, 60)])
def test_jaccard_join_equals_all_pairs(spark, monkeypatch, small, pivots, percent):
    monkeypatch.setattr(jaccard, "SMALL", small)
    monkeypatch.setattr(jaccard, "PIVOTS", pivots)
    rows = related()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("point", "n", "at", "shingles", "region", "node", "a", "b", "salt")}).repartition(7)
    assert rows_of(jaccard.near_duplicates(docs, percent=percent)) == plain_jaccard(rows, percent)


def test_jaccard_join_without_shuffled_broadcasts_and_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "FEW", 0)
    monkeypatch.setattr(jaccard, "PIECE", 11)
    monkeypatch.setattr(jaccard, "KNOWN", 3)
    rows = related(families=3, each=10)
    assert rows_of(jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))) == plain_jaccard(rows)


def test_jaccard_join_of_edge_rows_and_nothing(spark):
    docs = edge_docs(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert rows_of(jaccard.near_duplicates(docs)) == plain_jaccard(rows)
    assert jaccard.near_duplicates(empty_docs(spark)).count() == 0


def test_first_windows_hold_a_common_region():
    """Two linked sets always share one of their first pivots."""
    rng = np.random.default_rng(1)
    counts = rng.integers(0, 4, jaccard.CELLS).astype(np.uint32)
    for _ in range(200):
        whole = np.unique(rng.integers(0, 2 ** 63, rng.integers(3, 60)).astype(np.uint64))
        a, b = (np.delete(whole, rng.integers(0, len(whole), rng.integers(0, 1 + len(whole) // 8))) for _ in range(2))
        if 100 * len(np.intersect1d(a, b)) >= 80 * len(np.union1d(a, b)):
            first = []
            for own in (a, b):
                order = np.lexsort((own, counts[own >> np.uint64(46)]))
                first.append(set(own[order][:len(own) - -(-80 * len(own) // 100) + 1].tolist()))
            assert first[0] & first[1]


def test_passages_of_few_texts_stay_out_of_first_windows():
    """120 million shingles (0.5 GB of text), a passage in 20 texts: its shingles count as common."""
    counts = np.random.default_rng(2).poisson(120e6 / jaccard.CELLS, jaccard.CELLS)
    assert np.mean(counts + 20 <= np.quantile(counts, 0.2)) < 0.002


def test_block_counts_come_back():
    for most in (0, 1, 255, 256, 70_000, 2 ** 32 - 1):
        block = np.random.default_rng(most).integers(0, most + 1, jaccard.BLOCK)
        block[7] = most
        assert (jaccard.unpacked(jaccard.packed(block)) == block).all()


def test_linked_sets_share_the_needed_regions(spark):
    """Windows of linked sets share as many regions as ``needed`` says, more than the least number where sizes agree."""
    rng = np.random.default_rng(4)
    seen = []
    for size in np.repeat([2, 8, 24, 30, 99, 110, 400, 900], 40):
        whole = rng.permutation(10 * size)[:size]           # places in the order of shingles
        a, b = (np.sort(rng.permutation(whole)[rng.integers(0, 1 + size // 9):]) for _ in range(2))
        common = len(np.intersect1d(a, b))
        if 100 * common >= 80 * (len(a) + len(b) - common):
            first = [x[:len(x) - -(-80 * len(x) // 100) + jaccard.shared(len(x))] for x in (a, b)]
            seen.append((len(a), len(b), len(np.intersect1d(*first))))
    got = spark.createDataFrame(seen, "n int, other_n int, times int").select("n", "other_n", "times", jaccard.needed("n", "other_n", 80).alias("need")).collect()
    assert len(got) > 50 and all(1 <= r["need"] <= r["times"] for r in got)
    even = spark.createDataFrame([(900, 900), (900, 720)], "n int, other_n int").select(jaccard.needed("n", "other_n", 80).alias("need")).collect()
    assert [r["need"] for r in even] == [88, 8]


def test_pivots_travel_once_and_meet_without_other_members(spark, monkeypatch):
    sent, kept = [], jaccard.saved

    def counted(frame, name):
        out = kept(frame, name)
        if name == "roles":
            sent.append(out[0].count())
        return out

    monkeypatch.setattr(jaccard, "saved", counted)
    texts = [" ".join(f"t{i}w{k}" for k in range(30)) for i in range(5)]
    own = jaccard.texts(spark.createDataFrame(list(enumerate([*texts, texts[0] + " end"])), "doc_id long, text string"), "doc_id", "text")
    rows = jaccard.points(own, 5).where("block is null and point is not null")
    unique = rows.groupBy("point").agg(F.min("doc_id").alias("first")).cache()
    members = unique.select(F.lit(1).cast("long").alias("region"), "point")
    found = jaccard.Texts(own, unique, 5).meet(members, members.withColumnRenamed("point", "pivot"), 80, 1).collect()
    ids = {r["point"]: r["first"] for r in unique.collect()}
    assert {frozenset((ids[r["x"]], ids[r["y"]])) for r in found if r["kind"] == 0} == {frozenset((0, 5))}
    assert sent == [6]


@pytest.mark.parametrize("name", ["op11_divergence", "op12_merkle_manifest", "op13_jaccard_join"])
def test_audit_queries_run(spark, name):
    assert queries.QUERIES[name](spark, SF0001).count() >= 200
