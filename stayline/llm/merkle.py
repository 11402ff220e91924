"""Merkle manifest of a dataset by sibling-shift self-joins.

Every row is a leaf; the leaves of a source form a tree, and the sources'
roots form the tree of the whole dataset.  A node of arity k knows its place
among its siblings (index modulo k).  At each level the nodes at slot zero
join the same table shifted by 1 .. k - 1: the siblings' indices are computed
(exclusive or with 1 for a binary tree, the slot's offset otherwise), so every
join is an equijoin on (tree, index), and each slot-zero row that comes out
emits the parent.  All trees climb together, a level at a time; a level is a
written table, so a lost executor costs one level at most.

Proofs go down the same tables: a node's path is its siblings followed by its
parent's path.  A parent row holds all its children, so a level costs one
equijoin of its parents, and only the last one yields as many rows as leaves.

Defined cases: null and empty fields differ (``-`` against ``0:``); a null
source is a source of its own, ahead of all others; rows with a null id come
first in their source; rows of equal id lie in the order of their digests, so
repeated rows give equal leaves with a proof each; a text of any length is
digested whole; an empty table gives an empty result; other columns are not
read.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .numbering import numbered
from .scratch import saved

ARITY = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the concatenated parts."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(columns: dict[str, Column]) -> Column:
    return digest(*[field(columns[c]) for c in FIELDS])


def leaves(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """tree (the source as an ordered key), doc_id, leaf, and the leaf of the
    changed text where ``tampered`` holds (else the same)."""
    own = {c: F.col(f"`{c}`") for c in FIELDS}
    found = docs.select(
        F.coalesce(F.concat(F.lit("1"), own["source"].cast("string")), F.lit("0")).alias("tree"), own["doc_id"].alias("doc_id"),
        leaf_of(own).alias("leaf"),
        *([] if tampered is None else [F.when(F.coalesce(tampered, F.lit(False)) & own["text"].contains("\n"),
                                              leaf_of({**own, "text": F.translate(own["text"], "\n", "")})).alias("changed")]))
    return found if tampered is None else found.withColumn("changed", F.coalesce("changed", "leaf"))


def sibling(idx: Column, shift: int, arity: int = ARITY) -> Column:
    """Index of the sibling ``shift`` slots further on."""
    if arity == 2:
        return idx.bitwiseXOR(F.lit(shift))
    return idx - idx % arity + (idx % arity + shift) % arity


def level_up(nodes: DataFrame, arity: int, carried: list[str]) -> DataFrame:
    """(tree, idx, n, h, children) of the parents of ``nodes`` (tree, idx, n, h and
    the columns ``carried`` into the children), for trees of more than one node."""
    kept = F.struct("h", *carried)
    many = nodes.where("n > 1")
    first = many.where(F.col("idx") % arity == 0).select("tree", "idx", "n", kept.alias("c0"))
    for k in range(1, arity):
        # the slot-k rows, under the index of their slot-zero sibling
        other = many.where(F.col("idx") % arity == k).select("tree", sibling(F.col("idx"), arity - k, arity).alias("idx"), kept.alias(f"c{k}"))
        first = first.join(other, ["tree", "idx"], "left")
    children = F.filter(F.array(*[f"c{k}" for k in range(arity)]), lambda c: c.isNotNull())
    return first.select(
        "tree", F.expr(f"idx div {arity}").alias("idx"), F.expr(f"(n + {arity - 1}) div {arity}").alias("n"),
        F.sha2(F.array_join(F.transform(children, lambda c: c["h"]), ""), 256).alias("h"), children.alias("children"))


def climb(nodes: DataFrame, most: int, arity: int, carried: list[str]):
    """Tables of the levels above ``nodes`` (whose largest tree has ``most`` nodes), lowest first."""
    tables = []
    while most > 1:
        nodes, _ = saved(level_up(nodes, arity, carried if not tables else []), "level")
        tables.append(nodes)
        most = -(-most // arity)
    return tables


def roots_of(nodes: DataFrame, tables) -> DataFrame:
    """(tree, h) of the last remaining node of every tree."""
    return reduce(DataFrame.unionAll, [t.where("n = 1").select("tree", "h") for t in [nodes, *tables]])


def descend(tops: DataFrame, nodes: DataFrame, tables, arity: int, carried: list[str]) -> DataFrame:
    """tree, h, the ``carried`` columns and path of every one of ``nodes``.

    ``path`` lists (before, after) from the bottom up: the digests of the
    siblings left and right of the node, of its parent, and so on.  ``tops``
    (tree, path) is what stands above each tree's root."""
    below = None
    for table in reversed(tables):
        opened = table.where("n = 1").join(tops, "tree").select("tree", "idx", "children", "path")
        if below is not None:
            opened = opened.unionAll(table.where("n > 1").join(below.select("tree", "idx", "path"), ["tree", "idx"]).select(*opened.columns))
        each = opened.select("tree", "idx", "path", F.transform("children", lambda c: c["h"]).alias("hs"), F.posexplode("children").alias("slot", "c"))
        joined = lambda first, many: F.array_join(F.slice("hs", first, many), "")
        step = F.struct(joined(F.lit(1), F.col("slot")).alias("before"), joined(F.col("slot") + 2, F.size("hs")).alias("after"))
        below = each.select("tree", (F.col("idx") * arity + F.col("slot")).alias("idx"), "c", F.concat(F.array(step), "path").alias("path"))
        if table is not tables[0]:          # a written table per level keeps each plan small
            below, _ = saved(below.select("tree", "idx", "path"), "paths")
    alone = nodes.where("n = 1").join(tops, "tree").select("tree", "h", *carried, "path")
    return alone if below is None else alone.unionAll(below.select("tree", "c.h", *[f"c.{c}" for c in carried], "path"))


EMPTY_PATH = "array<struct<before:string,after:string>>"


def proofs(found: DataFrame, arity: int = ARITY) -> DataFrame:
    """Columns of ``found`` (``leaves``) with subroot, root and path."""
    own = [c for c in found.columns if c not in ("tree", "leaf")]
    kept, _ = saved(found.withColumnRenamed("leaf", "h"), "leaves")
    nodes, _ = saved(numbered(kept, "tree", ["doc_id", "h"]), "nodes")
    tables = climb(nodes, nodes.agg(F.max("n")).first()[0] or 0, arity, own)
    subroots, _ = saved(roots_of(nodes, tables), "subroots")
    above, _ = saved(numbered(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("of"), "h"), "tree", ["of"]).withColumnRenamed("of", "source_key"), "sources")
    upper = climb(above, above.agg(F.max("n")).first()[0] or 0, arity, ["source_key"])
    root = roots_of(above, upper).select("tree", F.col("h").alias("root"))
    start = root.select("tree", F.array().cast(EMPTY_PATH).alias("path"))
    tops = descend(start, above, upper, arity, ["source_key"]).join(root, "tree").select(
        F.col("source_key").alias("tree"), F.col("h").alias("subroot"), "root", "path")
    tops, _ = saved(tops, "tops")
    below = descend(tops.select("tree", "path"), nodes, tables, arity, own)
    return below.join(tops.drop("path"), "tree").select(*own, F.col("h").alias("leaf"), "subroot", "root", "path")


def proof_digest(path: Column) -> Column:
    """Digest of all siblings of a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def fold(path: Column, leaf: Column) -> Column:
    """The root that ``leaf`` and the siblings of ``path`` give."""
    return F.aggregate(path, leaf, lambda h, s: digest(s["before"], h, s["after"]))


def manifest(docs: DataFrame, tampered: Column | None = None, arity: int = ARITY) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row.

    Where ``tampered`` holds, the line feeds of the text are deleted before the
    row is verified; all other columns belong to the untouched dataset."""
    found = proofs(leaves(docs, F.lit(False) if tampered is None else tampered), arity)
    return found.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
                        fold(F.col("path"), F.col("changed")).alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))
