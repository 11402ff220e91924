"""Forests and boosted trees as Spark jobs over one binned table.

* ``Binned`` turns the training rows into bins once: at most 255 per feature
  (every value its own bin, or exact quantiles where there are more), packed in
  blocks of rows with the label, the cross-validation fold and a hash that all
  sampling draws from.  The blocks are a written table in the shared folder;
  every fit of a search reads it instead of the source.
* ``grown`` grows any number of trees at once.  A node of many rows is split by
  sums per (tree, node, feature, bin): each task adds up its blocks, the sums
  are shuffled by tree and node, and one task per node chooses the split.  A
  node whose rows times features fit ``CELLS`` is handed on: its rows are
  shuffled by tree and node, and one task grows everything below it.  No task
  ever holds more than that many cells, and a tree of any depth costs one job
  per level of large nodes and one for all the rest.
* ``boost`` lets all fits of a search go through their rounds together, a job
  per round.  Every row carries the margin of each fit; they are updated once a
  round and written to the shared folder every ``CHECKPOINT`` rounds.  The rows
  a fit leaves out are scored after any round, so a shorter fit costs nothing.
* ``forest`` returns the trees; ``forest_scores`` instead sends the rows a
  fit leaves out along with the others, reads them off every subtree where it
  grew -- at several depth limits and ``min_samples_split`` at once, since a
  node does not depend on what lies below it -- and adds up the values per
  number of trees.  No model travels.

Rows of at most ``WHOLE`` times ``CELLS`` cells are not shuffled per tree or round:
``dealt`` hands the fits (or runs of ``CHUNK`` trees) out to tasks, each of which reads
the blocks once and grows its own share; a boosted fit goes through all its rounds
there.  What is shuffled is the blocks once per task and the scores.

Results do not depend on the cluster: blocks follow from the row count and the
keys, sampling is by hash, and sums are taken in the order of the blocks.
"""

from __future__ import annotations

import math
import os
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ...session import ensure_checkpoint_dir, scratch_path, written
from ..features import FEATURES, LABEL, WEIGHT
from ..stats import quantiles
from .trees import MISSING, MOST_BINS, NODE, Layout, Rule, Tree, bootstrap, grow, grow_laid, leaves_of, mixed, rebased, split_sums, uniform

FOLD = "__fold"
CELLS = 1 << 20             # rows x features of a node that one task grows
LEAST_ROWS = 1024           # rows of such a node, however many features there are
WHOLE = 8                   # times CELLS: rows x features of a table that a task reads whole, a byte each
CHUNK = 25                  # trees of a forest that one task grows after another
REST_ROWS = 1 << 16         # scores of one fit that travel together
BLOCK_ROWS = 1 << 13        # rows of a block
SMALL_ROWS, FEW_PARTITIONS, LARGE_ROWS = 2_000, 16, 1_000_000     # partitions of the blocks
SUMS_BYTES = 1 << 26        # sums that a task sends per job
BUNCH_BYTES = 1 << 24       # blocks that a task works on together
TOGETHER = (1 << 12, 1 << 10)       # combinations of bins counted at once, as memory allows
PACK = 26                   # bits of a row count that shares a number with whole weights
HELD_BYTES = 1 << 26        # scores that a task holds before it hands them on
CHECKPOINT = 10             # rounds between written margins
NO_FOLD = -1
MODEL_NODES = 20_000_000    # nodes of a boosted model that is collected and broadcast
FOREST_NODES = 500_000      # of a forest; a larger one stays a table

BLOCKS = "block long, y binary, u binary, fold binary, bins binary, margins binary"


def feature_cuts(rows: DataFrame, p: int, max_bins: int) -> list[np.ndarray]:
    """Per feature the ascending bounds between its bins."""
    max_bins = max(2, min(max_bins, MOST_BINS))
    cell = F.posexplode("x").alias("c", "v")
    counted = rows.select(cell).where(F.col("v").isNotNull() & ~F.isnan("v")).groupBy("c", "v").agg(F.count(F.lit(1)).alias("n")).persist(StorageLevel.MEMORY_AND_DISK)
    distinct = {r["c"]: r["n"] for r in counted.groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect()}
    few = [c for c, n in distinct.items() if n <= max_bins]
    many = [c for c, n in distinct.items() if n > max_bins]
    cuts = [np.empty(0)] * p
    held = {}
    for r in counted.where(F.col("c").isin(few)).select("c", "v").collect() if few else []:         # at most max_bins per feature
        held.setdefault(r["c"], []).append(r["v"])
    for c, values in held.items():
        values = np.sort(np.array(values))
        cuts[c] = (values[1:] + values[:-1]) / 2
    counted.unpersist()
    if many:
        own = rows.select(*[F.get("x", F.lit(c)).alias(f"f{c}") for c in many])
        found = quantiles(own, [f"f{c}" for c in many], [k / max_bins for k in range(1, max_bins)])
        for c in many:
            cuts[c] = np.unique(found[f"f{c}"])
    return cuts


def to_bins(x, cuts):
    """Bins of a rows x features array."""
    out = np.empty(x.shape, np.uint8)
    for j, bounds in enumerate(cuts):
        out[:, j] = np.where(np.isnan(x[:, j]), MISSING, np.searchsorted(bounds, x[:, j], side="left"))
    return out


def stacked(column) -> np.ndarray:
    """Rows x features of an Arrow list column; NULL becomes NaN."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


class Binned:
    """Binned, fold-tagged training rows: a table of blocks and its numbers."""

    def __init__(self, train: DataFrame, max_bins: int = MOST_BINS):
        spark = train.sparkSession
        ensure_checkpoint_dir(spark)
        keys = [F.col(f"`{c}`") for c in train.columns if c not in (FEATURES, LABEL, WEIGHT, FOLD)]
        x = vector_to_array(F.col(FEATURES))
        fold = F.col(FOLD).cast("int") if FOLD in train.columns else F.lit(0)
        rows = train.select(F.xxhash64(*keys, F.col(LABEL), x).alias("u"), F.col(LABEL).cast("double").alias("y"), fold.alias("fold"), x.alias("x"))
        rows = written(rows, "rows")        # bounds, numbers and blocks are passes over this table
        first = rows.select(F.size("x").alias("p")).first()
        if first is None:
            raise ValueError("no training rows")
        self.spark, self.p = spark, first["p"]
        self.cuts = feature_cuts(rows, self.p, max_bins)
        y = F.col("y")
        found = rows.agg(F.count(F.lit(1)).alias("n"), F.min(y).alias("low"), F.max(F.abs(y * (1 - y))).alias("odd")).first()
        self.n, self.low, self.binary = found["n"], found["low"], found["odd"] == 0
        self.offsets = np.concatenate([[0], np.cumsum([len(c) + 2 for c in self.cuts])])      # one more place for missing values
        parts = max(min(FEW_PARTITIONS, -(-self.n // SMALL_ROWS)), -(-self.n // LARGE_ROWS), 1)
        cuts = self.cuts

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            number, last, again = TaskContext.get().partitionId() << 32, None, 0
            for batch in batches:
                u, bins = batch.column(0).to_numpy().view(np.uint64), to_bins(stacked(batch.column(3)), cuts)
                rank = np.zeros(len(u), np.uint64)          # rows of one hash are told apart by their order
                same = np.flatnonzero(np.concatenate([[last is not None and len(u) and u[0] == last], u[1:] == u[:-1]]))
                for i in same.tolist():
                    rank[i] = rank[i - 1] + np.uint64(1) if i else np.uint64(again + 1)
                if len(u):
                    last, again = u[-1], int(rank[-1])
                u = np.where(rank > 0, mixed(u ^ mixed(rank)), u)
                y, fold = batch.column(1).to_numpy(), batch.column(2).to_numpy().astype(np.int16)
                for a in range(0, len(u), BLOCK_ROWS):
                    cut = slice(a, a + BLOCK_ROWS)
                    yield pa.RecordBatch.from_pydict({"block": pa.array([number], pa.int64()), **{k: pa.array([np.ascontiguousarray(v[cut]).tobytes()], pa.binary()) for k, v in (("y", y), ("u", u), ("fold", fold), ("bins", bins))},
                                                      "margins": pa.array([None], pa.binary())})
                    number += 1

        self.path = scratch_path(spark, "binned")
        placed = rows.repartition(parts, "u").sortWithinPartitions("u", "y", "x")
        placed.mapInArrow(pack, BLOCKS).write.parquet(self.path)
        self.blocks = spark.read.schema(BLOCKS).parquet(self.path).repartition(parts, "block").sortWithinPartitions("block").persist(StorageLevel.MEMORY_AND_DISK)

        def per_fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    block = Block(batch, i, self_p)
                    folds = np.unique(block.fold)
                    yield pa.RecordBatch.from_arrays([pa.array(folds.astype(np.int32)), pa.array([int((block.fold == f).sum()) for f in folds], pa.int64()),
                                                      pa.array([float(block.y[block.fold == f].sum()) for f in folds])], ["fold", "n", "s"])

        self_p, own = self.p, {}
        for r in self.blocks.mapInArrow(per_fold, "fold int, n long, s double").collect():      # a few numbers per block
            own.setdefault(r["fold"], []).append((r["n"], r["s"]))
        self.folds = {f: (sum(n for n, _ in v), math.fsum(s for _, s in v)) for f, v in own.items()}

    def totals(self, out: int = NO_FOLD) -> tuple[int, float]:
        """(rows, sum of labels) outside fold ``out``."""
        kept = [v for f, v in sorted(self.folds.items()) if f != out]
        return sum(n for n, _ in kept), math.fsum(s for _, s in kept)

    @property
    def is_whole(self) -> bool:
        """Whether a task may read all rows."""
        return self.n * self.p <= WHOLE * CELLS

    def release(self) -> None:
        self.blocks.unpersist()


class Block:
    """One block, unpacked."""

    def __init__(self, batch, i, p):
        raw = lambda k, kind: np.frombuffer(batch.column(k)[i].as_buffer(), kind)
        self.number = batch.column(0)[i].as_py()
        self.y, self.u, self.fold, self.bins = raw(1, "<f8"), raw(2, "<u8"), raw(3, "<i2"), raw(4, "u1").reshape(-1, p)
        self.margins = raw(5, "<f8").reshape(-1, len(self.y)) if batch.column(5)[i].is_valid else None
        self.kept = {}

    def once(self, key, make):
        if key not in self.kept:
            self.kept = {k: v for k, v in self.kept.items() if k[0] != key[0]}      # one of each kind
            self.kept[key] = make()
        return self.kept[key]


class Bunch(Block):
    """Some blocks in a row, as one; its number is that of the first."""

    def __init__(self, blocks):
        self.number, self.kept = blocks[0].number, {}
        self.y, self.u, self.fold, self.bins = (np.concatenate([getattr(b, k) for b in blocks]) for k in ("y", "u", "fold", "bins"))
        self.margins = None if blocks[0].margins is None else np.concatenate([b.margins for b in blocks], axis=1)


def bunches(batches: Iterator[pa.RecordBatch], p: int) -> Iterator[Bunch]:
    held, size = [], 0
    for batch in batches:
        for i in range(batch.num_rows):
            block = Block(batch, i, p)
            held.append(block)
            size += len(block.y) * (p + 24 + (0 if block.margins is None else 8 * len(block.margins)))
            if size >= BUNCH_BYTES:
                yield Bunch(held)
                held, size = [], 0
    if held:
        yield Bunch(held)


def combined(sizes, most: int) -> list[list[int]]:
    """Groups of features whose places have at most ``most`` combinations."""
    groups = []
    for j in sorted(range(len(sizes)), key=lambda j: -sizes[j]):
        for g in groups:
            if g[0] * sizes[j] <= most:
                g[0], g[1] = g[0] * sizes[j], g[1] + [j]
                break
        else:
            groups.append([sizes[j], [j]])
    return [g[1] for g in groups]


@dataclass
class Fit:
    """One ensemble to grow: its rule, the fold it leaves out, and its sampling."""

    rule: Rule
    size: int                               # rounds or trees
    out: int = NO_FOLD
    objective: str = "squared"              # of boosting: squared or poisson
    subsample: float = 1.0
    colsample: float = 1.0
    seed: int = 42
    balance: str | None = None              # of a forest: balanced or balanced_subsample
    base: float = 0.0
    classes: tuple = (1.0, 1.0)


def balanced(positives, negatives):
    """Class weights n / (2 n_c); an empty class weighs 1."""
    n = positives + negatives
    return tuple(float(n / (2 * k)) if k > 0 else 1.0 for k in (positives, negatives))


class BoostRows:
    """Rows of boosting tree ``t``: the fit of that number in one round."""

    def __init__(self, fits, number, p):
        self.fits, self.round, self.known = fits, number, {}
        self.masks = {}
        for f in fits:
            if (f.seed, f.colsample) not in self.masks:
                many = max(1, int(f.colsample * p + 1e-9))
                draw = np.random.default_rng([f.seed, number]).choice(p, many, replace=False) if many < p else np.arange(p)
                self.masks[f.seed, f.colsample] = np.sort(draw)

    def fit(self, t):
        return self.fits[t]

    def columns(self, t):
        return self.masks[self.fits[t].seed, self.fits[t].colsample]

    def seed(self, t):
        return self.fits[t].seed + 7919 * self.round

    def drawn(self, t, u):
        return uniform(u, self.fits[t].seed * 1_000_003 + self.round)

    def of(self, block, t):
        f = self.fits[t]
        draw = block.once(("draw", f.seed), lambda: self.drawn(t, block.u)) if f.subsample < 1 else None
        rows = np.flatnonzero((block.fold != f.out) if draw is None else (block.fold != f.out) & (draw < f.subsample))
        margin, y = block.margins[t][rows], block.y[rows]
        if f.objective == "squared":
            return rows, margin - y, np.ones(len(rows))
        mu = np.exp(margin)
        return rows, mu - y, mu


class ForestRows:
    """Rows of forest tree ``t``: tree ``t // fits`` of fit ``t % fits``."""

    def __init__(self, fits):
        self.fits, self.known = fits, {}

    def fit(self, t):
        return self.fits[t % len(self.fits)]

    def tree(self, t):
        return t // len(self.fits)

    def columns(self, t):
        return None

    def seed(self, t):
        return self.fit(t).seed * 1_000_003 + self.tree(t)

    def of(self, block, t):
        f = self.fit(t)
        weight = block.once(("weight", self.seed(t)), lambda: bootstrap(block.u, self.seed(t)))
        rows = np.flatnonzero((weight > 0) & (block.fold != f.out))
        w, y = weight[rows], block.y[rows]
        return (rows, w * y, w) if f.rule.kind == "mean" else (rows, w * y, w * (1 - y))


def classes_of(source, t, a, b):
    """Class weights of tree ``t`` whose root has the sums ``a`` and ``b``."""
    f = source.fit(t)
    return balanced(a, b) if f.balance == "balanced_subsample" else f.classes


def keyed(batches, columns):
    """(t, node, rows of the batches) of consecutive rows with one key."""
    key, held = None, []
    for batch in batches:
        for i in range(batch.num_rows):
            own = (batch.column(0)[i].as_py(), batch.column(1)[i].as_py())
            if own != key and held:
                yield key, held
                held = []
            key = own
            held.append([batch.column(c)[i] for c in columns])
    if held:
        yield key, held


def raw(scalar, kind):
    return np.frombuffer(scalar.as_buffer(), kind)


def dealt_out(slot, many):
    """The rows of each of ``many`` slots, in their order."""
    order = np.argsort(slot.astype(np.uint16) if many < 1 << 16 else slot, kind="stable")
    return np.split(order, np.searchsorted(slot.take(order), np.arange(1, many + 1)))[:many]


class Growth:
    """The nodes of many trees, some grown from sums, the rest below ``small``."""

    def __init__(self, binned: Binned, source, sizes: dict[int, int]):
        self.binned, self.source = binned, source
        self.limit = max(LEAST_ROWS, CELLS // binned.p)
        self.nodes = {t: [] for t in sizes}
        self.small = {t: [1] for t, n in sizes.items() if n <= self.limit}
        self.large = {t: [1] for t, n in sizes.items() if n > self.limit}
        self.ended = {}                         # large nodes that do not split
        self.classes = {}

    def partial(self, t):
        """The grown top of a tree; unsplit nodes stand as leaves."""
        if not self.nodes[t]:
            return None
        top = np.concatenate(self.nodes[t])
        split = top[top["feature"] >= 0]
        ends = np.setdiff1d(np.concatenate([2 * split["id"], 2 * split["id"] + 1, [1]]), top["id"])
        rest = np.zeros(len(ends), NODE)
        rest["id"], rest["feature"] = ends, -1
        return Tree(np.concatenate([top, rest]), Rule("mean"))

    def levels(self, blocks: DataFrame) -> None:
        """Split all large nodes, a level at a time, by sums over the blocks."""
        places = int(self.binned.offsets[-1])
        batch = max(1, SUMS_BYTES // (24 * places))
        while self.large:
            todo = [(t, node) for t in sorted(self.large) for node in self.large[t]]
            found = []
            for a in range(0, len(todo), batch):
                found += self.split_nodes(blocks, todo[a:a + batch])
            self.large = {}
            for t, node, left in found:
                if node["id"][0] == 1:
                    self.classes[t] = classes_of(self.source, t, node["a"][0], node["b"][0])
                self.nodes[t].append(node)
                if node["feature"][0] >= 0:
                    rest = tuple(node[k][0] - v for k, v in zip(("n", "a", "b"), left))
                    for child, (n, a, b) in ((2 * int(node["id"][0]), left), (2 * int(node["id"][0]) + 1, rest)):
                        if n > self.limit and child.bit_length() > self.source.fit(t).rule.max_depth:      # a leaf: its sums are known
                            self.nodes[t].append(leaves_of([child], n, a, b))
                            self.ended.setdefault(t, []).append(child)
                        else:
                            (self.large if n > self.limit else self.small).setdefault(t, []).append(child)
                else:
                    self.ended.setdefault(t, []).append(int(node["id"][0]))

    def above(self, depths) -> dict:
        """{(t, node): {k: value}} where depth limit k ends at an ancestor of a small
        or unsplit node (or at the unsplit node itself)."""
        out = {}
        for t, parts in self.nodes.items():
            known = {int(n["id"][0]): n for n in parts}
            for node in [*self.small.get(t, []), *self.ended.get(t, [])]:
                for k, depth in enumerate(depths):
                    at = node >> max(0, node.bit_length() - 1 - depth)
                    if at != node or node in known:
                        own = known[at]
                        out.setdefault((t, node), {})[k] = float(self.source.fit(t).rule.value(own["a"][0], own["b"][0], self.classes.get(t, (1.0, 1.0))))
        return out

    def split_nodes(self, blocks, todo):
        p, offsets, source, classes = self.binned.p, self.binned.offsets, self.source, self.classes
        wanted = {}
        for t, node in todo:
            wanted.setdefault(t, []).append(node)
        tops = {t: self.partial(t) for t in wanted}
        wanted = {t: np.sort(np.array(nodes, np.int64)) for t, nodes in wanted.items()}
        places = int(offsets[-1])

        sizes = np.diff(offsets).tolist()
        fits_in = lambda groups: 24 * len(todo) * sum(math.prod(sizes[j] for j in g) for g in groups) <= SUMS_BYTES
        groups = next((g for g in (combined(sizes, most) for most in TOGETHER) if fits_in(g)), [[j] for j in range(p)])
        rank = np.tile(np.arange(256), (p, 1))
        rank[:, MISSING] = np.array(sizes) - 1
        cells = [math.prod(sizes[j] for j in g) for g in groups]

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = {}
            for block in bunches(batches, p):
                codes = []
                for g in groups:
                    code = np.zeros(len(block.y), np.int64)
                    for j in g:
                        code *= sizes[j]
                        code += rank[j].take(block.bins[:, j])
                    codes.append(code)
                for t, nodes in wanted.items():
                    f = source.fit(t)
                    rows, a, b = source.of(block, t)
                    slot = None
                    if tops[t] is not None:
                        slot_of = np.searchsorted(nodes, tops[t].ids)
                        slot_of[slot_of == len(nodes)] = 0
                        slot_of = np.where(nodes[slot_of] == tops[t].ids, slot_of, -1)
                        slot = slot_of.take(tops[t].leaves(block.bins.take(rows, axis=0)))
                        here = slot >= 0
                        if not here.all():
                            rows, a, b, slot = rows.compress(here), a.compress(here), b.compress(here), slot.compress(here)
                    # one column of numbers less: a hessian of 1 is the count, whole weights share its number
                    unit, whole = f.rule.kind == "newton" and f.objective == "squared", f.rule.kind != "newton"
                    weights = [None, a] if unit else [1.0 + b * (1 << PACK), a] if whole else [None, a, b]
                    for g, (code, size) in enumerate(zip(codes, cells)):
                        flat = code.take(rows)
                        if slot is not None:
                            flat += slot * size
                        own = [np.bincount(flat, w, len(nodes) * size).astype(float, copy=False) for w in weights]
                        if (t, g) in total:
                            for x, y in zip(total[t, g], own):
                                x += y
                        else:
                            total[t, g] = own
            part = TaskContext.get().partitionId()
            for t, nodes in wanted.items() if total else ():
                f, out = source.fit(t), np.zeros((3, len(nodes), places))
                for g, features in enumerate(groups):
                    for d, j in enumerate(features):
                        shape = (len(nodes), *[sizes[k] for k in features])
                        others = tuple(k + 1 for k in range(len(features)) if k != d)
                        each = [v.reshape(shape).sum(axis=others) if others else v.reshape(shape) for v in total[t, g]]
                        if f.rule.kind != "newton":
                            packed = each[0].astype(np.int64)
                            each = [packed & ((1 << PACK) - 1), each[1], packed >> PACK]
                        elif f.objective == "squared":
                            each.append(each[0])
                        for v, into in zip(each, out):
                            into[:, offsets[j]:offsets[j + 1]] = v
                for k, node in enumerate(nodes.tolist()):
                    yield pa.RecordBatch.from_pydict({"t": pa.array([t], pa.int32()), "node": pa.array([node], pa.int64()), "part": pa.array([part], pa.int64()), "sums": pa.array([np.ascontiguousarray(out[:, k]).tobytes()], pa.binary())})

        def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for (t, node), held in keyed(batches, [3]):
                n, a, b = sum(raw(x[0], "<f8").reshape(3, -1) for x in held)
                f = source.fit(t)
                columns = source.columns(t)
                columns = np.arange(p) if columns is None else columns
                first = slice(offsets[0], offsets[1])
                own = classes.get(t) or classes_of(source, t, a[first].sum(), b[first].sum())
                found, left = split_sums(n.astype(np.int64), a, b, offsets, f.rule, columns, own, source.seed(t), node)
                yield pa.RecordBatch.from_pydict({"t": pa.array([t], pa.int32()), "found": pa.array([found.tobytes()], pa.binary()), "left": pa.array([left[0]], pa.int64()),
                                                  "left_a": pa.array([left[1]]), "left_b": pa.array([left[2]])})

        cores = blocks.sparkSession.sparkContext.defaultParallelism
        shuffled = blocks.mapInArrow(sums, "t int, node long, part long, sums binary").repartition(min(len(todo), 3 * cores), "t", "node").sortWithinPartitions("t", "node", "part")
        rows = shuffled.mapInArrow(choose, "t int, found binary, left long, left_a double, left_b double").collect()       # one per node
        return [(r["t"], np.frombuffer(r["found"], NODE), (r["left"], r["left_a"], r["left_b"])) for r in sorted(rows, key=lambda r: (r["t"], np.frombuffer(r["found"], NODE)["id"][0]))]

    def handed(self, blocks: DataFrame, with_rest: bool = False) -> DataFrame | None:
        """The rows of all small nodes, together by tree and node: t, node, block,
        bins, a, b, and of the rows that the fit leaves out y, their places and bins."""
        p, source, ended = self.binned.p, self.source, self.ended if with_rest else {}
        small = {t: self.small.get(t, []) + ended.get(t, []) for t in sorted({*self.small, *ended})}
        if not small:
            return None
        tops = {t: self.partial(t) for t in small}

        def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names = ["t", "node", "block", "bins", "a", "b", "rest_y", "rest_at", "rest_bins"]
            out, size = [], 0

            def sent():
                return pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int32()), pa.array([r[1] for r in out], pa.int64()), pa.array([r[2] for r in out], pa.int64())]
                                                  + [pa.array([r[k] for r in out], pa.binary()) for k in range(3, 9)], names)

            for block in bunches(batches, p):
                for t, nodes in small.items():
                    rows, a, b = source.of(block, t)
                    rest = np.flatnonzero(block.fold == source.fit(t).out) if with_rest else np.empty(0, np.int64)
                    whole, top = nodes == [1], tops[t]
                    own, others = block.bins.take(rows, axis=0), block.bins.take(rest, axis=0)
                    if whole:
                        parts, rest_parts = [np.arange(len(rows))], [np.arange(len(rest))]
                    else:
                        slot_of = np.full(len(top.ids), len(nodes), np.int32)
                        slot_of[np.searchsorted(top.ids, nodes)] = np.arange(len(nodes))
                        parts, rest_parts = (dealt_out(slot_of.take(top.leaves(x)), len(nodes)) for x in (own, others))
                    count = np.array([len(rest)], "<i4").tobytes()
                    for node, here, there in zip(nodes, parts, rest_parts):
                        if node in ended.get(t, ()):
                            here = here[:0]
                        if len(here) or len(there):
                            out.append((t, node, block.number, own.take(here, axis=0).tobytes(), a.take(here).tobytes(), b.take(here).tobytes(),
                                        block.y.take(rest.take(there)).tobytes(), there.astype("<i4").tobytes() + count, others.take(there, axis=0).tobytes()))
                            size += len(here) * (p + 16) + len(there) * (p + 12)
                    if size > 1 << 22:
                        yield sent()
                        out, size = [], 0
            if out:
                yield sent()

        cores = blocks.sparkSession.sparkContext.defaultParallelism
        many = sum(map(len, small.values()))
        schema = "t int, node long, block long, bins binary, a binary, b binary, rest_y binary, rest_at binary, rest_bins binary"
        return blocks.mapInArrow(pieces, schema).repartition(max(1, min(many, 4 * cores)), "t", "node").sortWithinPartitions("t", "node", "block")

    def subtree(self):
        """Function of a key and its rows (bins, a, b) that grows the subtree."""
        p, source, classes = self.binned.p, self.source, self.classes

        def make(t, node, held):
            bins = np.concatenate([raw(x[0], "u1") for x in held]).reshape(-1, p)
            a, b = (np.concatenate([raw(x[k], "<f8") for x in held]) for k in (1, 2))
            columns = source.columns(t)
            own = classes.get(t) or classes_of(source, t, a.sum(), b.sum())
            if not len(a):
                empty = np.zeros(1, NODE)
                empty["id"], empty["feature"] = node, -1
                return empty, own
            return grow(bins, a, b, source.fit(t).rule, np.arange(p) if columns is None else columns, own, source.seed(t), node), own

        return make

    def finished(self, blocks: DataFrame) -> dict[int, Tree]:
        """All trees, collected: their size is the model's."""
        self.levels(blocks)
        make = self.subtree()

        def below(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for (t, node), held in keyed(batches, [3, 4, 5]):
                nodes, own = make(t, node, held)
                yield pa.RecordBatch.from_pydict({"t": pa.array([t], pa.int32()), "nodes": pa.array([nodes.tobytes()], pa.binary()), "own": pa.array([list(own)], pa.list_(pa.float64()))})

        rows, held = self.handed(blocks), 0
        for r in rows.mapInArrow(below, "t int, nodes binary, own array<double>").collect() if rows is not None else []:
            self.nodes[r["t"]].append(np.frombuffer(r["nodes"], NODE))
            self.classes[r["t"]] = tuple(r["own"])
            held += len(self.nodes[r["t"]][-1])
            if held > MODEL_NODES:
                raise ValueError(f"the model has more than {MODEL_NODES} nodes: limit max_depth")
        empty = np.zeros(1, NODE)
        empty["id"], empty["feature"] = 1, -1
        return {t: Tree(np.concatenate(parts) if parts else empty, self.source.fit(t).rule, self.classes.get(t, (1.0, 1.0))) for t, parts in self.nodes.items()}


    def written(self, blocks: DataFrame) -> "ForestTable":
        """All trees as a table, a row per subtree; only their tops are collected."""
        self.levels(blocks)
        make, source = self.subtree(), self.source

        def below(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for (t, node), held in keyed(batches, [3, 4, 5]):
                nodes, own = make(t, node, held)
                yield subtree_row(t, node, Tree(nodes, source.fit(t).rule, own))

        spark, path = blocks.sparkSession, scratch_path(blocks.sparkSession, "forest")
        rows, fixed = self.handed(blocks), []
        for t, ends in self.ended.items():
            known = {int(n["id"][0]): n for n in self.nodes[t]}
            for node in ends:
                leaf = known[node].copy()
                leaf["id"] = 1
                fixed.append(tuple(c[0].as_py() for c in subtree_row(t, node, Tree(leaf, source.fit(t).rule, self.classes.get(t, (1.0, 1.0)))).columns))
        if rows is not None:
            rows.mapInArrow(below, SUBTREES).write.parquet(path)
        if fixed:
            spark.createDataFrame(fixed, SUBTREES).coalesce(1).write.mode("append").parquet(path)
        return ForestTable(path, {t: self.partial(t) for t in self.nodes})


# ------------------------------------------------------- forests as tables --

SUBTREES = "t int, node long, many int, feature binary, bound binary, left_missing binary, child binary, value binary"


def subtree_row(t, node, tree):
    parts = (tree.feature.astype("<i4"), tree.bound.astype("<i4"), tree.left_missing.astype("?"), tree.left.astype("<i4"), tree.value.astype("<f8"))
    return pa.RecordBatch.from_arrays([pa.array([t], pa.int32()), pa.array([node], pa.int64()), pa.array([len(parts[0])], pa.int32())] + [pa.array([v.tobytes()], pa.binary()) for v in parts],
                                      ["t", "node", "many", "feature", "bound", "left_missing", "child", "value"])


def bare_tree(feature, bound, left_missing, left, value):
    tree = Tree.__new__(Tree)
    tree.feature, tree.bound, tree.left_missing, tree.left, tree.value = feature, bound, left_missing, left, value
    return tree


@dataclass
class ForestTable:
    """A forest as a written table of subtrees.

    Rows to score are packed in blocks; each tree's top, which every task holds,
    tells the subtree a row belongs to.  Rows and subtrees are shuffled together,
    so no task holds the forest, and the values come back to their blocks, where
    they are added in the order of the trees."""

    path: str
    tops: dict                              # {t: its split large nodes, or None}

    def table(self) -> DataFrame:
        return _session().read.schema(SUBTREES).parquet(self.path)

    def nodes(self) -> int:
        return self.table().agg(F.sum("many")).first()[0] or 0

    def trees(self) -> list[Tree]:
        """All trees, collected: for a small forest."""
        parts = {t: {} for t in self.tops}
        for r in self.table().collect():
            parts[r["t"]][r["node"]] = bare_tree(*(np.frombuffer(r[c], k) for c, k in (("feature", "<i4"), ("bound", "<i4"), ("left_missing", "?"), ("child", "<i4"), ("value", "<f8"))))
        out = []
        for t, top in sorted(self.tops.items()):
            if top is None:
                out.append(parts[t][1])
                continue
            # the top's unsplit nodes become the roots of their subtrees
            own_parts = [parts[t][int(i)] for i in top.ids[top.feature < 0]]
            feature, left, value, at = top.feature.copy(), top.left.copy(), np.zeros(len(top.ids)), len(top.ids)
            bound, missing = top.bound.copy(), top.left_missing.copy()
            feats, bounds, sides, lefts, values = [feature], [bound], [missing], [left], [value]
            for k, own in zip(np.flatnonzero(top.feature < 0), own_parts):
                # the root moves into the top's place, the rest follows behind
                feature[k], bound[k], missing[k], value[k] = own.feature[0], own.bound[0], own.left_missing[0], own.value[0]
                left[k] = own.left[0] - 1 + at
                feats.append(own.feature[1:]), bounds.append(own.bound[1:]), sides.append(own.left_missing[1:])
                lefts.append((own.left[1:] - 1 + at).astype(np.int32)), values.append(own.value[1:])
                at += len(own.feature) - 1
            out.append(bare_tree(*(np.concatenate(v) for v in (feats, bounds, sides, lefts, values))))
        return out

    def scored(self, df: DataFrame, cuts: list, features: str = FEATURES) -> DataFrame:
        """The columns of ``df`` but the features, and the mean value of the trees as ``score``."""
        if df.isStreaming:
            raise ValueError("a forest of this size scores the batches of a stream: use foreachBatch")
        spark, tops, p = df.sparkSession, self.tops, len(cuts)
        kept = [c for c in df.columns if c != features]
        rows = df.select(*[F.col(f"`{c}`") for c in kept], vector_to_array(F.col(features)).alias("__x"))

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            number = TaskContext.get().partitionId() << 32
            for batch in batches:
                for a in range(0, batch.num_rows, BLOCK_ROWS):
                    own = batch.slice(a, BLOCK_ROWS)
                    sink = pa.BufferOutputStream()
                    bare = pa.RecordBatch.from_arrays(own.columns[:-1], schema=pa.schema(list(own.schema)[:-1]))
                    with pa.ipc.new_stream(sink, bare.schema) as out:
                        out.write_batch(bare)
                    yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary()), pa.array([to_bins(stacked(own.columns[-1]), cuts).tobytes()], pa.binary())], ["block", "held", "bins"])
                    number += 1

        blocks = written(rows.mapInArrow(pack, "block long, held binary, bins binary"), "scored")
        many = len(tops)

        def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    number, bins, out, size = batch.column(0)[i].as_py(), raw(batch.column(1)[i], "u1").reshape(-1, p), [], 0
                    for t, top in tops.items():
                        at = np.zeros(len(bins), np.int64) if top is None else top.leaves(bins)
                        order = np.argsort(at, kind="stable")
                        for own in np.split(order, np.flatnonzero(np.diff(at[order])) + 1):
                            out.append((t, 1 if top is None else int(top.ids[at[own[0]]]), number, own.astype("<i4").tobytes(), bins[own].tobytes()))
                            size += len(own) * (p + 4) + 40
                        if size > 1 << 22:
                            yield sent(out)
                            out, size = [], 0
                    if out:
                        yield sent(out)

        def sent(out):
            none = [pa.nulls(len(out), pa.binary())] * 5
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int32()), pa.array([r[1] for r in out], pa.int64()), pa.array([r[2] for r in out], pa.int64()), pa.array([r[3] for r in out], pa.binary()),
                                               pa.array([r[4] for r in out], pa.binary()), *none], names)

        names = ["t", "node", "block", "at", "bins", "feature", "bound", "left_missing", "child", "value"]
        schema = "t int, node long, block long, at binary, bins binary, feature binary, bound binary, left_missing binary, child binary, value binary"

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tree = None
            for batch in batches:
                found = []
                for i in range(batch.num_rows):
                    if batch.column(2)[i].as_py() < 0:      # a subtree comes before its rows
                        tree = bare_tree(*(raw(batch.column(5 + k)[i], kind) for k, kind in enumerate(("<i4", "<i4", "?", "<i4", "<f8"))))
                        continue
                    leaves = tree.leaves(raw(batch.column(4)[i], "u1").reshape(-1, p))
                    found.append((batch.column(2)[i].as_py(), batch.column(0)[i].as_py(), batch.column(3)[i].as_py(), tree.value[leaves].tobytes()))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in found], pa.int64()), pa.array([r[1] for r in found], pa.int32()), pa.array([r[2] for r in found], pa.binary()), pa.array([r[3] for r in found], pa.binary()),
                                                      pa.nulls(len(found), pa.binary())], ["block", "t", "at", "value", "held"])

        result = rows.drop("__x").withColumn("score", F.lit(0.0)).schema

        def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, total = None, None
            for batch in batches:
                for i in range(batch.num_rows):
                    if batch.column(1)[i].as_py() < 0:      # the block comes before its values
                        if held is not None:
                            yield done(held, total)
                        held = pa.ipc.open_stream(batch.column(4)[i].as_buffer()).read_next_batch()
                        total = np.zeros(held.num_rows)
                    else:
                        total[raw(batch.column(2)[i], "<i4")] += raw(batch.column(3)[i], "<f8")
            if held is not None:
                yield done(held, total)

        def done(held, total):
            return pa.RecordBatch.from_arrays([*held.columns, pa.array(total / max(many, 1))], [*held.schema.names, "score"])

        cores = spark.sparkContext.defaultParallelism
        parts = 4 * cores
        empty = F.lit(None).cast("binary")
        sub = self.table().select("t", "node", F.lit(-1).cast("long").alias("block"), empty.alias("at"), empty.alias("bins"), *names[5:])
        asked = blocks.select("block", "bins").mapInArrow(pieces, schema)
        values = asked.unionByName(sub).repartition(parts, "t", "node").sortWithinPartitions("t", "node", "block").mapInArrow(read, "block long, t int, at binary, value binary, held binary")
        whole = blocks.select("block", F.lit(-1).alias("t"), empty.alias("at"), empty.alias("value"), "held")
        return values.unionByName(whole).repartition(parts, "block").sortWithinPartitions("block", "t").mapInArrow(added, result)


# -------------------------------------------------- fits of few rows, dealt --

class AllRows:
    """The rows of all blocks, in the order of the blocks."""

    def __init__(self, blocks):
        self.y, self.u, self.fold = (np.concatenate([getattr(b, k) for b in blocks]) for k in ("y", "u", "fold"))
        self.bins = np.concatenate([b.bins for b in blocks])
        self.laid, self.draws = None, {}

    def layout(self) -> Layout:
        """The rows by feature, for all trees of a task."""
        if self.laid is None:
            self.laid = Layout(self.bins)
        return self.laid

    def drawn(self, source: BoostRows, number: int):
        """The rows that a round's fit draws; fits with one seed draw the same ones."""
        f = source.fit(0)
        key = (f.seed, number, f.subsample)
        if key not in self.draws:
            self.draws[key] = np.packbits(source.drawn(0, self.u) < f.subsample)
        return np.unpackbits(self.draws[key], count=len(self.u)).view(bool)

    def once(self, key, make):
        return make()


def dealt(binned: Binned, costs: list[float], run, schema: str) -> DataFrame:
    """The batches of ``run(rows, unit)`` for every unit (a position in ``costs``).
    Each task has its share of the units, about equally costly, and reads all rows."""
    spark, p = binned.spark, binned.p
    many = max(1, min(len(costs), 3 * spark.sparkContext.defaultParallelism))
    shares, load = [[] for _ in range(many)], np.zeros(many)
    for unit in sorted(range(len(costs)), key=lambda i: -costs[i]):
        least = int(load.argmin())
        shares[least].append(unit)
        load[least] += costs[unit]
    # one share per partition: a key that falls into each
    part = F.pmod(F.hash("key"), F.lit(many))
    keys = spark.range(64 * many).withColumnRenamed("id", "key").groupBy(part.alias("share")).agg(F.min("key").alias("key"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, share = [], None
        for batch in batches:
            held += [Block(batch, i, p) for i in range(batch.num_rows)]
            share = batch.column(6)[0].as_py() if batch.num_rows else share
        if held:
            rows = AllRows(held)
            held.clear()
            for unit in shares[share]:
                yield from run(rows, unit)

    copies = binned.blocks.crossJoin(F.broadcast(keys)).select(*binned.blocks.columns, "share", "key")
    return copies.repartition(many, "key").sortWithinPartitions("block").mapInArrow(work, schema)


def boost_dealt(binned: Binned, fits: list[Fit], marks, keep: bool) -> tuple[list[list[Tree]], dict]:
    p, ends = binned.p, max(f.size for f in fits)

    def run(rows, t):
        f = fits[t]
        mine, rest = rows.fold != f.out, np.flatnonzero(rows.fold == f.out)
        lay, y = rows.layout(), rows.y
        line, margin, moved, flat = rows.bins.ravel(), np.repeat(f.base, len(y)), np.empty(len(y)), np.ones(len(y))
        kept, others, found = np.flatnonzero(mine), rest, []
        for number in range(f.size):
            now = BoostRows([f], number, p)
            mu = margin if f.objective == "squared" else np.exp(margin)
            if f.subsample < 1:
                drawn = mine & rows.drawn(now, number)
                kept, others = np.flatnonzero(drawn), np.flatnonzero(~drawn)
            if len(kept):
                nodes = grow_laid(lay, kept, mu - y, flat if f.objective == "squared" else mu, f.rule, now.columns(0), (1.0, 1.0), now.seed(0), values=moved)
            else:
                nodes = np.zeros(1, NODE)
                nodes["id"], nodes["feature"] = 1, -1
            done = number + 1
            moved[others] = Tree(nodes, f.rule).moved(line, others * p)
            margin += moved
            if done in marks:
                shown = np.exp(margin[rest]) if f.objective == "poisson" else margin[rest]
                found.append((t, done, len(rest), float(np.square(rows.y[rest] - shown).sum()), None))
            if keep:
                found.append((t, done, None, None, nodes.tobytes()))
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.float64(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in found], kind) for k, kind in enumerate(kinds)], ["t", "round", "n", "sse", "nodes"])

    result = dealt(binned, [f.size * (min(f.rule.max_depth, ends) + 2.0) for f in fits], run, "t int, round int, n long, sse double, nodes binary")
    trees, scores = [[] for _ in fits], {}
    for r in sorted(result.collect(), key=lambda r: (r["t"], r["round"])):       # scores, and the model if asked for
        if r["nodes"] is None:
            scores[r["t"], r["round"]] = (r["n"], r["sse"])
        else:
            trees[r["t"]].append(Tree(np.frombuffer(r["nodes"], NODE), fits[r["t"]].rule))
    return trees, scores


def runs_of(fits: list[Fit], sizes) -> list[tuple]:
    """(fit, number of its size, first tree, end) of runs of at most ``CHUNK`` trees."""
    out = []
    for i, f in enumerate(fits):
        for step, (first, end) in enumerate(zip([0, *sizes], sizes)):
            out += [(i, step, a, min(a + CHUNK, end, f.size)) for a in range(first, min(end, f.size), CHUNK)]
    return out


def tree_of(source: ForestRows, rows: AllRows, t: int):
    """(nodes, class weights) of forest tree ``t``."""
    kept, a, b = source.of(rows, t)
    own = classes_of(source, t, a.sum(), b.sum())
    if not len(a):
        empty = np.zeros(1, NODE)
        empty["id"], empty["feature"] = 1, -1
        return empty, own
    whole_a, whole_b = np.zeros(len(rows.y)), np.zeros(len(rows.y))
    whole_a[kept], whole_b[kept] = a, b
    return grow_laid(rows.layout(), kept, whole_a, whole_b, source.fit(t).rule, np.arange(rows.bins.shape[1]), own, source.seed(t)), own


def forest_dealt(binned: Binned, fit: Fit) -> "ForestTable":
    ready(binned, [fit])
    runs, source = runs_of([fit], [fit.size]), ForestRows([fit])

    def run(rows, unit):
        for t in range(*runs[unit][2:]):
            nodes, own = tree_of(source, rows, t)
            yield subtree_row(t, 1, Tree(nodes, fit.rule, own))

    path = scratch_path(binned.spark, "forest")
    dealt(binned, [b - a for _, _, a, b in runs], run, SUBTREES).write.parquet(path)
    return ForestTable(path, {t: None for t in range(fit.size)})


PARTS = "fit int, block long, step int, ys binary, totals binary, first int"


def forest_parts_dealt(binned: Binned, fits: list[Fit], depths, splits, sizes) -> DataFrame:
    ready(binned, fits)
    runs, source, many, wide = runs_of(fits, sizes), ForestRows(fits), len(fits), len(depths) * len(splits)

    def run(rows, unit):
        i, step, first, end = runs[unit]
        rest = np.flatnonzero(rows.fold == fits[i].out)
        bins, total = rows.bins[rest], np.zeros((len(rest), wide))
        if not len(rest):
            return
        for k in range(first, end):
            nodes, own = tree_of(source, rows, i + k * many)
            total += Tree(nodes, fits[i].rule, own).variants(bins, depths, splits).reshape(len(rest), wide)
        for block, a in enumerate(range(0, len(rest), REST_ROWS)):
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([block], pa.int64()), pa.array([step], pa.int32()), pa.array([rows.y[rest[a:a + REST_ROWS]].tobytes()], pa.binary()),
                                              pa.array([total[a:a + REST_ROWS].tobytes()], pa.binary()), pa.array([first], pa.int32())], ["fit", "block", "step", "ys", "totals", "first"])

    return dealt(binned, [b - a for _, _, a, b in runs], run, PARTS)


# ---------------------------------------------------------------- boosting --

def start_margin(f: Fit, binned: Binned) -> float:
    n, total = binned.totals(f.out)
    if not n:
        raise ValueError("no training rows")
    if f.objective == "poisson":
        if binned.low < 0:
            raise ValueError("Poisson boosting needs a non-negative target")
        if total <= 0:
            raise ValueError("Poisson boosting needs a positive mean target")
        return float(np.log(total / n))
    return total / n


def boost(binned: Binned, fits: list[Fit], marks=(), keep: bool = True) -> tuple[list[list[Tree]], dict]:
    """(trees of every fit, if they are to be kept, {(fit, round): (rows, squared
    error)} of the rows it leaves out after each round in ``marks``)."""
    p = binned.p
    for f in fits:
        f.base = start_margin(f, binned)
    if binned.is_whole and fits:
        return boost_dealt(binned, fits, marks, keep)
    bases = [f.base for f in fits]
    objectives = [(f.objective, f.out) for f in fits]

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margins = [np.repeat(np.array(bases), len(batch.column(1)[i].as_buffer()) // 8).tobytes() for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(margins, pa.binary())], batch.schema.names)

    def advanced(trees):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    block = Block(batch, i, p)
                    moved = block.margins.copy()
                    for t, tree in trees.items():
                        moved[t] += tree.value[tree.leaves(block.bins)]
                    yield pa.RecordBatch.from_arrays([*[c.slice(i, 1) for c in batch.columns[:5]], pa.array([moved.tobytes()], pa.binary())], batch.schema.names)
        return run

    def errors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block = Block(batch, i, p)
                found = []
                for t, (objective, out) in enumerate(objectives):
                    rest = block.fold == out
                    shown = np.exp(block.margins[t][rest]) if objective == "poisson" else block.margins[t][rest]
                    found.append((t, int(rest.sum()), float(np.square(block.y[rest] - shown).sum())))
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in found], pa.int32()), pa.array([r[1] for r in found], pa.int64()), pa.array([r[2] for r in found], pa.float64())], ["t", "n", "sse"])

    # one place per hash partition: the blocks are not dealt anew each round
    now = binned.blocks.mapInArrow(first, BLOCKS).persist(StorageLevel.MEMORY_AND_DISK)
    trees, scores, last = [[] for _ in fits], {}, None
    for number in range(max((f.size for f in fits), default=0)):
        active = {t: f for t, f in enumerate(fits) if number < f.size}
        sizes = {t: int(binned.totals(f.out)[0] * min(1.0, f.subsample * 1.1 + 0.01)) for t, f in active.items()}
        grown = Growth(binned, BoostRows(fits, number, p), sizes).finished(now)
        if last is not None:
            last.unpersist()
        for t, tree in grown.items() if keep else ():
            trees[t].append(tree)
        done = number + 1
        if done == max(f.size for f in fits) and done not in marks:
            break
        nxt = now.mapInArrow(advanced(grown), BLOCKS).persist(StorageLevel.MEMORY_AND_DISK)
        last, now = now, nxt
        if done % CHECKPOINT == 0:
            kept = now.checkpoint()
            last.unpersist()
            last, now = now, kept
        if done in marks:
            for r in now.mapInArrow(errors, "t int, n long, sse double").groupBy("t").agg(F.sum("n").alias("n"), F.sum("sse").alias("sse")).collect():
                scores[r["t"], done] = (r["n"], r["sse"])
    if last is not None:
        last.unpersist()
    now.unpersist()
    return trees, scores


# ----------------------------------------------------------------- forests --

def ready(binned: Binned, fits: list[Fit]) -> None:
    for f in fits:
        if f.rule.kind in ("gini", "entropy"):
            if not binned.binary:
                raise ValueError("the forest classifier needs labels 0 and 1")
            n, positives = binned.totals(f.out)
            f.classes = balanced(positives, n - positives) if f.balance == "balanced" else (1.0, 1.0)


def growth(binned: Binned, fits: list[Fit]) -> Growth:
    ready(binned, fits)
    # a bootstrap sample has about 63 % of the rows
    sizes = {i + k * len(fits): int(0.66 * binned.totals(f.out)[0]) + 1 for i, f in enumerate(fits) for k in range(f.size)}
    return Growth(binned, ForestRows(fits), dict(sorted(sizes.items())))


def forest_table(binned: Binned, fit: Fit) -> ForestTable:
    if binned.is_whole:
        return forest_dealt(binned, fit)
    return growth(binned, [fit]).written(binned.blocks)


def forest(binned: Binned, fit: Fit) -> list[Tree]:
    return forest_table(binned, fit).trees()


def forest_scores(binned: Binned, fits: list[Fit], depths: list[int], splits: list[int], sizes: list[int]) -> DataFrame:
    """(fit, trees, depth, split, y, score) of the rows each fit leaves out, one row
    each, for every number of trees, depth limit and ``min_samples_split`` (as
    positions in the lists given)."""
    wide = len(depths) * len(splits)
    parts = (forest_parts_dealt if binned.is_whole else forest_parts)(binned, fits, depths, splits, sizes)

    def shown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (fit, _), rows in keyed(batches, [2, 3, 4]):
            y = np.fmax.reduce([raw(r[1], "<f8") for r in rows])
            total = np.zeros((len(sizes), len(y), wide))
            for step, _, values in rows:
                total[step.as_py():] += raw(values, "<f8").reshape(len(y), wide)
            for k, trees in enumerate(sizes):
                at = np.repeat(np.arange(wide), len(y))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), fit), pa.int32()), pa.array(np.full(len(at), k), pa.int32()), pa.array(at // len(splits), pa.int32()),
                                                  pa.array(at % len(splits), pa.int32()), pa.array(np.tile(y, wide)), pa.array((total[k] / trees).T.ravel())], ["fit", "trees", "depth", "split", "y", "score"])

    cores = binned.spark.sparkContext.defaultParallelism
    return parts.repartition(3 * cores, "fit", "block").sortWithinPartitions("fit", "block", "step", "first").mapInArrow(shown, "fit int, trees int, depth int, split int, y double, score double")


def forest_parts(binned: Binned, fits: list[Fit], depths, splits, sizes) -> DataFrame:
    """Per fit, block and number of trees the sums of some trees' values of the rows left out."""
    grown = growth(binned, fits)
    grown.levels(binned.blocks)
    make, source, many, p = grown.subtree(), grown.source, len(fits), binned.p
    wide = len(depths) * len(splits)
    fixed = grown.above(depths)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = {}, 0

        def sent():
            keys = list(held)
            return pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int64()), pa.array([k[2] for k in keys], pa.int32()),
                                               pa.array([held[k][0].tobytes() for k in keys], pa.binary()), pa.array([held[k][1].tobytes() for k in keys], pa.binary()), pa.array([0] * len(keys), pa.int32())], ["fit", "block", "step", "ys", "totals", "first"])

        for (t, node), rows in keyed(batches, [3, 4, 5, 2, 6, 7, 8]):
            nodes, own = make(t, node, rows)
            below = int(node).bit_length() - 1
            nodes["id"] = rebased(nodes["id"], node)
            tree = Tree(nodes, source.fit(t).rule, own)
            step = int(np.searchsorted(sizes, source.tree(t), side="right"))
            for row in rows:
                at = raw(row[5], "<i4")
                at, whole = at[:-1], int(at[-1])
                if not len(at):
                    continue
                key = (t % many, row[3].as_py(), step)
                if key not in held:
                    held[key] = (np.full(whole, np.nan), np.zeros((whole, wide)))
                    size += whole * (wide + 1) * 8
                held[key][0][at] = raw(row[4], "<f8")
                values = tree.variants(raw(row[6], "u1").reshape(-1, p), [d - below for d in depths], splits)
                for k, value in fixed.get((t, node), {}).items():
                    values[:, k] = value
                held[key][1][at] += values.reshape(len(at), -1)
            if size > HELD_BYTES:
                yield sent()
                held, size = {}, 0
        if held:
            yield sent()

    return grown.handed(binned.blocks, with_rest=True).mapInArrow(read, PARTS)


# ------------------------------------------------------------------ models --

@dataclass
class TreeEnsemble:
    """Trees over named bins; scoring broadcasts them (their size is the model's).
    A large forest is a ``table`` instead."""

    kind: str                               # squared, poisson, mean or class
    base: float
    cuts: list
    trees: list = field(default_factory=list)
    table: ForestTable | None = None

    def scored(self, features: str = FEATURES):
        kind, base, cuts = self.kind, self.base, self.cuts
        sent = _context().broadcast([(t.feature, t.bound, t.left_missing, t.left, t.value) for t in self.trees])

        @pandas_udf("double")
        def score(rows: pd.Series) -> pd.Series:
            if not len(rows):
                return pd.Series([], dtype=float)
            bins = to_bins(np.stack(rows.to_numpy()).astype(float), cuts)
            total = np.zeros(len(bins))
            for parts in sent.value:
                tree = Tree.__new__(Tree)
                tree.feature, tree.bound, tree.left_missing, tree.left, tree.value = parts
                total += tree.value[tree.leaves(bins)]
            if kind in ("mean", "class"):
                return pd.Series(total / max(len(sent.value), 1))
            return pd.Series(np.exp(base + total) if kind == "poisson" else base + total)

        return score(vector_to_array(F.col(features)))

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with prediction, and for a classifier score (share of class 1).
        A large forest leaves the features out."""
        if self.table is not None:
            out = self.table.scored(df, self.cuts)
            return out.withColumn("prediction", (F.col("score") > 0.5).cast("double")) if self.kind == "class" else out.withColumnRenamed("score", "prediction")
        if self.kind != "class":
            return df.withColumn("prediction", self.scored())
        return df.withColumn("score", self.scored()).withColumn("prediction", (F.col("score") > 0.5).cast("double"))

    TOPS = "t int, top array<struct<id:long,feature:int,bound:int,left_missing:boolean,child:int>>"
    NODES = "tree int, at int, feature int, bound int, left_missing boolean, child int, value double"

    def write_to(self, path: str) -> None:
        """Two tables: nodes, and bounds between bins (feature -1: kind and base)."""
        spark = _session()
        if self.table is not None:
            self.table.table().write.mode("overwrite").parquet(os.path.join(path, "subtrees"))
            tops = [(t, None) if top is None else (t, [(int(i), int(f), int(b), bool(m), int(c)) for i, f, b, m, c in zip(top.ids, top.feature, top.bound, top.left_missing, top.left)]) for t, top in self.table.tops.items()]
            spark.createDataFrame(tops, self.TOPS).coalesce(1).write.mode("overwrite").parquet(os.path.join(path, "tops"))
        for chunk, first in ((self.trees[a:a + 20], a) for a in range(0, max(len(self.trees), 1), 20)):
            parts = [pd.DataFrame({"tree": np.full(len(t.feature), first + i, np.int32), "at": np.arange(len(t.feature), dtype=np.int32), "feature": t.feature.astype(np.int32), "bound": t.bound.astype(np.int32),
                                   "left_missing": t.left_missing, "child": t.left.astype(np.int32), "value": t.value}) for i, t in enumerate(chunk)]
            rows = spark.createDataFrame(pd.concat(parts), self.NODES) if parts else spark.createDataFrame([], self.NODES)
            rows.coalesce(1).write.mode("overwrite" if not first else "append").parquet(os.path.join(path, "nodes"))
        bounds = [(-1, self.kind if self.table is None else f"{self.kind} table", [float(self.base)])] + [(j, "", [float(v) for v in c]) for j, c in enumerate(self.cuts)]
        spark.createDataFrame(bounds, "feature int, kind string, bounds array<double>").coalesce(1).write.mode("overwrite").parquet(os.path.join(path, "bounds"))

    @staticmethod
    def load(spark, path: str) -> "TreeEnsemble":
        bounds = sorted(spark.read.parquet(os.path.join(path, "bounds")).collect(), key=lambda r: r["feature"])
        kind, _, is_table = bounds[0]["kind"].partition(" ")
        if is_table:
            tops = {}
            for r in spark.read.parquet(os.path.join(path, "tops")).collect():
                tops[r["t"]] = None
                if r["top"] is not None:
                    ids, feature, bound, missing, left = (np.array(v) for v in zip(*r["top"]))
                    top = tops[r["t"]] = bare_tree(feature.astype(np.int32), bound.astype(np.int32), missing.astype(bool), left.astype(np.int32), np.zeros(len(ids)))
                    top.ids = ids
            return TreeEnsemble(kind, bounds[0]["bounds"][0], [np.array(r["bounds"]) for r in bounds[1:]], table=ForestTable(os.path.join(path, "subtrees"), dict(sorted(tops.items()))))
        nodes = spark.read.parquet(os.path.join(path, "nodes")).toPandas().sort_values(["tree", "at"])
        out = TreeEnsemble(bounds[0]["kind"], bounds[0]["bounds"][0], [np.array(r["bounds"]) for r in bounds[1:]])
        for _, own in nodes.groupby("tree"):
            tree = Tree.__new__(Tree)
            tree.feature, tree.bound, tree.left_missing = own.feature.to_numpy(np.int32), own.bound.to_numpy(np.int32), own.left_missing.to_numpy(bool)
            tree.left, tree.value = own.child.to_numpy(np.int32), own.value.to_numpy(float)
            out.trees.append(tree)
        return out


def _session():
    from pyspark.sql import SparkSession
    return SparkSession.getActiveSession()


def _context():
    return _session().sparkContext
