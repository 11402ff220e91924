"""Isolation forest (Liu, Ting & Zhou, 2008) on Spark.

* Sampling: tree t needs psi = min(256, n) rows drawn without replacement: those
  with the psi lowest numbers of a hash of row and tree.  One pass over the rows
  sends only numbers below a bound that about psi rows pass (and, in the rare
  case that fewer do, a second pass with a higher bound), so about 1.3 psi
  candidates per tree travel, whatever n is: no rows x trees product, no shuffle
  of the rows.  The hash is of the key and the features; equal rows that a task
  reads together are told apart by their rank and its place, so a table whose
  rows or keys repeat is sampled like any other.  Distinct rows give the same
  sample on any cluster.
* Building: ``groupBy(tree).applyInPandas`` grows each tree from its psi
  rows: a random non-constant feature, a uniform threshold, depth limit
  ceil(log2 psi).  A leaf stores depth + c(leaf size).
* Scoring: the forest is at most T * (2 * psi - 1) nodes whatever n is, so
  it is broadcast; a pandas UDF walks all trees over Arrow batches.
  score = -2^(-E[h] / c(psi)); anomaly_score = score - offset (offset
  -0.5 for 'auto', else the contamination quantile of the scores);
  anomaly = -1 if anomaly_score < 0 else 1.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ...session import scratch_path
from ..features import FEATURES
from ..stats import quantiles
from .trees import mixed

EULER = 0.5772156649
NODE_SCHEMA = ("tree int, node int, feature int, threshold double, left int, right int, value double")


def c_factor(n) -> np.ndarray:
    """Average path length of an unsuccessful BST search over n points."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    big = n > 2
    out[big] = 2.0 * (np.log(n[big] - 1.0) + EULER) - 2.0 * (n[big] - 1.0) / n[big]
    out[n == 2] = 1.0
    return out


def _grow(x: np.ndarray, rng: np.random.Generator, max_depth: int):
    """Grow one isolation tree; returns node rows (node, feature, threshold,
    left, right, value).  ``value`` is depth + c(size) for leaves."""
    nodes = []
    stack = [(np.arange(x.shape[0]), 0, 0)]
    next_id = 1
    p = x.shape[1]
    pending = {}
    while stack:
        idx, depth, nid = stack.pop()
        sub = x[idx]
        leaf = depth >= max_depth or len(idx) <= 1
        feat = -1
        if not leaf:
            lo, hi = sub.min(axis=0), sub.max(axis=0)
            candidates = np.flatnonzero(hi > lo)
            if len(candidates) == 0:
                leaf = True
            else:
                feat = int(candidates[rng.integers(len(candidates))])
        if leaf:
            pending[nid] = (nid, -1, 0.0, -1, -1, float(depth + c_factor([len(idx)])[0]))
            continue
        thr = float(rng.uniform(lo[feat], hi[feat]))
        go_left = sub[:, feat] < thr
        if go_left.all() or not go_left.any():  # threshold landed on the max
            go_left = sub[:, feat] <= thr
        left_id, right_id = next_id, next_id + 1
        next_id += 2
        pending[nid] = (nid, feat, thr, left_id, right_id, 0.0)
        stack.append((idx[go_left], depth + 1, left_id))
        stack.append((idx[~go_left], depth + 1, right_id))
    for nid in sorted(pending):
        nodes.append(pending[nid])
    return nodes


def _path_lengths(x: np.ndarray, tree: dict) -> np.ndarray:
    """Vectorised descent of one tree for all rows of ``x``."""
    feat, thr, left, right, value = tree["feature"], tree["threshold"], tree["left"], tree["right"], tree["value"]
    node = np.zeros(x.shape[0], dtype=np.int64)
    active = feat[node] >= 0
    while active.any():
        rows = np.flatnonzero(active)
        n = node[rows]
        f = feat[n]
        go_left = x[rows, f] < thr[n]
        node[rows] = np.where(go_left, left[n], right[n])
        active[rows] = feat[node[rows]] >= 0
    return value[node]


class IsolationForestModel:
    def __init__(self, trees: list[dict], psi: int, offset: float | None, contamination):
        self.trees = trees
        self.psi = psi
        self.offset = offset
        self.contamination = contamination

    def _score_udf(self, spark):
        forest = spark.sparkContext.broadcast(self.trees)  # bounded: T * (2 psi - 1) nodes
        norm = float(c_factor([self.psi])[0]) or 1.0

        @pandas_udf("double")
        def score(arrs: pd.Series) -> pd.Series:
            x = np.stack(arrs.to_numpy()) if len(arrs) else np.zeros((0, 1))
            depth = np.zeros(x.shape[0])
            trees = forest.value
            for t in trees:
                depth += _path_lengths(x, t)
            depth /= max(len(trees), 1)
            return pd.Series(-np.power(2.0, -depth / norm))
        return score

    def score_samples(self, df: DataFrame, features: str = FEATURES) -> DataFrame:
        udf = self._score_udf(df.sparkSession)
        return df.withColumn("__s", udf(vector_to_array(F.col(features))))

    def transform(self, df: DataFrame, features: str = FEATURES) -> DataFrame:
        s = self.score_samples(df, features)
        offset = self.offset
        if offset is None:  # contamination quantile of this data's scores
            q = quantiles(s, ["__s"], [float(self.contamination)])["__s"][0]
            offset = float(q)
        score = F.col("__s") - F.lit(offset)
        return (s.withColumn("anomaly_score", score)
                .withColumn("anomaly", F.when(score < 0, F.lit(-1)).otherwise(F.lit(1)))
                .drop("__s"))


    # -- persistence: one table of nodes, and the forest's numbers as tree -1 --
    def save(self, spark, path: str) -> None:
        rows = [(-1, 0, -1, float("nan") if self.offset is None else float(self.offset), self.psi, -1,
                 0.0 if self.contamination == "auto" else float(self.contamination))]
        for t, tree in enumerate(self.trees):
            rows += [(t, i, *map(_plain, row)) for i, row in enumerate(zip(*(tree[k] for k in ("feature", "threshold", "left", "right", "value"))))]
        spark.createDataFrame(rows, NODE_SCHEMA).coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark, path: str) -> "IsolationForestModel":
        nodes = spark.read.parquet(path).toPandas().sort_values(["tree", "node"])
        own = nodes[nodes.tree == -1].iloc[0]
        trees = [{k: g[k].to_numpy(np.int64 if k in ("feature", "left", "right") else float) for k in ("feature", "threshold", "left", "right", "value")}
                 for t, g in nodes.groupby("tree") if t >= 0]
        return IsolationForestModel(trees, int(own["left"]), None if np.isnan(own["threshold"]) else float(own["threshold"]),
                                    "auto" if own["value"] == 0.0 else float(own["value"]))


def _plain(x):
    return x.item() if isinstance(x, np.generic) else x


def _saved(frame: DataFrame):
    path = scratch_path(frame.sparkSession, "isolation-sample")
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path)


class IsolationForest:
    def __init__(self, n_estimators: int = 100, max_samples: int | str = "auto",
                 contamination: str | float = "auto", seed: int = 42, key: str = "id"):
        self.T = int(n_estimators)
        self.max_samples = max_samples
        self.contamination = contamination
        self.seed = int(seed)
        self.key = key

    def sample(self, df: DataFrame, features: str, n: int, psi: int, bound: float) -> DataFrame:
        """(tree, v, x): for every tree the rows whose number v is below ``bound``."""
        seed, trees = self.seed, np.arange(self.T)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            place = TaskContext.get().partitionId() << 32
            for whole in batches:
                for a in range(0, whole.num_rows, 4096):
                    batch = whole.slice(a, 4096)
                    rows = batch.column(0).to_numpy().view(np.uint64)
                    order = np.argsort(rows, kind="stable")
                    first = np.concatenate([[True], rows[order][1:] != rows[order][:-1]])
                    start = np.maximum.accumulate(np.where(first, np.arange(len(rows)), 0))
                    rank = np.empty(len(rows), np.uint64)
                    rank[order] = (np.arange(len(rows)) - start).astype(np.uint64)
                    place += 1
                    rows = np.where(rank > 0, mixed(rows ^ mixed(rank + mixed(np.array([place], np.uint64)))), rows)
                    salts = mixed(np.uint64(seed) + trees.astype(np.uint64))
                    v = (mixed(rows[None, :] ^ salts[:, None]) >> np.uint64(11)).astype(float) / float(1 << 53)
                    tree, at = np.nonzero(v < bound)
                    yield pa.RecordBatch.from_arrays([pa.array(tree.astype(np.int32)), pa.array(v[tree, at]), batch.column(1).take(pa.array(at))], ["tree", "v", "x"])

        x = vector_to_array(F.col(features))
        own = [F.col(f"`{self.key}`")] if self.key in df.columns else []
        return df.select(F.xxhash64(*own, x).alias("r"), x.alias("x")).mapInArrow(run, "tree int, v double, x array<double>")

    def fit(self, df: DataFrame, features: str = FEATURES) -> IsolationForestModel:
        n = df.count()
        if n == 0:
            raise ValueError("isolation forest: no rows")
        psi = min(256, n) if self.max_samples == "auto" else min(int(self.max_samples), n)
        bound = (psi + 4 * math.sqrt(psi) + 16) / n
        while True:
            found = _saved(self.sample(df, features, n, psi, min(bound, 1.0)))
            counts = [r["count"] for r in found.groupBy("tree").count().collect()]      # one per tree
            if bound >= 1 or len(counts) == self.T and min(counts) >= psi:
                break
            bound *= 4
        place = F.row_number().over(Window.partitionBy("tree").orderBy("v", "x"))
        sample = found.withColumn("__r", place).where(F.col("__r") <= psi)
        depth_limit = max(1, math.ceil(math.log2(max(psi, 2))))
        seed = self.seed

        def build(pdf: pd.DataFrame) -> pd.DataFrame:
            t = int(pdf["tree"].iloc[0])
            x = np.stack(pdf.sort_values("__r")["x"].to_numpy()).astype(float)
            rng = np.random.default_rng([seed, t])
            rows = _grow(x, rng, depth_limit)
            out = pd.DataFrame(rows, columns=["node", "feature", "threshold", "left", "right", "value"])
            out.insert(0, "tree", t)
            return out

        nodes = sample.groupBy("tree").applyInPandas(build, NODE_SCHEMA)
        rows = nodes.orderBy("tree", "node").collect()  # bounded: T * (2 psi - 1) rows
        trees = []
        by_tree: dict[int, list] = {}
        for r in rows:
            by_tree.setdefault(r["tree"], []).append(r)
        for t in sorted(by_tree):
            rs = by_tree[t]
            trees.append({
                "feature": np.array([r["feature"] for r in rs], dtype=np.int64),
                "threshold": np.array([r["threshold"] for r in rs], dtype=float),
                "left": np.array([r["left"] for r in rs], dtype=np.int64),
                "right": np.array([r["right"] for r in rs], dtype=np.int64),
                "value": np.array([r["value"] for r in rs], dtype=float),
            })
        offset = -0.5 if self.contamination == "auto" else None
        return IsolationForestModel(trees, psi, offset, self.contamination)


def run_isolation_forest(df: DataFrame, key: str, features: str = FEATURES, model: IsolationForestModel | None = None, **params) -> DataFrame:
    """Fit on ``df`` -- unless a loaded ``model`` is given, which wins -- and
    score the same rows (the original's ``run``), returning a new frame with
    ``anomaly_score`` and ``anomaly``."""
    model = model or IsolationForest(key=key, **params).fit(df, features)
    return model.transform(df, features)
