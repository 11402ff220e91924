"""Many logistic regressions over one table by proximal Newton steps.

Problem f minimises  sum_i w_i log-loss_i + (1 / C) * ((1 - r) / 2 |b|^2 + r |b|_1)
over the rows outside its fold, with an unpenalised intercept; w is 1 or the
class weight.  The rows are packed in blocks once.  A step is one job for all
problems: every task adds up loss, gradient and Hessian of its blocks at each
problem's trial point, the sums are shuffled by problem, and (features + 1)^2
numbers per problem come back.  The quadratic model with its penalty is solved
by coordinate descent, which ends as soon as the signs it has reached are those
of the exact solution; a step that does not lower the objective is halved.

A problem takes a handful of steps, far fewer than the iteration limits of a
search; its point after any number of steps is kept, so every limit is read off
the one run.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..features import FEATURES, LABEL
from .ensembles import FOLD, balanced, raw, stacked

BLOCK_ROWS = 1 << 13
MOST_FEATURES = 512         # (features + 1)^2 numbers per problem travel; a search with more fits each problem alone
STEPS, HALVINGS, TOL = 100, 30, 1e-10


@dataclass
class Problem:
    C: float
    l1_ratio: float                     # 0: l2, 1: l1
    out: int                            # fold left out
    balance: bool = False
    penalised: bool = True
    path: list = field(default_factory=list)        # the point after each step, the first is the start

    def penalty(self, b):
        return 0.0 if not self.penalised else ((1 - self.l1_ratio) / 2 * (b[1:] @ b[1:]) + self.l1_ratio * np.abs(b[1:]).sum()) / self.C


def descend(g, h, b, l1, l2):
    """argmin over d of g d + d h d / 2 + penalty(b + d), the first coordinate unpenalised."""
    d = np.zeros_like(b)
    if l1 == 0:
        own = h + np.diag(np.r_[0.0, np.full(len(b) - 1, l2)])
        return -np.linalg.lstsq(own, g + np.r_[0.0, l2 * b[1:]], rcond=None)[0]
    hd, tried = np.zeros_like(b), None
    for _ in range(10_000):
        signs = np.sign(b + d)
        if tried is None or (signs != tried).any():     # new signs: they may already be those of the optimum
            tried, exact = signs, with_signs(g, h, b, signs, l1, l2)
            if exact is not None:
                return exact
        moved = 0.0
        for j in range(len(b)):
            slope, curve = g[j] + hd[j], h[j, j]
            if j:
                slope, curve = slope + l2 * (b[j] + d[j]), curve + l2
            if curve <= 0:
                continue
            at = b[j] + d[j]
            to = at - slope / curve
            if j:
                to = np.sign(to) * max(abs(to) - l1 / curve, 0.0)
            if to != at:
                hd += h[:, j] * (to - at)
                d[j] += to - at
                moved = max(moved, abs(to - at))
        if moved < 1e-12:
            break
    return d


def with_signs(g, h, b, signs, l1, l2):
    """The minimiser of ``descend`` if it has these signs, else None: one linear
    system over the coefficients that are not zero, then the optimality conditions."""
    bound, scale = np.full(len(b), l1), np.full(len(b), l2)
    bound[0] = scale[0] = 0.0
    on = (signs != 0) | (np.arange(len(b)) == 0)
    d = np.where(on, 0.0, -b)
    own = h[np.ix_(on, on)] + np.diag(scale[on])
    try:
        d[on] = -np.linalg.solve(own, g[on] + h[on] @ d + scale[on] * b[on] + bound[on] * signs[on])
    except np.linalg.LinAlgError:
        return None
    at = np.where(on, b + d, 0.0)
    slope = g + h @ d + scale * at
    near = 1e-9 * (1 + np.abs(g).max())
    fits = np.where(on, np.abs(slope + bound * signs) <= near, np.abs(slope) <= bound + near)
    kept = np.sign(at)[1:] == np.where(on, signs, 0.0)[1:]
    return d if fits.all() and kept.all() else None


class Rows:
    """The training rows in blocks (y, fold, x), placed once for all problems."""

    def __init__(self, placed: DataFrame):
        x = vector_to_array(F.col(FEATURES))

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            number = TaskContext.get().partitionId() << 32
            for batch in batches:
                for a in range(0, batch.num_rows, BLOCK_ROWS):
                    part = batch.slice(a, BLOCK_ROWS)
                    values = [part.column(0).to_numpy(), part.column(1).to_numpy().astype(np.int16), np.ascontiguousarray(stacked(part.column(2)))]
                    yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64())] + [pa.array([v.tobytes()], pa.binary()) for v in values], ["block", "y", "fold", "x"])
                    number += 1

        rows = placed.select(F.col(LABEL).cast("double").alias("y"), F.col(FOLD).cast("int").alias("fold"), x.alias("x"))
        first = rows.select(F.size("x")).first()
        self.p = first[0] if first else 0
        self.blocks = rows.mapInArrow(pack, "block long, y binary, fold binary, x binary").persist(StorageLevel.MEMORY_AND_DISK)
        self.counts = {(r["fold"], r["y"]): r["count"] for r in rows.groupBy("fold", "y").count().collect()}
        if {y for _, y in self.counts} - {0.0, 1.0}:
            raise ValueError("logistic regression needs labels 0 and 1")

    def release(self):
        self.blocks.unpersist()


def unpacked(batch, i):
    y, fold = raw(batch.column(1)[i], "<f8"), raw(batch.column(2)[i], "<i2")
    x = raw(batch.column(3)[i], "<f8").reshape(len(y), -1)
    return y, fold, np.concatenate([np.ones((len(y), 1)), x], axis=1)


def weights_of(rows: Rows, problem: Problem):
    n = [sum(v for (f, y), v in rows.counts.items() if y == c and f != problem.out) for c in (1.0, 0.0)]
    return balanced(*n) if problem.balance else (1.0, 1.0)


def solve(rows: Rows, problems: list[Problem]) -> None:
    """Fill every problem's path."""
    weights, p = [weights_of(rows, q) for q in problems], rows.p + 1
    state = []
    for q in problems:
        n1, n0 = (sum(v for (f, y), v in rows.counts.items() if y == c and f != q.out) for c in (1.0, 0.0))
        start = np.zeros(p)
        if n1 and n0 and not q.balance:
            start[0] = np.log(n1 / n0)
        q.path = [start]
        state.append({"trial": start, "step": None, "size": 1.0, "value": None, "halved": 0})
    open_ = set(range(len(problems)))
    cores = rows.blocks.sparkSession.sparkContext.defaultParallelism
    for _ in range(STEPS + HALVINGS):
        if not open_:
            break
        trial = {k: (state[k]["trial"], problems[k].out, weights[k]) for k in sorted(open_)}

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = {k: np.zeros(1 + p + p * p) for k in trial}
            for batch in batches:
                for i in range(batch.num_rows):
                    y, fold, x = unpacked(batch, i)
                    kept = {out: (x[fold != out], y[fold != out]) for out in {out for _, out, _ in trial.values()}}
                    for k, (b, out, (w1, w0)) in trial.items():
                        own, t = kept[out]
                        z = own @ b
                        w = np.where(t == 1, w1, w0)
                        share = 1 / (1 + np.exp(-np.clip(z, -700, 700)))
                        g = own.T @ (w * (share - t))
                        h = own.T @ (own * (w * share * (1 - share))[:, None])
                        total[k] += np.concatenate([[(w * (np.logaddexp(0, z) - t * z)).sum()], g, h.ravel()])
            part = TaskContext.get().partitionId()
            for k, v in total.items():
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([part], pa.int64()), pa.array([v.tobytes()], pa.binary())], ["f", "part", "v"])

        def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = {}
            for batch in batches:
                for i in range(batch.num_rows):
                    k = batch.column(0)[i].as_py()
                    total[k] = total.get(k, 0) + raw(batch.column(2)[i], "<f8")
            for k, v in total.items():
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([v.tobytes()], pa.binary())], ["f", "v"])

        found = rows.blocks.mapInArrow(sums, "f int, part long, v binary").repartition(min(len(trial), cores), "f").sortWithinPartitions("f", "part").mapInArrow(added, "f int, v binary")
        for r in found.collect():           # one row per problem
            k, v = r["f"], np.frombuffer(r["v"], "<f8")
            q, s = problems[k], state[k]
            value = v[0] + q.penalty(s["trial"])
            if s["value"] is not None and not value <= s["value"] + 1e-12 * abs(s["value"]):
                s["size"] /= 2
                s["halved"] += 1
                s["trial"] = q.path[-1] + s["size"] * s["step"]
                if s["halved"] > HALVINGS:
                    open_.discard(k)
                continue
            if s["value"] is not None:
                q.path.append(s["trial"])
            here = q.path[-1]
            scale = 1 / q.C if q.penalised else 0.0
            step = descend(v[1:1 + p], v[1 + p:].reshape(p, p), here, q.l1_ratio * scale, (1 - q.l1_ratio) * scale)
            if np.abs(step).max() <= TOL * (1 + np.abs(here).max()) or len(q.path) > STEPS:
                open_.discard(k)
            s.update(value=value, step=step, size=1.0, halved=0, trial=here + step)


def scores(rows: Rows, problems: list[Problem], points: list[tuple[int, int]]) -> DataFrame:
    """(point, y, score) of the rows that a problem leaves out; ``points`` are
    (problem, number of steps)."""
    at = [(problems[f].path[min(steps, len(problems[f].path) - 1)], problems[f].out) for f, steps in points]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                y, fold, x = unpacked(batch, i)
                for k, (b, out) in enumerate(at):
                    own = fold == out
                    share = 1 / (1 + np.exp(-np.clip(x[own] @ b, -700, 700)))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(share), k), pa.int32()), pa.array(y[own]), pa.array(share)], ["point", "y", "score"])

    return rows.blocks.mapInArrow(run, "point int, y double, score double")

