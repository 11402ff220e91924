"""Target encoding with automatic (empirical-Bayes) smoothing.

For category c with n rows, target mean m_c and population variance v_c, and
the global mean m and population variance v:

    lambda = v*n / (v*n + v_c);  enc = lambda*m_c + (1 - lambda)*m

and enc = m when lambda is undefined (0/0).  NULL is a category of its own;
a category unseen at fit time encodes to m.

Fit: all encoded columns are unpivoted to (group, column, category, y) and
grouped once -- one shuffle for any number of columns and dataset families,
and map-side partial aggregation absorbs a category that holds a large share
of the rows.  Apply: one left join per column against that column's encoding
table, on the group and null-safe category equality.  Tables whose category
count is within a bound are broadcast (no shuffle; the joins pipeline in one
stage); larger ones use a regular join, which adaptive execution can still
split when a key is skewed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import col
from ..session import ensure_checkpoint_dir
from .stats import ALL, group_key

# Category rows (of all broadcast columns together, over all groups) up to
# which encoding tables are broadcast.  Rows are (group, category, encoding):
# ~100 bytes each.  Larger tables use a shuffled join.
MAX_BROADCAST_CATEGORIES = 1_000_000


@dataclass
class EncoderState:
    """``table``: (grp, column, category, n, cat_mean, encoding) -- one row
    per distinct (group, column, category), kept distributed.
    ``global_mean``: {group: m}."""

    table: DataFrame
    global_mean: dict
    columns: list[str]
    sizes: dict[str, int]
    by: str | None = None


def fit_target_encoder(df: DataFrame, columns: list[str], target: str, by: str | None = None,
                       checkpoint: bool = True) -> EncoderState:
    """Fit on the rows with a target value: one pass over the data.

    The per-(group, column, category) statistics are the only aggregate over
    the rows; they are checkpointed to the shared checkpoint folder (a lost
    executor does not replay the fit).  The global mean and variance per
    group follow from the statistics of any one column, since every row has
    exactly one category in it: m = sum(n m_c) / N and, by the law of total
    variance, v = sum(n (v_c + (m_c - m)^2)) / N."""
    if not columns:
        raise ValueError("target encoder: no columns to encode")
    y = col(target).cast("double")
    fit_rows = df.where(y.isNotNull()).select(
        group_key(by).cast("string").alias("grp"), y.alias("y"), *[col(c) for c in columns])
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), col(c).cast("string").alias("category"))
        for c in columns]))
    long = fit_rows.select("grp", pairs.alias("p"), "y").select("grp", "p.column", "p.category", "y")
    stats = long.groupBy("grp", "column", "category").agg(
        F.count(F.lit(1)).alias("n"), F.avg("y").alias("cat_mean"), F.var_pop("y").alias("cat_var"))
    if checkpoint:
        ensure_checkpoint_dir(df.sparkSession)
        stats = stats.checkpoint()
    else:
        stats = stats.persist()
    first = stats.where(F.col("column") == F.lit(columns[0]))
    # (Names differ from 'n' by more than case: Spark resolves case-insensitively.)
    tot = first.groupBy("grp").agg(F.sum("n").alias("tot_rows"),
                                   F.sum(F.col("n") * F.col("cat_mean")).alias("tot_sum"))
    mean = F.col("tot_sum") / F.col("tot_rows")
    gm = first.join(F.broadcast(tot), "grp").groupBy("grp", "tot_rows", "tot_sum").agg(
        F.sum(F.col("n") * (F.col("cat_var") + (F.col("cat_mean") - mean) ** 2)).alias("ss"))
    glob = {r["grp"]: (float(r["tot_sum"]) / float(r["tot_rows"]), float(r["ss"]) / float(r["tot_rows"]))
            for r in gm.collect()}  # one row per group
    if not glob:
        raise ValueError("target encoder: no rows with a target value")

    def per_group(i: int):
        e = None
        for g, mv in glob.items():
            cond = F.col("grp") == F.lit(g)
            e = F.when(cond, F.lit(mv[i])) if e is None else e.when(cond, F.lit(mv[i]))
        return e

    m, v = per_group(0), per_group(1)
    lam = F.try_divide(v * F.col("n"), v * F.col("n") + F.col("cat_var"))
    enc = F.coalesce(lam * F.col("cat_mean") + (F.lit(1.0) - lam) * m, m)
    table = stats.select("grp", "column", "category", "n", "cat_mean", enc.alias("encoding"))
    sizes = {r["column"]: r["k"] for r in stats.groupBy("column").agg(F.count(F.lit(1)).alias("k")).collect()}
    return EncoderState(table, {g: mv[0] for g, mv in glob.items()}, list(columns), sizes, by)


def _global_mean_expr(state: EncoderState):
    if state.by is None:
        return F.lit(state.global_mean[ALL])
    e = None
    for g, m in state.global_mean.items():
        cond = col(state.by).cast("string") == F.lit(g)
        e = F.when(cond, F.lit(m)) if e is None else e.when(cond, F.lit(m))
    unseen = F.raise_error(F.concat(F.lit("no encoder was fitted for group "), F.coalesce(col(state.by).cast("string"), F.lit("NULL"))))
    return e.otherwise(unseen.cast("double"))


def apply_target_encoder(df: DataFrame, state: EncoderState,
                         max_broadcast: int = MAX_BROADCAST_CATEGORIES) -> DataFrame:
    """Replace each encoded column by its double encoding."""
    out = df
    order = list(df.columns)
    gm = _global_mean_expr(state)
    small, held = set(), 0
    for c in sorted(state.columns, key=lambda c: state.sizes.get(c, 0)):
        held += state.sizes.get(c, 0)
        if held <= max_broadcast:
            small.add(c)
    for i, c in enumerate(state.columns):
        cat, val, grp = f"__cat{i}", f"__enc{i}", f"__grp{i}"
        t = state.table.where(F.col("column") == F.lit(c)).select(
            F.col("grp").alias(grp), F.col("category").alias(cat), F.col("encoding").alias(val))
        if c in small:
            t = F.broadcast(t)
        cond = col(c).cast("string").eqNullSafe(F.col(cat))
        if state.by is not None:
            cond = (col(state.by).cast("string") == F.col(grp)) & cond
        out = out.join(t, cond, "left")
        out = out.withColumn(c, F.coalesce(F.col(val), gm)).drop(cat, val, grp)
    return out.select(*[col(c) for c in order])
