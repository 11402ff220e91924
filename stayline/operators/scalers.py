"""Standard and robust scaling.

Fit is one aggregate over the training rows that returns two numbers per
column (per dataset family when ``by`` is given); apply is column arithmetic
with those numbers as literals, inside the scan's codegen stage.  MLlib's
``StandardScaler`` (sample std) and ``RobustScaler`` (approximate quantiles,
not centred by default) give different numbers, so they are not used.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import col
from .stats import ALL, group_key, quantiles


@dataclass(frozen=True)
class ScalerState:
    """{group: {column: (center, scale)}}; ``kind`` is 'standard' or
    'robust'; ``by`` names the group column (None: one group)."""

    kind: str
    params: dict = field(default_factory=dict)
    by: str | None = None

    def columns(self) -> list[str]:
        cols: list[str] = []
        for per in self.params.values():
            cols += [c for c in per if c not in cols]
        return cols

    def to_df(self, spark: SparkSession) -> DataFrame:
        rows = [(self.kind, str(g), c, None if cs[0] is None else float(cs[0]), float(cs[1]))
                for g, per in self.params.items() for c, cs in per.items()]
        return spark.createDataFrame(
            rows, "kind string, grp string, column string, center double, scale double")

    @staticmethod
    def from_df(df: DataFrame, by: str | None = None) -> "ScalerState":
        rows = df.collect()  # one row per (group, scaled column)
        kinds = {r["kind"] for r in rows}
        if len(kinds) != 1:
            raise ValueError(f"expected one scaler kind, got {kinds}")
        params: dict = {}
        for r in rows:
            params.setdefault(r["grp"], {})[r["column"]] = (r["center"], r["scale"])
        return ScalerState(kinds.pop(), params, by)


def _nonzero(s: float | None) -> float:
    # A constant column (zero spread) keeps scale 1, as in the original.
    if s is None or s == 0.0 or s != s:
        return 1.0
    return float(s)


def fit_standard(df: DataFrame, columns: list[str], by: str | None = None) -> ScalerState:
    """Mean and population standard deviation, NULL skipped."""
    if not columns:
        return ScalerState("standard", {}, by)
    aggs = []
    for i, c in enumerate(columns):
        x = col(c).cast("double")
        aggs += [F.avg(x).alias(f"m{i}"), F.stddev_pop(x).alias(f"s{i}")]
    rows = df.groupBy(group_key(by).alias("g")).agg(*aggs).collect()
    params = {r["g"]: {c: (r[f"m{i}"], _nonzero(r[f"s{i}"])) for i, c in enumerate(columns)}
              for r in rows}
    return ScalerState("standard", params, by)


def fit_robust(df: DataFrame, columns: list[str], by: str | None = None, groups: list | None = None) -> ScalerState:
    """Median and interquartile range (linear interpolation), NULL skipped.  ``groups``, where known, saves a pass."""
    if not columns:
        return ScalerState("robust", {}, by)
    q = quantiles(df, columns, [0.25, 0.5, 0.75], by=by, groups=groups)
    params = {}
    for g, per in (q if by else {ALL: q}).items():
        params[g] = {c: (med, _nonzero(None if q1 is None else q3 - q1)) for c, (q1, med, q3) in per.items()}
    return ScalerState("robust", params, by)


def _scaled(x: Column, center, scale) -> Column:
    if center is None:  # no values at fit time: pass through
        return x
    return (x - F.lit(float(center))) / F.lit(float(scale))


def apply_scaler(df: DataFrame, state: ScalerState) -> DataFrame:
    """(x - center) / scale for each fitted column; NULL passes through.
    Grouped state becomes a CASE over the (few) groups; a row of a group not
    seen at fit time raises, since it has no scale."""
    targets = state.columns()
    if not targets:
        return df
    exprs = []
    for name in df.columns:
        if name not in targets:
            exprs.append(col(name))
            continue
        x = col(name).cast("double")
        if state.by is None:
            center, scale = state.params[ALL][name]
            exprs.append(_scaled(x, center, scale).alias(name))
            continue
        e = None
        for g, per in state.params.items():
            if name not in per:
                continue
            cond = group_key(state.by) == F.lit(g)
            v = _scaled(x, *per[name])
            e = F.when(cond, v) if e is None else e.when(cond, v)
        unseen = F.raise_error(F.concat(F.lit("no scaler was fitted for group "), F.coalesce(group_key(state.by).cast("string"), F.lit("NULL"))))
        exprs.append((e.otherwise(unseen.cast("double")) if e is not None else x).alias(name))
    return df.select(*exprs)


def fit_scalers(df: DataFrame, std_cols: list[str], rob_cols: list[str], by: str | None = None
                ) -> tuple[ScalerState, ScalerState]:
    """Both scalers of a dataset preparation."""
    std = fit_standard(df, std_cols, by)
    return std, fit_robust(df, rob_cols, by, list(std.params) if by and std_cols else None)
