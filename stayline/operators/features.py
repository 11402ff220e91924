"""Feature/label assembly and class-balance weights."""

from __future__ import annotations

from typing import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import RoleConfig
from ..functions.scalar import col

FEATURES = "features"
LABEL = "label"
WEIGHT = "weight"

NULL_POLICIES = ("error", "skip", "sentinel", "missing")
SENTINEL = -1.0

# Columns that are never features (bookkeeping added by the engine).
_RESERVED = {"split", "fold", "family", "branch", FEATURES, LABEL, WEIGHT}


def feature_columns(df: DataFrame, cfg: RoleConfig, label: str | None,
                    exclude: Sequence[str] = ()) -> list[str]:
    """Every column except the label, the key and bookkeeping.  All of them
    must be numeric: a column that cannot be a feature raises, unless it is
    named in ``exclude``."""
    label = label or cfg.target
    skip = {label.lower(), cfg.key.lower(), cfg.target.lower(), cfg.class_target.lower()}
    skip |= {e.lower() for e in exclude} | _RESERVED
    rest = [f for f in df.schema.fields if f.name.lower() not in skip]
    odd = [f"{f.name} ({f.dataType.simpleString()})" for f in rest if not isinstance(f.dataType, (T.NumericType, T.BooleanType))]
    if odd:
        raise ValueError(f"these columns are not numeric; encode, drop or exclude them: {', '.join(odd)}")
    return [f.name for f in rest]


def assemble(df: DataFrame, cfg: RoleConfig, label: str | None, features: Sequence[str] | None = None,
             null_policy: str = "error", keep: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    """Return (key, *keep, label, features vector) and the feature names.
    ``label`` None gives rows to score, without a label column.

    ``null_policy``: 'error' raises on a NULL feature or label (as the
    original's estimators do on NaN); 'skip' drops such rows; 'sentinel' fills
    features with -1, the default the configuration already uses for missing
    clinical scores, and leaves out rows without a label; 'missing' keeps NULL
    features as NaN, whose side every split of a tree learns.
    """
    if null_policy not in NULL_POLICIES:
        raise ValueError(f"null_policy must be one of {NULL_POLICIES}")
    feats = list(features) if features is not None else feature_columns(df, cfg, label)
    cast = [col(c).cast("double").alias(f"f{i}") for i, c in enumerate(feats)]
    target = [] if label is None else [col(label).cast("double").alias(LABEL)]
    if target and null_policy == "error":
        target = [F.when(col(label).isNull(), F.raise_error(F.lit(f"the label {label} is NULL")).cast("double"))
                  .otherwise(col(label).cast("double")).alias(LABEL)]
    base = df.select(col(cfg.key), *[col(k) for k in keep], *target, *cast)
    fnames = [f"f{i}" for i in range(len(feats))]
    if null_policy == "sentinel":
        base = base.na.fill(SENTINEL, subset=fnames)
        handle = "error"
    else:
        handle = {"skip": "skip", "missing": "keep"}.get(null_policy, "error")
    if target and null_policy != "error":
        base = base.where(F.col(LABEL).isNotNull())
    va = VectorAssembler(inputCols=fnames, outputCol=FEATURES, handleInvalid=handle)
    out = va.transform(base).select(col(cfg.key), *[col(k) for k in keep], *([LABEL] if target else []), FEATURES)
    return out, feats


MOST_CLASSES = 10_000


def class_weights(df: DataFrame, label: str) -> dict[float, float]:
    """'balanced' weights n / (k * n_c); one row per class comes back, and a
    label with more than ``MOST_CLASSES`` values is not a class."""
    rows = df.groupBy(col(label).alias("c")).count().limit(MOST_CLASSES + 1).collect()
    if len(rows) > MOST_CLASSES:
        raise ValueError(f"{label} has more than {MOST_CLASSES} values")
    n = sum(r["count"] for r in rows)
    k = len(rows)
    return {r["c"]: n / (k * r["count"]) for r in rows}


def with_class_weights(df: DataFrame, label: str, weights: dict | None = None,
                       name: str = WEIGHT) -> DataFrame:
    """Add a weight column from the (small) class -> weight map."""
    weights = weights if weights is not None else class_weights(df, label)
    expr = None
    for c, w in weights.items():
        cond = col(label).isNull() if c is None else col(label) == F.lit(c)
        expr = (F.when(cond, F.lit(float(w))) if expr is None else expr.when(cond, F.lit(float(w))))
    return df.withColumn(name, expr.otherwise(F.lit(1.0)) if expr is not None else F.lit(1.0))
