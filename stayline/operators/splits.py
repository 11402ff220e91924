"""Train/test split and cross-validation folds by key hash.

``randomSplit`` depends on partitioning and ordering, so re-running on a
different cluster gives different rows.  A hash of the key gives the same
side for a spell everywhere (and across the three dataset families), costs one
projection, and needs no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import RoleConfig
from ..functions.scalar import col, hash_bucket, hash_unit

SPLIT_COL = "split"
FOLD_COL = "fold"


def split_column(df: DataFrame, cfg: RoleConfig, name: str = SPLIT_COL) -> DataFrame:
    """Add 'train' / 'test' by key hash (test fraction from the config)."""
    u = hash_unit(col(cfg.key), str(cfg.seed))
    return df.withColumn(name, F.when(u < F.lit(cfg.test_fraction), F.lit("test")).otherwise(F.lit("train")))


def fold_of(key: Column, k: int, seed: int, label: Column | None = None) -> Column:
    """Fold 0..k-1 by a second key hash; salted by ``label`` for stratified folds."""
    if label is None:
        return hash_bucket(key, f"{seed}:fold", k)
    return hash_bucket(F.concat(label.cast("string"), F.lit(":"), key.cast("string")), f"{seed}:sfold", k)


def kfold_column(df: DataFrame, cfg: RoleConfig, k: int = 5, name: str = FOLD_COL) -> DataFrame:
    """Fold 0..k-1 by a second key hash (independent of the split hash)."""
    return df.withColumn(name, fold_of(col(cfg.key), k, cfg.seed))


def stratified_kfold_column(df: DataFrame, cfg: RoleConfig, label: str, k: int = 3,
                            name: str = FOLD_COL) -> DataFrame:
    """Folds salted by label: within each class the key hash spreads rows
    evenly over the k folds, so every fold holds about 1/k of each class.
    No per-class window (one class may hold most rows)."""
    return df.withColumn(name, fold_of(col(cfg.key), k, cfg.seed, col(label)))
