"""Dataset preparation: the no-split, inlier/outlier and classification
families, each split into train/test, scaled and target-encoded with state
fitted on its own training rows.

The original reads and cleans the source three times and fits each branch
separately.  Here the source is scanned and cleaned once; each cleaned row is
tagged with the families it belongs to (``nosplit``, ``inlier`` or
``outlier``, ``class``) by one ``explode``; every fit is then a single
aggregate grouped by family, and the result is one DataFrame with ``family``
and ``split`` columns that writes as one table partitioned by both.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import RoleConfig
from ..functions.scalar import col, log_target
from ..operators.clean import clean_and_impute
from ..operators.outliers import Fences, fit_fences, outlier_condition
from ..operators.scalers import ScalerState, apply_scaler, fit_scalers
from ..operators.splits import SPLIT_COL, split_column
from ..operators.target_encoder import EncoderState, apply_target_encoder, fit_target_encoder
from ..session import written

FAMILY = "family"
FAMILIES = ("inlier", "outlier", "class", "nosplit")
REGRESSION_FAMILIES = ("inlier", "outlier", "nosplit")


@dataclass
class Prepared:
    data: DataFrame            # all requested families, with family + split
    fences: Fences | None
    standard: ScalerState
    robust: ScalerState
    encoder: EncoderState
    cfg: RoleConfig
    base: DataFrame | None = None  # the persisted cleaned rows, if any

    def release(self) -> None:
        """Drop the cached cleaned rows and encoding table."""
        if self.base is not None:
            self.base.unpersist()
        self.encoder.table.unpersist()

    def family(self, name: str, split: str | None = None) -> DataFrame:
        """One family's rows with that family's columns."""
        df = self.data.where(F.col(FAMILY) == F.lit(name))
        if split:
            df = df.where(F.col(SPLIT_COL) == F.lit(split))
        return df.select(*family_columns(self.data.columns, name, self.cfg))


def family_columns(columns: list[str], family: str, cfg: RoleConfig) -> list[str]:
    """The classification family has the 0/1 flag instead of the LOS
    target; the regression families the reverse."""
    drop = {cfg.target.lower()} if family == "class" else {cfg.class_target.lower()}
    return [c for c in columns if c.lower() not in drop]


def tag_families(df: DataFrame, cfg: RoleConfig, families=FAMILIES,
                 fences: Fences | None = None) -> tuple[DataFrame, Fences | None]:
    """Explode each cleaned row into one row per requested family and set the
    per-family target columns: the log target for regression families, the
    0/1 outlier flag for the classification family."""
    families = tuple(families)
    unknown = set(families) - set(FAMILIES)
    if unknown:
        raise ValueError(f"unknown families {unknown}")
    target = cfg.present([cfg.target], df.columns)
    if not target:
        raise ValueError(f"datasets need the target column {cfg.target!r}, which the table lacks")
    target = target[0]
    need_fences = any(f in families for f in ("inlier", "outlier", "class"))
    if need_fences and fences is None:
        fences = fit_fences(df, cfg)  # on all rows, before the split
    tags = []
    if "nosplit" in families:
        tags.append(F.lit("nosplit"))
    if "inlier" in families or "outlier" in families:
        cond = outlier_condition(col(target), fences)
        tags.append(F.when(cond, F.lit("outlier")).otherwise(F.lit("inlier")))
    if "class" in families:
        tags.append(F.lit("class"))
    fam = F.col(FAMILY)
    tagged = df.withColumn(FAMILY, F.explode(F.array(*tags))).where(fam.isin(*families))
    is_class = fam == F.lit("class")
    if "class" in families:
        flag = outlier_condition(col(target), fences).cast("int")
        tagged = tagged.withColumn(cfg.class_target, F.when(is_class, flag).otherwise(F.lit(None).cast("int")))
    else:
        tagged = tagged.withColumn(cfg.class_target, F.lit(None).cast("int"))
    tagged = tagged.withColumn(
        target, F.when(is_class, F.lit(None).cast("double")).otherwise(log_target(col(target).cast("double"))))
    return tagged, fences


def prepare(df: DataFrame, cfg: RoleConfig, families=FAMILIES, fences: Fences | None = None,
            cleaned: bool = False, persist: bool = False) -> Prepared:
    """clean → impute → (fences) → tag families → split → fit on train →
    transform train and test.  ``df`` is the raw spell table unless
    ``cleaned``.

    The source is read once: the cleaned rows are written to the shared scratch
    folder, and every fit and every pass over the output reads that table, so the
    joins behind the source (and what they broadcast) do not run again.  With
    ``persist`` the cleaned rows are cached instead; the caller then calls
    ``release``."""
    base = df if cleaned else clean_and_impute(df, cfg)
    target = cfg.present([cfg.target], base.columns)
    std_cols, rob_cols, enc_cols = (cfg.present(names, base.columns) for names in (cfg.std_scale_cols, cfg.robust_scale_cols, cfg.encode_cols))
    if persist:
        base = base.persist(StorageLevel.MEMORY_AND_DISK)
    else:
        base = written(base, "cleaned")
    rows, fences = tag_families(base, cfg, families, fences)
    target = target[0]
    # y for the encoder: the 0/1 flag for 'class', the log target otherwise.
    enc_y = "__enc_y"
    rows = split_column(rows, cfg).withColumn(
        enc_y, F.when(F.col(FAMILY) == F.lit("class"), col(cfg.class_target).cast("double"))
        .otherwise(col(target)))
    train = rows.where(F.col(SPLIT_COL) == F.lit("train"))
    std, rob = fit_scalers(train, std_cols, rob_cols, by=FAMILY)
    enc = fit_target_encoder(train, enc_cols, enc_y, by=FAMILY)
    tagged = split_column(tag_families(base, cfg, families, fences)[0], cfg)
    out = apply_target_encoder(apply_scaler(apply_scaler(tagged, std), rob), enc)
    return Prepared(out, fences, std, rob, enc, cfg, base if persist else None)


def branch_shapes(prep: Prepared) -> DataFrame:
    """Rows and columns per (family, split)."""
    ncols = {f: len(family_columns(prep.data.columns, f, prep.cfg)) - 2 for f in FAMILIES}
    counts = prep.data.groupBy(FAMILY, SPLIT_COL).agg(F.count(F.lit(1)).alias("rows"))
    ncol_expr = None
    for f, n in ncols.items():
        cond = F.col(FAMILY) == F.lit(f)
        ncol_expr = F.when(cond, F.lit(n)) if ncol_expr is None else ncol_expr.when(cond, F.lit(n))
    return counts.withColumn("cols", ncol_expr.cast("bigint"))
