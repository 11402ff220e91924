"""Registered queries: one per operator of the inventory, each reading the
driver tables through the ``stays`` derivation, plus the DuckDB SQL that
recomputes the same result independently (where SQL can express it).

Output conventions shared with the oracle: every computed column is aliased;
doubles are rounded to 6 places; counts are BIGINT.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import STAYS
from ..functions.scalar import clip_nonneg, col, inverse_log_target, log_target
from ..operators import metrics as M
from ..operators.clean import clean_and_impute, drop_listed, extract_frailty
from ..operators.outliers import fit_fences, outlier_condition, split_outliers, tag_outliers
from ..operators.scalers import fit_robust, fit_standard
from ..operators.splits import SPLIT_COL, kfold_column, split_column, stratified_kfold_column
from ..operators.target_encoder import fit_target_encoder
from ..sources.fixtures import stays
from . import oracle_sql as O
from .datasets import FAMILY, branch_shapes, prepare, tag_families

CFG = STAYS
KEY = CFG.key
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (the oracle does the same); adding 0.0
    turns a negative zero into zero."""
    return df.select(*[
        (F.round(col(f.name), digits) + F.lit(0.0)).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType))
        else col(f.name) for f in df.schema.fields])


def _clean(spark, sf):
    return clean_and_impute(stays(spark, sf), CFG)


# ---------------------------------------------------------------- cleaning --

@register("drop_columns", O.base("SELECT * FROM dropped"))
def q_drop_columns(spark, sf):
    """Listed columns removed (the admission timestamp here)."""
    return drop_listed(stays(spark, sf), CFG)


@register("frailty_digits", O.base("SELECT spell_id, frailty_score FROM clean"))
def q_frailty_digits(spark, sf):
    """First digit run of the frailty text as a double."""
    return extract_frailty(drop_listed(stays(spark, sf), CFG), CFG).select(KEY, "frailty_score")


@register("impute_defaults", O.base("SELECT * FROM clean"))
def q_impute_defaults(spark, sf):
    """Cleaned table with per-column defaults filled."""
    return _clean(spark, sf)


# ---------------------------------------------------------------- outliers --

@register("iqr_fences", O.base(
    "SELECT q1, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower_fence, "
    "q3 + 1.5 * (q3 - q1) AS upper_fence FROM fences"))
def q_iqr_fences(spark, sf):
    """A1 + A2: quartiles of the target and the Tukey fences."""
    f = fit_fences(_clean(spark, sf), CFG)
    return spark.createDataFrame([(f.q1, f.q3, f.iqr, f.lower, f.upper)],
                                 "q1 double, q3 double, iqr double, lower_fence double, upper_fence double")


@register("outlier_flag", O.base("SELECT spell_id, CAST(outl AS INTEGER) AS is_outlier FROM flagged"))
def q_outlier_flag(spark, sf):
    """0/1 flag; the regression target is dropped."""
    return tag_outliers(_clean(spark, sf), CFG).select(KEY, CFG.class_target)


@register("outlier_fork_counts", O.base(
    "SELECT CASE WHEN outl THEN 'outlier' ELSE 'inlier' END AS branch, count(*) AS rows "
    "FROM flagged GROUP BY 1"))
def q_outlier_fork_counts(spark, sf):
    """F1 + A6: rows per branch of the IQR fork (the flagship question)."""
    df = _clean(spark, sf)
    branch = F.when(outlier_condition(F.col(CFG.target), fit_fences(df, CFG)), "outlier").otherwise("inlier")
    return df.groupBy(branch.alias("branch")).agg(F.count(F.lit(1)).alias("rows"))


@register("iqr_fork", O.base(
    "SELECT spell_id, CASE WHEN outl THEN 'outlier' ELSE 'inlier' END AS branch, spell_episode_los "
    "FROM flagged"))
def q_iqr_fork(spark, sf):
    """both sides of the fork (a NULL target is an inlier)."""
    inl, out = split_outliers(_clean(spark, sf), CFG)
    return (inl.select(KEY, F.lit("inlier").alias("branch"), CFG.target)
            .unionByName(out.select(KEY, F.lit("outlier").alias("branch"), CFG.target)))


# ------------------------------------------------------------------ splits --

@register("train_test_split", O.base(
    f"SELECT spell_id, CASE WHEN {O.hash_unit('spell_id', '42')} < 0.2 THEN 'test' ELSE 'train' END AS split "
    "FROM clean"))
def q_train_test_split(spark, sf):
    """80/20 by key hash."""
    return split_column(_clean(spark, sf), CFG).select(KEY, SPLIT_COL)


@register("kfold_assign", O.base(f"SELECT spell_id, {O.hash_bucket('spell_id', '42:fold', 5)} AS fold FROM clean"))
def q_kfold_assign(spark, sf):
    """5 folds by a second key hash."""
    return kfold_column(_clean(spark, sf), CFG, 5).select(KEY, "fold")


@register("stratified_folds", O.base(
    "SELECT CAST(outl AS INTEGER) AS is_outlier, CAST((('0x' || substr(md5('42:sfold:' || "
    "CAST(CAST(outl AS INTEGER) AS VARCHAR) || ':' || CAST(spell_id AS VARCHAR)), 1, 8))::UBIGINT % 3) "
    "AS INTEGER) AS fold, count(*) AS rows FROM flagged GROUP BY 1, 2"))
def q_stratified_folds(spark, sf):
    """3 folds salted by class; rows per (class, fold)."""
    df = tag_outliers(_clean(spark, sf), CFG)
    f = stratified_kfold_column(df, CFG, CFG.class_target, 3)
    return f.groupBy(CFG.class_target, "fold").agg(F.count(F.lit(1)).alias("rows"))


# ---------------------------------------------------------- target scale --

@register("log_target", O.base(f"SELECT spell_id, {O.r6('ln(1 + spell_episode_los)')} AS spell_episode_los FROM clean"))
def q_log_target(spark, sf):
    """P5: log1p of the target."""
    df = _clean(spark, sf)
    return rounded(df.select(KEY, log_target(col(CFG.target)).alias(CFG.target)))


@register("inverse_log_target", O.base(
    "SELECT spell_id, spell_episode_los, "
    f"CAST(floor(exp(ln(1 + spell_episode_los)) - 1 + {O.EPS}) AS DOUBLE) AS restored_los FROM clean"))
def q_inverse_log_target(spark, sf):
    """floor(expm1(log1p(x)) + eps) restores whole days exactly."""
    df = _clean(spark, sf)
    return df.select(KEY, CFG.target, inverse_log_target(log_target(col(CFG.target))).alias("restored_los"))


# --------------------------------------------------------------- scalers --

def _family_train(spark, sf, family):
    tagged, _ = tag_families(_clean(spark, sf), CFG, (family,))
    return split_column(tagged, CFG).where(F.col(SPLIT_COL) == "train")


def _state_rows(state, spark):
    return rounded(state.to_df(spark).select(F.col("grp").alias(FAMILY), "column", "center", "scale"))


def _fit_sql(cols, center, scale) -> str:
    parts = [f"SELECT family, '{c}' AS \"column\", {O.r6(center.format(c=c))} AS center, "
             f"{O.r6(scale.format(c=c))} AS scale FROM train GROUP BY family" for c in cols]
    return O.base(O._families_cte(("nosplit",)) + "\n" + "\nUNION ALL ".join(parts))


@register("standard_scaler_fit", _fit_sql(
    O.STD_COLS, "avg({c})",
    "CASE WHEN stddev_pop({c}) = 0 OR stddev_pop({c}) IS NULL THEN 1.0 ELSE stddev_pop({c}) END"))
def q_standard_scaler_fit(spark, sf):
    """A3: mean and population std on the training rows (zero std -> 1)."""
    train = _family_train(spark, sf, "nosplit")
    st = fit_standard(train, CFG.present(CFG.std_scale_cols, train.columns), by=FAMILY)
    return _state_rows(st, spark)


@register("robust_scaler_fit", _fit_sql(
    O.ROB_COLS, "quantile_cont({c}, 0.5)",
    "CASE WHEN quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) = 0 OR quantile_cont({c}, 0.25) IS NULL "
    "THEN 1.0 ELSE quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) END"))
def q_robust_scaler_fit(spark, sf):
    """A4: median and IQR on the training rows (zero IQR -> 1)."""
    train = _family_train(spark, sf, "nosplit")
    st = fit_robust(train, CFG.present(CFG.robust_scale_cols, train.columns), by=FAMILY)
    return _state_rows(st, spark)


# --------------------------------------------------------------- encoder --

@register("target_encoder_fit", O.prepared_base(("inlier", "outlier", "class", "nosplit")) +
          "SELECT family, col AS \"column\", cat AS category, n, round(encoding, 6) AS encoding FROM enc")
def q_target_encoder_fit(spark, sf):
    """A5: per (family, column, category) smoothed encoding, all families
    in one grouped aggregate."""
    tagged, _ = tag_families(_clean(spark, sf), CFG)
    tagged = split_column(tagged, CFG)
    y = F.when(F.col(FAMILY) == "class", col(CFG.class_target).cast("double")).otherwise(col(CFG.target))
    train = tagged.where(F.col(SPLIT_COL) == "train").withColumn("__y", y)
    enc = fit_target_encoder(train, CFG.present(CFG.encode_cols, train.columns), "__y", by=FAMILY)
    return rounded(enc.table.select(F.col("grp").alias(FAMILY), "column", "category", "n", "encoding"))


# ------------------------------------------------------ prepared datasets --

FEATURE_COLS = list(O.FEATURE_COLS)


def _prepared(spark, sf, families, label, with_family):
    prep = prepare(stays(spark, sf), CFG, families)
    cols = [KEY] + ([FAMILY] if with_family else []) + [SPLIT_COL]
    lab = col(label).cast("int").alias(label) if label == CFG.class_target else col(label)
    return rounded(prep.data.select(*cols, lab, *FEATURE_COLS))


@register("scaled_features", O.prepared_base(("nosplit",)) + "SELECT spell_id, split, " + ", ".join(
    f"{O.r6(c)} AS {c}" for c in O.STD_COLS + O.ROB_COLS) + " FROM prepared")
def q_scaled_features(spark, sf):
    """P7 + P8: scalers fitted on train, applied to train and test."""
    prep = prepare(stays(spark, sf), CFG, ("nosplit",))
    return rounded(prep.data.select(KEY, SPLIT_COL, *O.STD_COLS, *O.ROB_COLS))


@register("target_encoded", O.prepared_base(("nosplit",)) + "SELECT spell_id, split, " + ", ".join(
    f"{O.r6(c)} AS {c}" for c in O.ENC_COLS) + " FROM prepared")
def q_target_encoded(spark, sf):
    """Encoder fitted on train applied to both sides (unseen -> mean)."""
    prep = prepare(stays(spark, sf), CFG, ("nosplit",))
    return rounded(prep.data.select(KEY, SPLIT_COL, *O.ENC_COLS))


@register("prepared_nosplit", O.prepared_base(("nosplit",)) + "SELECT " +
          O.prepared_select("spell_episode_los", False) + " FROM prepared")
def q_prepared_nosplit(spark, sf):
    """C3 (+C1): clean → impute → split → log → fit → transform."""
    return _prepared(spark, sf, ("nosplit",), CFG.target, False)


@register("prepared_split", O.prepared_base(("inlier", "outlier")) + "SELECT " +
          O.prepared_select("spell_episode_los", True) + " FROM prepared")
def q_prepared_split(spark, sf):
    """IQR fork, then each branch prepared with its own fitted state."""
    return _prepared(spark, sf, ("inlier", "outlier"), CFG.target, True)


@register("prepared_class", O.prepared_base(("class",)) + "SELECT " +
          O.prepared_select("is_outlier", False) + " FROM prepared")
def q_prepared_class(spark, sf):
    """C4: tag outliers, then prepare with the 0/1 flag as encoder target."""
    return _prepared(spark, sf, ("class",), CFG.class_target, False)


@register("branch_shapes", O.prepared_base(("inlier", "outlier", "class", "nosplit")) +
          f"SELECT family, split, count(*) AS rows, CAST({len(O.FEATURE_COLS) + 2} AS BIGINT) AS cols FROM prepared GROUP BY family, split")
def q_branch_shapes(spark, sf):
    """Rows and columns per (family, split) over all four families in one
    plan (the columns are the key, the family's target and the features)."""
    return branch_shapes(prepare(stays(spark, sf), CFG))


@register("class_weights", O.prepared_base(("class",)) +
          "SELECT is_outlier, count(*) AS rows, round(sum(count(*)) OVER () / "
          "(count(*) OVER () * count(*)), 6) AS weight FROM train GROUP BY is_outlier")
def q_class_weights(spark, sf):
    """P13: 'balanced' weights n / (k * n_c) on the classification train rows."""
    train = _family_train(spark, sf, "class")
    counts = train.groupBy(CFG.class_target).agg(F.count(F.lit(1)).alias("rows"))
    from pyspark.sql import Window
    w = Window.partitionBy()  # k rows (one per class)
    weight = F.sum("rows").over(w) / (F.count(F.lit(1)).over(w) * F.col("rows"))
    return rounded(counts.select(CFG.class_target, "rows", weight.alias("weight")))


# --------------------------------------------------------------- metrics --
# A deterministic model derived from the data: the smoothed category mean
# of the target that the encoder itself produces (arrival mode), fitted on
# the training rows and scored on the test rows.

PREDICTOR_COL = "arrival_mode_description"

_PF_SQL = O.prepared_base(("nosplit",)) + f"""
, pf AS (
  SELECT spell_id,
    CAST(floor(exp(spell_episode_los) - 1 + {O.EPS}) AS DOUBLE) AS actual_los,
    CAST(floor(exp(greatest({PREDICTOR_COL}, 0)) - 1 + {O.EPS}) AS DOUBLE) AS predicted_los,
    spell_episode_los AS y_log, greatest({PREDICTOR_COL}, 0) AS p_log
  FROM prepared WHERE split = 'test')
"""


def _prediction_frame(spark, sf):
    prep = prepare(stays(spark, sf), CFG, ("nosplit",))
    test = prep.family("nosplit", "test")
    pred = test.select(KEY, col(CFG.target).alias("label"), col(PREDICTOR_COL).alias("prediction"))
    return pred


@register("prediction_frame", _PF_SQL + "SELECT spell_id, actual_los, predicted_los FROM pf")
def q_prediction_frame(spark, sf):
    """P12 + P11 + P6: actual/predicted in whole days (clip at 0, unpack)."""
    return M.regression_frame(_prediction_frame(spark, sf), KEY, clip=True)


def _metric_sql(scale, a, p):
    return (f"SELECT '{scale}' AS scale, {O.r6(f'sqrt(avg(({a} - {p}) * ({a} - {p})))')} AS rmse, "
            f"{O.r6(f'avg(abs({a} - {p}))')} AS mae, "
            f"{O.r6(f'1 - sum(({a} - {p}) * ({a} - {p})) / (var_pop({a}) * count(*))')} AS r2, "
            f"count(*) AS n FROM pf WHERE {a} IS NOT NULL AND {p} IS NOT NULL")


@register("regression_metrics", _PF_SQL + _metric_sql("days", "actual_los", "predicted_los") +
          " UNION ALL " + _metric_sql("log", "y_log", "p_log"))
def q_regression_metrics(spark, sf):
    """RMSE, MAE, R² in days (unpacked) and on the log scale."""
    pred = _prediction_frame(spark, sf).withColumn("prediction", clip_nonneg(F.col("prediction")))
    return rounded(M.metrics_on_scales(pred, "label", {"days": ("prediction", True), "log": ("prediction", False)}))


_CLS_SQL = O.prepared_base(("class",)) + f"""
, cls AS (
  SELECT p.spell_id, p.is_outlier AS actual, p.{PREDICTOR_COL} AS score,
    CAST(p.{PREDICTOR_COL} > g.m AS INTEGER) AS predicted
  FROM prepared p JOIN gstat g ON g.family = p.family WHERE p.split = 'test')
"""


def _class_frame(spark, sf):
    """Test rows of the classification family, scored by the class-target
    encoding of arrival mode; predicted 1 above the training outlier rate."""
    prep = prepare(stays(spark, sf), CFG, ("class",))
    thr = prep.encoder.global_mean["class"]
    test = prep.family("class", "test")
    return test.select(KEY, col(CFG.class_target).alias("actual"), col(PREDICTOR_COL).alias("score"),
                       (col(PREDICTOR_COL) > F.lit(thr)).cast("int").alias("predicted"))


@register("confusion_matrix", _CLS_SQL + "SELECT actual, predicted, count(*) AS rows FROM cls GROUP BY 1, 2")
def q_confusion_matrix(spark, sf):
    """(actual, predicted) counts."""
    return M.confusion_matrix(_class_frame(spark, sf), "actual", "predicted")


_REPORT_SQL = _CLS_SQL + """
, cm AS (SELECT actual, predicted, count(*) AS c FROM cls GROUP BY 1, 2)
, classes AS (SELECT actual AS k FROM cm UNION SELECT predicted FROM cm)
, per AS (
  SELECT k,
    COALESCE((SELECT sum(c) FROM cm WHERE actual = k), 0) AS support,
    COALESCE((SELECT sum(c) FROM cm WHERE predicted = k), 0) AS pn,
    COALESCE((SELECT sum(c) FROM cm WHERE actual = k AND predicted = k), 0) AS tp
  FROM classes)
, per2 AS (
  SELECT k, support, tp,
    CASE WHEN pn = 0 THEN 0.0 ELSE tp / pn END AS precision,
    CASE WHEN support = 0 THEN 0.0 ELSE tp / support END AS recall
  FROM per)
, per3 AS (
  SELECT *, CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2 * precision * recall / (precision + recall) END AS f1
  FROM per2)
SELECT CAST(k AS VARCHAR) AS class, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM per3
UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(tp) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM per3
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
                 CAST(sum(support) AS BIGINT) FROM per3
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
                 round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
                 CAST(sum(support) AS BIGINT) FROM per3
"""


@register("classification_report", _REPORT_SQL)
def q_classification_report(spark, sf):
    """Per-class precision/recall/F1/support plus accuracy, macro and
    weighted averages."""
    return rounded(M.classification_report(_class_frame(spark, sf), "actual", "predicted"))


@register("roc_auc", _CLS_SQL + """
, s AS (SELECT score, sum(actual) AS pos, count(*) - sum(actual) AS neg FROM cls GROUP BY score)
, c AS (SELECT pos, neg, COALESCE(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING
                                                 AND 1 PRECEDING), 0) AS below FROM s)
SELECT round(sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg)), 6) AS auc FROM c
""")
def q_roc_auc(spark, sf):
    """A10: exact tie-aware ROC-AUC of the score."""
    return rounded(M.roc_auc(_class_frame(spark, sf), "actual", "score"))


@register("anomaly_label_counts", O.base("SELECT CASE WHEN outl THEN -1 ELSE 1 END AS anomaly, count(*) AS rows FROM flagged GROUP BY 1"))
def q_anomaly_label_counts(spark, sf):
    """Rows per anomaly label, here the IQR flag as -1 / 1."""
    flagged = tag_outliers(_clean(spark, sf), CFG)
    return M.anomaly_counts(flagged.select(F.when(col(CFG.class_target) == 1, -1).otherwise(1).alias("anomaly")))
