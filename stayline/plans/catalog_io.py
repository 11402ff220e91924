"""Registered storage queries: each writes to a fresh folder under the
session's checkpoint directory and reads back, and is compared with the SQL
of the operator it round-trips."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics as M
from ..operators.clean import clean_and_impute
from ..operators.features import assemble
from ..operators.models.estimators import ModelSpec
from ..operators.models.trainer import TrainedModel, fit
from ..session import scratch_path
from ..sources import storage as S
from ..sources.fixtures import stays
from . import catalog as C
from . import catalog_models as M1
from . import oracle_sql as O
from .catalog import CFG, KEY, register, rounded
from .datasets import FAMILIES, prepare


@register("csv_roundtrip", C.ORACLE["impute_defaults"])
def q_csv_roundtrip(spark, sf):
    """Spells written as header CSV, read back with an explicit schema,
    then cleaned and imputed."""
    raw = stays(spark, sf)
    path = scratch_path(spark, "spells-csv")
    S.write_csv(raw, path)
    back = S.read_spells_csv(spark, path, raw.schema)
    return clean_and_impute(back, CFG)


@register("dataset_roundtrip", O.prepared_base(FAMILIES) + "SELECT spell_id, family, split, " +
          ", ".join(f"{O.r6(c)} AS {c}" for c in O.FEATURE_COLS) + " FROM prepared")
def q_dataset_roundtrip(spark, sf):
    """S2 + S3: all eight datasets in one partitioned write; each family's
    train/test pair loaded back by partition pruning, with all its values."""
    prep = prepare(stays(spark, sf), CFG)
    path = scratch_path(spark, "datasets")
    S.write_datasets(prep.data, path)
    prep.release()
    out = None
    for fam in FAMILIES:
        for split, rows in zip(("train", "test"), S.load_family(spark, path, fam, CFG)):
            part = rows.select(KEY, F.lit(fam).alias("family"), F.lit(split).alias("split"), *O.FEATURE_COLS)
            out = part if out is None else out.unionByName(part)
    return rounded(out)


_VALUES = ("rmse", "mae", "r2", "n")


@register("metrics_report", C._PF_SQL + ", r AS (" + C._metric_sql("days", "actual_los", "predicted_los") + " UNION ALL "
          + C._metric_sql("log", "y_log", "p_log") + ") " + " UNION ALL ".join(
              f"SELECT 'nosplit' AS family, 'category mean' AS model, '{{}}' AS params, scale || ' {v}' AS metric, CAST({v} AS DOUBLE) AS value FROM r"
              for v in _VALUES))
def q_metrics_report(spark, sf):
    """Metric rows (family, model, params, metric, value) appended to a
    table and read back (the markdown report is rendered from the same rows)."""
    path = scratch_path(spark, "metrics")
    S.append_metrics(S.long_metrics(C.q_regression_metrics(spark, sf), "nosplit", "category mean", "{}", "scale", list(_VALUES)), path)
    return spark.read.parquet(path)


@register("model_roundtrip")
def q_model_roundtrip(spark, sf):
    """A fitted model saved (MLlib writer, no pickle), loaded and
    used for the test predictions."""
    prep = prepare(stays(spark, sf), CFG, ("nosplit",))
    tr, feats = assemble(prep.family("nosplit", "train"), CFG, CFG.target, null_policy="sentinel")
    te, _ = assemble(prep.family("nosplit", "test"), CFG, CFG.target, features=feats, null_policy="sentinel")
    model = fit(ModelSpec("ridge"), tr, feats)
    path = scratch_path(spark, "model")
    model.save(path)
    loaded = TrainedModel.load(spark, path)
    return M.regression_frame(loaded.predict(te, KEY), KEY)


_ONE_RIDGE = "cxy * n / (vx * n + 1.0)"


@register("model_roundtrip_one_feature", M1._ONE_SQL + f"""SELECT spell_id, round(greatest(my - ({_ONE_RIDGE}) * mx + ({_ONE_RIDGE}) * {M1.ONE_FEATURE}, 0), 4) AS prediction
FROM prepared, s WHERE split = 'test' AND {M1.ONE_FEATURE} IS NOT NULL""")
def q_model_roundtrip_one_feature(spark, sf):
    """S5 + M10: ridge on one feature, saved and loaded, scores the test rows
    from a frame without labels; clipped at zero as in a run."""
    prep = prepare(stays(spark, sf), CFG, ("nosplit",))
    known = F.col(M1.ONE_FEATURE).isNotNull()
    train, feats = assemble(prep.family("nosplit", "train").where(known), CFG, CFG.target, features=[M1.ONE_FEATURE], null_policy="skip")
    path = scratch_path(spark, "model")
    fit(ModelSpec("ridge"), train, feats).save(path)
    loaded = TrainedModel.load(spark, path)
    test = prep.family("nosplit", "test").where(known).drop(CFG.target)
    rows, _ = assemble(test, CFG, None, features=loaded.feature_names)
    return rounded(loaded.predict(rows, KEY), 4)


@register("preprocessing_state_roundtrip", C.ORACLE["target_encoder_fit"])
def q_preprocessing_state_roundtrip(spark, sf):
    """Scaler parameters and the encoding table saved as Parquet and
    loaded back; the encoding table is returned."""
    _, _, enc = _state_loaded(spark, sf)
    return rounded(enc.table.select(F.col("grp").alias("family"), "column", "category", "n", "encoding"))


@register("scaler_state_roundtrip", O.base(O._families_cte(FAMILIES)) + "\nUNION ALL ".join(
    f"SELECT '{kind}' AS kind, family, '{c}' AS \"column\", {O.r6(center.format(c=c))} AS center, "
    f"{O.r6(f'CASE WHEN {width.format(c=c)} = 0 OR {width.format(c=c)} IS NULL THEN 1.0 ELSE {width.format(c=c)} END')} AS scale FROM train GROUP BY family"
    for kind, cols, center, width in (("standard", O.STD_COLS, "avg({c})", "stddev_pop({c})"),
                                      ("robust", O.ROB_COLS, "quantile_cont({c}, 0.5)", "(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25))"))
    for c in cols))
def q_scaler_state_roundtrip(spark, sf):
    """Both scalers' parameters after a save and a load."""
    std, rob, _ = _state_loaded(spark, sf)
    rows = std.to_df(spark).unionByName(rob.to_df(spark))
    return rounded(rows.select("kind", F.col("grp").alias("family"), "column", "center", "scale"))


def _state_loaded(spark, sf):
    prep = prepare(stays(spark, sf), CFG)
    path = scratch_path(spark, "preprocessing")
    S.save_preprocessing(spark, path, prep.standard, prep.robust, prep.encoder)
    prep.release()
    return S.load_preprocessing(spark, path, by="family")


@register("stream_scoring")
def q_stream_scoring(spark, sf):
    """Batch prediction over a stream: the spells land as parquet files, a
    Structured Streaming query (available-now trigger, one file per
    micro-batch) cleans, scales, encodes and scores them with the state and
    linear model fitted on the no-split training rows; the sink is read
    back."""
    from ..streaming.scoring import score_stream
    raw = stays(spark, sf)
    src = scratch_path(spark, "stream-source")
    raw.repartition(4).write.parquet(src)
    prep = prepare(raw, CFG, ("nosplit",))
    tr, feats = assemble(prep.family("nosplit", "train"), CFG, CFG.target, null_policy="sentinel")
    model = fit(ModelSpec("linear"), tr, feats)
    sink = scratch_path(spark, "stream-sink")
    q = score_stream(spark, src, raw.schema, CFG, "nosplit", prep.standard, prep.robust, prep.encoder,
                     model, sink, scratch_path(spark, "stream-ckpt"), max_files_per_trigger=1)
    q.awaitTermination()
    return spark.read.parquet(sink)
