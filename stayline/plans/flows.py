"""Train-and-evaluate flows.

* ``train_evaluate_regressor`` (tune → train → save → predict → unpack →
  evaluate) and ``train_evaluate_classifier`` (tune → train → save →
  predict → report).  As in the original, tuning results are not used for
  the final fit unless ``use_tuned`` is set, and tuning is skipped unless
  asked for; its rows and the final metrics are appended to ``report`` (a
  table of family, model, params, metric, value) if one is named.
* ``flow_no_split``: five regressors on the no-split family.
* ``flow_split``: the outlier classifier, then five regressors on the
  inliers and five on the outliers.

Each model is trained once (the original trains each one twice in a row), and
a family's rows are assembled and cached once for all its models.  Results are
one metrics DataFrame: (family, model, scale, rmse, mae, r2, n) for regressors
-- days from clipped, floored predictions, the log scale from raw ones --
and (family, model, class, precision, recall, f1, support, auc) for classifiers.
"""

from __future__ import annotations

import json
import os
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import clip_nonneg
from ..operators import metrics as M
from ..operators.features import LABEL, assemble
from ..operators.models.estimators import ModelSpec
from ..operators.models.trainer import PREDICTION, SCORE, TrainedModel, fit
from ..operators.tuning import GRIDS, grid_search, tuning_rows
from ..sources.storage import append_metrics, long_metrics
from .datasets import Prepared

REGRESSORS = ("linear", "lasso", "ridge", "random_forest", "xgboost")
CLASSIFIERS = ("logistic",)


def family_data(prep: Prepared, family: str, null_policy: str = "sentinel"):
    """(train, test, feature names) of a family, assembled."""
    label = prep.cfg.class_target if family == "class" else prep.cfg.target
    train, names = assemble(prep.family(family, "train"), prep.cfg, label, null_policy=null_policy)
    test, _ = assemble(prep.family(family, "test"), prep.cfg, label, features=names, null_policy=null_policy)
    return train, test, names


@contextmanager
def cached_family(prep: Prepared, family: str, null_policy: str = "sentinel"):
    train, test, names = family_data(prep, family, null_policy)
    train, test = train.persist(), test.persist()
    try:
        yield train, test, names
    finally:
        train.unpersist()
        test.unpersist()


def trained(spec: ModelSpec, data, key: str, family: str, tune: bool = False, use_tuned: bool = False,
            save_dir: str | None = None, report: str | None = None) -> TrainedModel:
    """The fitted model of a flow, after an optional search."""
    train, test, names = data
    params = dict(spec.params)
    if tune and spec.kind in GRIDS:
        found = grid_search(spec.kind, train, test, key, seed=spec.seed)
        if report:
            append_metrics(tuning_rows(found, family), report)
        if use_tuned:
            params.update(found.best_params)
    model = fit(ModelSpec(spec.kind, params, spec.seed), train, names)
    if save_dir:
        model.save(os.path.join(save_dir, f"{family}_{spec.kind}"))
    return model


def params_text(model: TrainedModel) -> str:
    return json.dumps(model.spec.params, sort_keys=True)


def train_evaluate_regressor(spec: ModelSpec, prep: Prepared, family: str, null_policy: str = "sentinel",
                             data=None, report: str | None = None, **how) -> tuple[DataFrame, DataFrame, TrainedModel]:
    """Returns (actual/predicted frame in days, metrics rows, model)."""
    cfg = prep.cfg
    data = data or family_data(prep, family, null_policy)
    model = trained(spec, data, cfg.key, family, report=report, **how)
    pred = model.predict(data[1], cfg.key, clip=False)
    shown = pred.withColumn(PREDICTION, clip_nonneg(F.col(PREDICTION))) if spec.clips else pred
    frame = M.regression_frame(shown, cfg.key, unpack=True)
    # both scales in one pass over the predictions
    wide = pred.withColumns({"raw": F.col(PREDICTION), PREDICTION: clip_nonneg(F.col(PREDICTION)) if spec.clips else F.col(PREDICTION)})
    metrics = M.metrics_on_scales(wide, LABEL, {"days": (PREDICTION, True), "log": ("raw", False)}).select(
        F.lit(family).alias("family"), F.lit(spec.kind).alias("model"), "*")
    if report:
        append_metrics(long_metrics(metrics, family, spec.kind, params_text(model), "scale", ["rmse", "mae", "r2", "n"]), report)
    return frame, metrics, model


def train_evaluate_classifier(spec: ModelSpec, prep: Prepared, family: str = "class", null_policy: str = "sentinel",
                              data=None, report: str | None = None, **how) -> tuple[DataFrame, DataFrame, TrainedModel]:
    """Returns (actual/predicted frame, report rows with AUC, model)."""
    cfg = prep.cfg
    data = data or family_data(prep, family, null_policy)
    model = trained(spec, data, cfg.key, family, report=report, **how)
    pred = model.predict(data[1], cfg.key).persist()
    auc = M.roc_auc(pred, LABEL, SCORE).first()["auc"]  # one number
    found = [tuple(r) for r in M.classification_report(pred, LABEL, PREDICTION).collect()]      # k + 3 rows
    pred.unpersist()
    spark = pred.sparkSession
    rows = spark.createDataFrame([(family, spec.kind, *r, auc) for r in found],
                                 "family string, model string, class string, precision double, recall double, f1 double, support long, auc double")
    if report:
        append_metrics(long_metrics(rows, family, spec.kind, params_text(model), "class", ["precision", "recall", "f1", "support", "auc"]), report)
    return M.classification_frame(pred, cfg.key), rows, model


def flow_no_split(prep: Prepared, models=REGRESSORS, family: str = "nosplit", **kw) -> DataFrame:
    """Metrics rows of every regressor on one family."""
    found, schema = [], None
    with cached_family(prep, family) as data:
        for kind in models:
            _, m, _ = train_evaluate_regressor(ModelSpec(kind), prep, family, data=data, **kw)
            found += m.collect()                    # two rows per model
            schema = m.schema
    return prep.data.sparkSession.createDataFrame(found, schema)


def flow_split(prep: Prepared, regressors=REGRESSORS, classifiers=CLASSIFIERS, **kw) -> tuple[DataFrame, DataFrame]:
    """(classifier report rows, regressor metrics rows for both branches)."""
    cls = None
    with cached_family(prep, "class") as data:
        for kind in classifiers:
            _, rows, _ = train_evaluate_classifier(ModelSpec(kind), prep, "class", data=data, **kw)
            cls = rows if cls is None else cls.unionByName(rows)
    reg = None
    for family in ("inlier", "outlier"):
        m = flow_no_split(prep, regressors, family, **kw)
        reg = m if reg is None else reg.unionByName(m)
    return cls, reg
