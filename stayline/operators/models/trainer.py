"""Train, predict, save and load (the original's train / run / save_model).

``fit`` takes an assembled training frame (key, label, features[, weight]);
``predict`` returns the key, the label (if there is one) and the prediction as
columns -- no positional alignment, so predictions can be joined back by key.

Seeded fits sample rows by partition and position, so the training rows are
first placed by a hash of their keys in a number of partitions that follows
from the row count alone, and sorted in each: the same rows and seed give the
same model on any cluster.
"""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...functions.scalar import clip_nonneg
from ..features import FEATURES, LABEL, WEIGHT, class_weights, with_class_weights
from . import ensembles
from .ensembles import Binned, TreeEnsemble, boost
from .estimators import TREES, ModelSpec, build, check_params, tree_bins, tree_fit, wants_weights

PREDICTION = "prediction"
SCORE = "score"

_LOADERS = {
    "linear": LinearRegressionModel, "ridge": LinearRegressionModel, "lasso": LinearRegressionModel,
    "logistic": LogisticRegressionModel,
}


@dataclass
class TrainedModel:
    spec: ModelSpec
    model: object
    feature_names: list[str] = field(default_factory=list)

    def predict(self, df: DataFrame, key: str, clip: bool = True) -> DataFrame:
        """(key[, label], prediction[, score]).  Linear-family regressors clip
        at zero unless ``clip`` is off (search scores and log-scale metrics are
        unclipped); classifiers add the positive-class probability as
        ``score``.  Rows without a label can be scored."""
        if self.model is None:
            raise ValueError("there is no model to predict with: fit or load one")
        out = self.model.transform(df)
        kept = [c for c in (key, LABEL) if c in df.columns]
        if self.spec.kind in TREES:
            return out.select(*kept, PREDICTION, *([SCORE] if self.spec.is_classifier else []))
        if self.spec.is_classifier:
            return out.select(*kept, F.col(PREDICTION).cast("double").alias(PREDICTION),
                              vector_to_array(F.col("probability"))[1].alias(SCORE))
        pred = F.col(PREDICTION)
        if clip and self.spec.clips:
            pred = clip_nonneg(pred)
        return out.select(*kept, pred.alias(PREDICTION))

    def save(self, path: str) -> None:
        """Write the MLlib model plus a small JSON of the spec (no pickle)."""
        if self.model is None:
            raise ValueError("there is no model to save: fit one")
        if hasattr(self.model, "write_to"):  # trees
            self.model.write_to(os.path.join(path, "model"))
        else:
            self.model.write().overwrite().save(os.path.join(path, "model"))
        spark = _spark_of(self.model)
        meta = json.dumps({"kind": self.spec.kind, "params": self.spec.params,
                           "seed": self.spec.seed, "features": self.feature_names})
        spark.createDataFrame([(meta,)], "meta string").coalesce(1).write.mode("overwrite").text(
            os.path.join(path, "spec"))

    @staticmethod
    def load(spark, path: str) -> "TrainedModel":
        meta = json.loads(spark.read.text(os.path.join(path, "spec")).first()[0])
        spec = ModelSpec(meta["kind"], meta["params"], meta["seed"])
        if spec.kind in TREES:
            model = TreeEnsemble.load(spark, os.path.join(path, "model"))
        else:
            model = _LOADERS[spec.kind].load(os.path.join(path, "model"))
        return TrainedModel(spec, model, meta["features"])


def _spark_of(model):
    from pyspark.sql import SparkSession
    return SparkSession.getActiveSession()  # the session that fitted the model


SMALL_ROWS, FEW_PARTITIONS = 1_000, 16      # small frames: a partition per 1,000 rows, up to 16
LARGE_ROWS = 1_000_000                      # rows per partition beyond that


def placed(train: DataFrame) -> DataFrame:
    """``train`` hash-partitioned and sorted by its key columns (by label and
    features if there are none).  One exchange serves every pass of a fit."""
    n = train.count()
    parts = max(min(FEW_PARTITIONS, -(-n // SMALL_ROWS)), -(-n // LARGE_ROWS), 1)
    keys = [F.col(c) for c in train.columns if c not in (FEATURES, LABEL, WEIGHT)]
    order = keys or [F.col(LABEL), vector_to_array(F.col(FEATURES))]
    return train.repartition(parts, *order).sortWithinPartitions(*order)


def grown(spec: ModelSpec, binned: Binned) -> TreeEnsemble:
    """The tree ensemble of ``spec`` on all rows of ``binned``."""
    own = tree_fit(spec, binned.p)
    model = TreeEnsemble(TREES[spec.kind], own.base, binned.cuts)
    if spec.kind in ("xgboost", "xgboost_poisson"):
        model.trees = boost(binned, [own])[0][0]
        model.base = own.base           # set by boosting: the start margin
        return model
    table = ensembles.forest_table(binned, own)
    if table.nodes() <= ensembles.FOREST_NODES:
        model.trees = table.trees()
    else:
        model.table = table
    return model


def fit(spec: ModelSpec, train: DataFrame, feature_names: list[str] | None = None, is_placed: bool = False,
        binned: Binned | None = None) -> TrainedModel:
    """Fit ``spec`` on an assembled frame.  'balanced' class weights are a
    (k-row) count, broadcast back as a literal map.  A search places its rows
    once and passes ``is_placed``; several tree fits on the same rows pass them
    ``binned`` once, and release them."""
    check_params(spec)
    if spec.kind in TREES:
        tree_fit(spec, 1)               # wrong parameters raise before any job
        own = binned or Binned(train, tree_bins(spec))
        model = grown(spec, own)
        if binned is None:
            own.release()
        return TrainedModel(spec, model, list(feature_names or []))
    rows = train if is_placed else placed(train).persist(StorageLevel.MEMORY_AND_DISK)
    has_w = wants_weights(spec)
    weighted = with_class_weights(rows, LABEL, class_weights(rows, LABEL), WEIGHT) if has_w else rows
    model = build(spec, weighted, has_w).fit(weighted)
    if not is_placed:
        rows.unpersist()
    return TrainedModel(spec, model, list(feature_names or []))


__all__ = ["TrainedModel", "fit", "placed", "PREDICTION", "SCORE", "FEATURES"]
