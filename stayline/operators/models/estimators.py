"""Estimators of the original, expressed as MLlib estimators.

Parameter mapping (the original's objective -> MLlib's):

* OLS: ``LinearRegression(regParam=0)`` with the exact normal-equation
  solver.
* Ridge, min ||y - Xw||^2 + alpha ||w||^2: MLlib scales its L2 term by the
  label's standard deviation and divides the loss by n, so
  ``regParam = alpha * std(y) / n``, no standardization; the normal equations
  take the population's deviation, L-BFGS the sample's.
* Lasso, min 1/(2n) ||y - Xw||^2 + alpha ||w||_1: ``regParam = alpha``,
  ``elasticNetParam = 1``, no standardization.
* Ridge and lasso take the solver MLlib picks: one pass for the normal equations
  (penalised ones too) up to 4,096 features, L-BFGS beyond.
* Logistic, C: ``regParam = 1 / (C * n)`` (the weighted loss is divided by
  the weight sum, which 'balanced' weights keep equal to n).
* Random forests and boosted trees: ``ensembles`` (one binned table, all trees
  grown level by level, small nodes handed on).  Without a limit, trees grow
  until no split gains; an explicit depth beyond 30 raises.

A parameter a model does not know raises.

Size-dependent values (n, std(y)) come from one aggregate over the training
rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..features import FEATURES, LABEL, WEIGHT
from .ensembles import Fit
from .trees import MOST_BINS, UNLIMITED, Rule

MAX_TREE_DEPTH = 30         # deepest explicit limit
TOL = 1e-10

REGRESSORS = ("linear", "ridge", "lasso", "random_forest", "xgboost", "xgboost_poisson")
CLASSIFIERS = ("logistic", "random_forest_classifier")


@dataclass
class ModelSpec:
    """A model kind plus the original's keyword parameters (sklearn /
    XGBoost names: alpha, C, penalty, n_estimators, max_depth, ...)."""

    kind: str
    params: dict = field(default_factory=dict)
    seed: int = 42

    @property
    def is_classifier(self) -> bool:
        return self.kind in CLASSIFIERS

    @property
    def clips(self) -> bool:
        """Linear-family predictions are clipped at zero in ``run``."""
        return self.kind in ("linear", "ridge", "lasso")


PARAMETERS = {
    "linear": set(), "ridge": {"alpha"}, "lasso": {"alpha"},
    "random_forest": {"n_estimators", "max_depth", "min_samples_split", "min_samples_leaf", "max_bins"},
    "xgboost": {"n_estimators", "max_depth", "learning_rate", "subsample", "colsample_bytree", "min_child_weight", "reg_lambda", "max_bins"},
    "xgboost_poisson": {"n_estimators", "max_depth", "learning_rate", "subsample", "colsample_bytree", "min_child_weight",
                        "reg_lambda", "max_delta_step", "max_bins"},
    "logistic": {"penalty", "C", "class_weight", "max_iter", "l1_ratio"},
    "random_forest_classifier": {"n_estimators", "max_depth", "min_samples_split", "min_samples_leaf", "class_weight", "criterion", "max_bins"},
}
PENALTIES = {"l2": 0.0, "l1": 1.0, "elasticnet": None, "none": 0.0, None: 0.0}


def check_params(spec: ModelSpec) -> None:
    if spec.kind not in PARAMETERS:
        raise ValueError(f"unknown model kind {spec.kind!r}")
    unknown = set(spec.params) - PARAMETERS[spec.kind]
    if unknown:
        raise ValueError(f"{spec.kind} has no parameters {sorted(unknown)}")


def _depth(v) -> int:
    if v is None:
        return UNLIMITED
    if not 0 <= int(v) <= MAX_TREE_DEPTH:
        raise ValueError(f"max_depth {v} is outside 0 to {MAX_TREE_DEPTH}")
    return int(v)


NORMAL_FEATURES = 4096      # up to which MLlib takes the normal equations


def label_stats(df: DataFrame) -> tuple[int, float]:
    """(rows, the label's standard deviation as MLlib's solver for so many features takes it)."""
    r = df.agg(F.count(F.lit(1)).alias("n"), F.stddev_samp(LABEL).alias("s"), F.stddev_pop(LABEL).alias("p"), F.first(FEATURES).alias("x")).first()
    few = r["x"] is None or r["x"].size <= NORMAL_FEATURES
    return int(r["n"]), float(r["p" if few else "s"] or 0.0)


def build(spec: ModelSpec, train: DataFrame, has_weight: bool = False):
    """Return an unfitted MLlib estimator for ``spec`` on ``train``
    (columns ``features``, ``label`` and optionally ``weight``)."""
    check_params(spec)
    p = dict(spec.params)
    k = spec.kind
    common = dict(featuresCol=FEATURES, labelCol=LABEL)
    if k == "linear":
        return LinearRegression(regParam=0.0, solver="normal", standardization=False, **common)
    if k == "ridge":
        alpha = float(p.get("alpha", 1.0))
        n, s = label_stats(train)
        reg = alpha * s / n if n and s else 0.0
        return LinearRegression(regParam=reg, elasticNetParam=0.0, standardization=False,
                                solver="auto", maxIter=1000, tol=TOL, **common)
    if k == "lasso":
        alpha = float(p.get("alpha", 1.0))
        return LinearRegression(regParam=alpha, elasticNetParam=1.0, standardization=False,
                                solver="auto", maxIter=1000, tol=TOL, **common)
    if k == "logistic":
        c = float(p.get("C", 1.0))
        penalty = p.get("penalty", "l2")
        n = train.count()
        if penalty not in PENALTIES:
            raise ValueError(f"unknown penalty {penalty!r}")
        reg = 0.0 if penalty in (None, "none") else 1.0 / (c * n)
        en = float(p.get("l1_ratio", 0.5)) if penalty == "elasticnet" else PENALTIES[penalty]
        kw = dict(common)
        if has_weight:
            kw["weightCol"] = WEIGHT
        return LogisticRegression(regParam=reg, elasticNetParam=en, standardization=False,
                                  maxIter=int(p.get("max_iter", 100)), tol=1e-9, family="binomial", **kw)
    raise ValueError(f"unknown model kind {k!r}")


def wants_weights(spec: ModelSpec) -> bool:
    return spec.kind == "logistic" and spec.params.get("class_weight") == "balanced"


TREES = {"random_forest": "mean", "random_forest_classifier": "class", "xgboost": "squared", "xgboost_poisson": "poisson"}
CRITERIA = ("gini", "entropy")
BALANCE = (None, "balanced", "balanced_subsample")


def tree_bins(spec: ModelSpec) -> int:
    return int(spec.params.get("max_bins", MOST_BINS))


def tree_fit(spec: ModelSpec, features: int, out: int = -1) -> Fit:
    """The ensemble of ``spec`` on rows of so many features, leaving out fold ``out``."""
    check_params(spec)
    p = dict(spec.params)
    size = int(p.get("n_estimators", 100))
    if spec.kind in ("xgboost", "xgboost_poisson"):
        rule = Rule("newton", _depth(p.get("max_depth", 6)), reg_lambda=float(p.get("reg_lambda", 1.0)), min_child_weight=float(p.get("min_child_weight", 1.0)),
                    max_delta_step=float(p.get("max_delta_step", 0.7 if spec.kind == "xgboost_poisson" else 0.0)), rate=float(p.get("learning_rate", 0.3)))
        return Fit(rule, size, out, TREES[spec.kind], float(p.get("subsample", 1.0)), float(p.get("colsample_bytree", 1.0)), spec.seed)
    common = dict(max_depth=_depth(p.get("max_depth")), min_leaf=int(p.get("min_samples_leaf", 1)), min_split=int(p.get("min_samples_split", 2)))
    if spec.kind == "random_forest":
        return Fit(Rule("mean", **common), size, out, seed=spec.seed)
    if p.get("criterion", "gini") not in CRITERIA or p.get("class_weight") not in BALANCE:
        raise ValueError(f"criterion must be one of {CRITERIA}, class_weight one of {BALANCE}")
    return Fit(Rule(p.get("criterion", "gini"), features=max(1, int(features ** 0.5)), **common), size, out, seed=spec.seed, balance=p.get("class_weight"))
