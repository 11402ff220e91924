"""Exhaustive grid search with k-fold cross-validation, refit on all
training rows, evaluation on the test rows.

Folds are key hashes (plain for regressors, salted by class for
classifiers), so a fold is a filter, not a shuffle.  How a grid is searched:

* linear models: each (combination, fold) goes through ``trainer.fit`` -- the
  same parameter mapping as a single training run (ridge's n- and
  std-dependent penalty is recomputed on each fold's rows) -- a few at a time
  from driver threads, like ``CrossValidator(parallelism=...)``.
* tree ensembles: the rows are binned once, with their folds, and all fits read
  that table.  Combinations that only cut another one short are not fitted:
  a boosted fit is scored after each of the grid's numbers of rounds, a forest
  at each number of trees, depth limit and ``min_samples_split``.  All boosted
  fits go through their rounds together; all forests grow in one job.
* logistic regression: all (combination, fold) problems take their Newton steps
  together; iteration limits are read off one run.

Scores of classifiers are exact areas under the curve, all in one job.
"""

from __future__ import annotations

import itertools
import json
import math
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .features import LABEL
from .metrics import classification_report, regression_metrics, roc_auc, roc_auc_by
from .models import newton
from .models.ensembles import FOLD, Binned, boost, forest_scores
from .models.estimators import PENALTIES, TREES, ModelSpec, check_params, tree_bins, tree_fit
from .models.trainer import PREDICTION, SCORE, TrainedModel, fit, grown, placed
from .models.trees import UNLIMITED
from .splits import fold_of

# The original's search grids.
GRIDS = {
    "ridge": {"alpha": [0.01, 0.1, 1.0, 10.0, 50.0, 100.0]},
    "lasso": {"alpha": [0.01, 0.1, 1.0, 10.0, 50.0, 100.0]},
    "random_forest": {"n_estimators": [100, 200], "max_depth": [10, 20, None],
                      "min_samples_split": [2, 5], "min_samples_leaf": [1, 2]},
    "xgboost": {"n_estimators": [200, 300], "max_depth": [3, 5, 7], "learning_rate": [0.01, 0.05, 0.1],
                "subsample": [0.8, 1.0], "colsample_bytree": [0.8, 1.0]},
    "xgboost_poisson": {"n_estimators": [200, 300], "max_depth": [3, 5, 7], "learning_rate": [0.01, 0.05, 0.1],
                        "subsample": [0.8, 1.0], "colsample_bytree": [0.8, 1.0], "min_child_weight": [1, 3, 5]},
    "logistic": {"penalty": ["l1", "l2", "elasticnet"], "C": [0.01, 0.1, 1.0, 10.0, 100.0],
                 "class_weight": ["balanced", None], "max_iter": [100, 200, 500]},
    "random_forest_classifier": {"n_estimators": [100, 200, 300], "max_depth": [10, 20, None],
                                 "min_samples_leaf": [1, 2, 4], "class_weight": ["balanced", "balanced_subsample"],
                                 "criterion": ["gini", "entropy"]},
}
FOLDS = {"ridge": 5, "lasso": 5, "random_forest": 5, "xgboost": 5, "xgboost_poisson": 5,
         "logistic": 3, "random_forest_classifier": 3}
# ---------------------------------------------------------------------------

@dataclass
class TuneResult:
    kind: str
    best_params: dict
    cv: list          # [(params, mean score)], every grid combination
    model: object     # refitted TrainedModel
    test_metrics: DataFrame     # (metric, value) rows: errors, or the classification report and the AUC


def combos(grid: dict) -> list[dict]:
    return [dict(zip(grid, values)) for values in itertools.product(*grid.values())]


def _score(spec: ModelSpec, model, valid: DataFrame, key: str) -> float:
    pred = model.predict(valid, key, clip=False)      # the search scores raw predictions
    if spec.is_classifier:
        return float(roc_auc(pred, LABEL, SCORE).first()["auc"])
    return -float(regression_metrics(pred, LABEL, PREDICTION).first()["rmse"])  # higher is better


def evaluated(spec: ModelSpec, model, test: DataFrame, key: str) -> DataFrame:
    """(metric, value) of a model on the test rows; linear predictions are clipped as in a run."""
    pred = model.predict(test, key).persist()
    if spec.is_classifier:
        report = classification_report(pred, LABEL, PREDICTION)
        rows = report.select(F.explode(F.array(*[F.struct(F.concat_ws(" ", "class", F.lit(m)).alias("metric"), F.col(m).cast("double").alias("value"))
                                                 for m in ("precision", "recall", "f1", "support")])).alias("x")).select("x.*")
        rows = rows.unionByName(roc_auc(pred, LABEL, SCORE).select(F.lit("roc_auc").alias("metric"), F.col("auc").alias("value")))
    else:
        one = regression_metrics(pred, LABEL, PREDICTION)
        rows = one.select(F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
                                              for m in ("rmse", "mae", "r2", "n")])).alias("x")).select("x.*")
    found = [tuple(r) for r in rows.collect()]      # a few numbers per class
    pred.unpersist()
    return test.sparkSession.createDataFrame(found, "metric string, value double")


def _without(params: dict, *axes: str) -> tuple:
    return tuple((k, v) for k, v in params.items() if k not in axes)


def _mean(values: list) -> float:
    """Mean over the folds that have rows."""
    known = [v for v in values if v is not None]
    return sum(known) / len(known) if known else float("nan")


def _boosted_scores(kind: str, binned: Binned, every: list[dict], folds: list[int], seed: int) -> list[float]:
    rounds = lambda p: int(p.get("n_estimators", 100))
    marks = sorted({rounds(p) for p in every})
    groups = list(dict.fromkeys(_without(p, "n_estimators") for p in every))
    fits = [tree_fit(ModelSpec(kind, {**dict(g), "n_estimators": marks[-1]}, seed), binned.p, f) for g in groups for f in folds]
    _, found = boost(binned, fits, marks, keep=False)
    score = lambda t, m: -math.sqrt(found[t, m][1] / found[t, m][0]) if found[t, m][0] else None
    return [_mean([score(groups.index(_without(p, "n_estimators")) * len(folds) + i, rounds(p)) for i in range(len(folds))]) for p in every]


def _forest_scores(kind: str, binned: Binned, every: list[dict], folds: list[int], seed: int) -> list[float]:
    cut = ("n_estimators", "max_depth", "min_samples_split")
    specs = [tree_fit(ModelSpec(kind, p, seed), binned.p) for p in every]
    depths, splits, sizes = (sorted({of(s) for s in specs}) for of in (lambda s: s.rule.max_depth, lambda s: s.rule.min_split, lambda s: s.size))
    groups = list(dict.fromkeys(_without(p, *cut) for p in every))
    whole = {"n_estimators": sizes[-1], "max_depth": None if depths[-1] == UNLIMITED else depths[-1]}
    fits = [tree_fit(ModelSpec(kind, {**dict(g), **whole}, seed), binned.p, f) for g in groups for f in folds]
    rows = forest_scores(binned, fits, depths, splits, sizes)
    point = ["fit", "trees", "depth", "split"]
    if ModelSpec(kind).is_classifier:
        points = list(itertools.product(range(len(fits)), range(len(sizes)), range(len(depths)), range(len(splits))))
        code = ((F.col("fit") * len(sizes) + F.col("trees")) * len(depths) + F.col("depth")) * len(splits) + F.col("split")
        found = {points[r["point"]]: r["auc"] for r in roc_auc_by(rows.select(code.alias("point"), "y", "score"), "point", "y", "score").collect()}
    else:
        error = F.sqrt(F.avg((F.col("y") - F.col("score")) ** 2))
        found = {tuple(r[:4]): -r["e"] for r in rows.groupBy(*point).agg(error.alias("e")).collect()}
    at = lambda p, s, i: (groups.index(_without(p, *cut)) * len(folds) + i, sizes.index(s.size), depths.index(s.rule.max_depth), splits.index(s.rule.min_split))
    return [_mean([found.get(at(p, s, i)) for i in range(len(folds))]) for p, s in zip(every, specs)]


def _logistic_scores(rows: newton.Rows, every: list[dict], folds: list[int]) -> list[float]:
    def problem(own, f):
        p = dict(own)
        ratio = PENALTIES[p.get("penalty", "l2")]
        return newton.Problem(float(p.get("C", 1.0)), float(p.get("l1_ratio", 0.5)) if ratio is None else ratio, f,
                              p.get("class_weight") == "balanced", p.get("penalty", "l2") not in (None, "none"))

    groups = list(dict.fromkeys(_without(p, "max_iter") for p in every))
    problems = [problem(g, f) for g in groups for f in folds]
    newton.solve(rows, problems)
    last = lambda t, p: min(int(p.get("max_iter", 100)), len(problems[t].path) - 1)
    asked = lambda p: [(t := groups.index(_without(p, "max_iter")) * len(folds) + i, last(t, p)) for i in range(len(folds))]
    points = list(dict.fromkeys(x for p in every for x in asked(p)))
    found = {points[r["point"]]: r["auc"] for r in roc_auc_by(newton.scores(rows, problems, points), "point", "y", "score").collect()}
    return [_mean([found.get(x) for x in asked(p)]) for p in every]


def _linear_scores(kind: str, data: DataFrame, every: list[dict], folds: list[int], key: str, parallelism: int, seed: int) -> list[float]:
    parts = [(data.where(F.col(FOLD) != f).drop(FOLD), data.where(F.col(FOLD) == f).drop(FOLD)) for f in folds]

    def run(params: dict) -> float:
        spec = ModelSpec(kind, params, seed)
        return _mean([_score(spec, fit(spec, rows, is_placed=True), valid, key) for rows, valid in parts])

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        return list(pool.map(run, every))


def grid_search(kind: str, train: DataFrame, test: DataFrame, key: str, grid: dict | None = None,
                folds: int | None = None, parallelism: int = 4, seed: int = 42) -> TuneResult:
    """Tune ``kind`` on assembled ``train`` (key, label, features); refit
    the best combination on all of ``train``; score it on ``test``.  Every
    combination has its score, the first of the best ones is taken."""
    grid = grid if grid is not None else GRIDS[kind]
    k = folds or FOLDS[kind]
    spec0 = ModelSpec(kind)
    every, numbers = combos(grid), list(range(k))
    for p in every:
        check_params(ModelSpec(kind, p))
    fold = fold_of(F.col(key), k, seed, F.col(LABEL) if spec0.is_classifier else None)
    tagged = train.withColumn(FOLD, fold)
    if kind in TREES:
        if len(set(grid.get("max_bins", [0]))) > 1:
            raise ValueError("max_bins is no axis of a search: the rows are binned once")
        binned = Binned(tagged, tree_bins(ModelSpec(kind, every[0])))
        scores = (_boosted_scores if kind in ("xgboost", "xgboost_poisson") else _forest_scores)(kind, binned, every, numbers, seed)
    else:
        data = placed(tagged).persist()
        rows = newton.Rows(data) if kind == "logistic" else None
        if rows is not None and rows.p <= newton.MOST_FEATURES:
            scores = _logistic_scores(rows, every, numbers)
        else:
            scores = _linear_scores(kind, data, every, numbers, key, parallelism, seed)
        if rows is not None:
            rows.release()
        data.unpersist()
    cv = list(zip(every, scores))
    best = max(cv, key=lambda ps: ps[1])[0]
    spec = ModelSpec(kind, best, seed)
    if kind in TREES:
        model = TrainedModel(spec, grown(spec, binned))
        binned.release()
    else:
        model = fit(spec, train)
    return TuneResult(kind, best, cv, model, evaluated(spec, model, test, key))


def tuning_rows(result: TuneResult, family: str) -> DataFrame:
    """(family, model, params, metric, value): each combination's cross-validation
    score, and the best one's test metrics (``best`` in front of the metric)."""
    spark = result.test_metrics.sparkSession
    text = lambda p: json.dumps(p, sort_keys=True)
    rows = spark.createDataFrame([(family, result.kind, text(p), "cv_score", float(s)) for p, s in result.cv],
                                 "family string, model string, params string, metric string, value double")
    best = result.test_metrics.select(F.lit(family).alias("family"), F.lit(result.kind).alias("model"), F.lit(text(result.best_params)).alias("params"),
                                      F.concat(F.lit("best "), "metric").alias("metric"), "value")
    return rows.unionByName(best)
