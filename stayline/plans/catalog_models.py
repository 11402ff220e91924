"""Registered model queries.

Linear models have closed forms on one feature, so their oracle is SQL:
OLS = regr_slope / regr_intercept; ridge slope = Sxy / (Sxx + alpha); lasso
slope = soft-threshold(cov, alpha) / var.  Tree ensembles, boosting,
logistic regression and the isolation forest have no SQL form; their
queries return prediction frames / metric rows (row-count check) and the
tests compare them against brute force and planted signal.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.features import assemble
from ..operators.models.ensembles import Binned
from ..operators.models.estimators import ModelSpec
from ..operators.models.trainer import fit, placed
from ..sources.fixtures import stays
from . import oracle_sql as O
from .catalog import CFG, KEY, register, rounded
from .datasets import prepare

ONE_FEATURE = "comorbidity_score"
RIDGE_ALPHAS = (0.01, 1.0, 100.0)
LASSO_ALPHAS = (0.01, 0.1, 1.0)


def _nosplit_train(spark, sf):
    prep = prepare(stays(spark, sf), CFG, ("nosplit",))
    return prep, prep.family("nosplit", "train")


def _one_feature(spark, sf, kind, alphas):
    prep, train = _nosplit_train(spark, sf)
    data, _ = assemble(train.where(F.col(ONE_FEATURE).isNotNull()), CFG, CFG.target,
                       features=[ONE_FEATURE], null_policy="error")
    data = placed(data).persist()
    rows = []
    for a in alphas:
        m = fit(ModelSpec(kind, {} if a is None else {"alpha": a}), data, is_placed=True).model
        rows.append((kind, a, float(m.coefficients[0]), float(m.intercept)))
    data.unpersist()
    prep.release()
    out = spark.createDataFrame(rows, "model string, alpha double, slope double, intercept double")
    return rounded(out, 5)


_ONE_SQL = O.prepared_base(("nosplit",)) + f"""
, d AS (SELECT {ONE_FEATURE} AS x, spell_episode_los AS y FROM prepared
        WHERE split = 'train' AND spell_episode_los IS NOT NULL AND {ONE_FEATURE} IS NOT NULL)
, s AS (SELECT count(*) AS n, avg(x) AS mx, avg(y) AS my, var_pop(x) AS vx, covar_pop(x, y) AS cxy,
               regr_slope(y, x) AS ols_b, regr_intercept(y, x) AS ols_a FROM d)
"""


def _r5(e):
    # "+ 0.0" turns a negative zero into zero (the Spark side does the same).
    return f"(round(CAST({e} AS DOUBLE), 5) + 0.0)"


@register("ols_one_feature", _ONE_SQL +
          f"SELECT 'linear' AS model, CAST(NULL AS DOUBLE) AS alpha, {_r5('ols_b')} AS slope, "
          f"{_r5('ols_a')} AS intercept FROM s")
def q_ols_one_feature(spark, sf):
    """M1: least squares (normal equations) vs regr_slope/intercept."""
    return _one_feature(spark, sf, "linear", [None])


def _ridge_sql():
    parts = [f"SELECT 'ridge' AS model, CAST({a} AS DOUBLE) AS alpha, {_r5(f'cxy * n / (vx * n + {a})')} AS slope, "
             f"{_r5(f'my - cxy * n / (vx * n + {a}) * mx')} AS intercept FROM s" for a in RIDGE_ALPHAS]
    return _ONE_SQL + " UNION ALL ".join(parts)


def _lasso_sql():
    def slope(a):
        return f"(sign(cxy) * greatest(abs(cxy) - {a}, 0) / vx)"
    parts = [f"SELECT 'lasso' AS model, CAST({a} AS DOUBLE) AS alpha, {_r5(slope(a))} AS slope, "
             f"{_r5(f'my - {slope(a)} * mx')} AS intercept FROM s" for a in LASSO_ALPHAS]
    return _ONE_SQL + " UNION ALL ".join(parts)


@register("ridge_one_feature", _ridge_sql())
def q_ridge_one_feature(spark, sf):
    """M2: ridge at three alphas vs Sxy / (Sxx + alpha)."""
    return _one_feature(spark, sf, "ridge", RIDGE_ALPHAS)


@register("lasso_one_feature", _lasso_sql())
def q_lasso_one_feature(spark, sf):
    """M3: lasso at three alphas vs the soft-threshold closed form."""
    return _one_feature(spark, sf, "lasso", LASSO_ALPHAS)


# ------------------------------------------------- fitted-model queries --
# Rows-only checks (no SQL form); the tests hold the quality checks.

from ..operators import metrics as M  # noqa: E402
from ..operators.models.iforest import run_isolation_forest  # noqa: E402
from .flows import family_data, flow_no_split, flow_split, trained  # noqa: E402


def _regression_query(kind, params=None):
    def q(spark, sf):
        prep = prepare(stays(spark, sf), CFG, ("nosplit",))
        data = family_data(prep, "nosplit", "missing" if kind.startswith("xgboost") else "sentinel")
        model = trained(ModelSpec(kind, params or {}), data, KEY, "nosplit")
        return M.regression_frame(model.predict(data[1], KEY), KEY)
    q.__doc__ = f"Prediction frame (actual_los, predicted_los in days) of '{kind}' on the no-split test rows."
    return q


for _kind in ("linear", "random_forest", "xgboost", "xgboost_poisson"):
    register(f"{_kind}_predictions")(_regression_query(_kind))


def _classifier_query(kind):
    def q(spark, sf):
        prep = prepare(stays(spark, sf), CFG, ("class",))
        data = family_data(prep, "class")
        model = trained(ModelSpec(kind), data, KEY, "class")
        return M.classification_frame(model.predict(data[1], KEY), KEY)
    q.__doc__ = f"Prediction frame (actual_outlier, predicted_outlier) of '{kind}' on the class test rows."
    return q


for _kind in ("logistic", "random_forest_classifier"):
    register(f"{_kind}_predictions")(_classifier_query(_kind))


def _iforest(spark, sf):
    prep = prepare(stays(spark, sf), CFG, ("class",))
    data = prep.family("class")
    feats, _ = assemble(data, CFG, CFG.class_target, null_policy="sentinel")
    return run_isolation_forest(feats, KEY).select(KEY, "anomaly_score", "anomaly")


@register("isolation_forest")
def q_isolation_forest(spark, sf):
    """M9: fit on all classification-family rows (class target excluded),
    score the same rows."""
    return rounded(_iforest(spark, sf))


@register("anomaly_counts")
def q_anomaly_counts(spark, sf):
    """Rows per anomaly label, most frequent first."""
    return M.anomaly_counts(_iforest(spark, sf))


@register("flow_no_split")
def q_flow_no_split(spark, sf):
    """Linear, lasso, ridge, random forest, boosted trees on the
    no-split family; metrics in days and on the log scale."""
    prep = prepare(stays(spark, sf), CFG, ("nosplit",), persist=True)
    found = flow_no_split(prep)
    prep.release()
    return rounded(found)


@register("flow_split")
def q_flow_split(spark, sf):
    """Outlier classifier report + five regressors per IQR branch."""
    prep = prepare(stays(spark, sf), CFG, ("class", "inlier", "outlier"), persist=True)
    cls, reg = flow_split(prep)
    prep.release()
    a = cls.select("family", "model", F.col("class").alias("metric_group"),
                   F.col("precision").alias("v1"), F.col("recall").alias("v2"), F.col("f1").alias("v3"),
                   F.col("auc").alias("v4"))
    b = reg.select("family", "model", F.col("scale").alias("metric_group"), F.col("rmse").alias("v1"),
                   F.col("mae").alias("v2"), F.col("r2").alias("v3"), F.col("n").cast("double").alias("v4"))
    return rounded(a.unionByName(b))


# ------------------------------------------------------------ tuning --
import json  # noqa: E402

from ..operators.tuning import FOLDS, GRIDS, grid_search  # noqa: E402


def _tune_query(kind, family):
    def q(spark, sf):
        prep = prepare(stays(spark, sf), CFG, (family,), persist=True)
        train, test, _ = family_data(prep, family, "missing" if kind.startswith("xgboost") else "sentinel")
        found = grid_search(kind, train, test, KEY)
        prep.release()
        rows = [(kind, json.dumps(p, sort_keys=True), s, p == found.best_params) for p, s in found.cv]
        return rounded(spark.createDataFrame(rows, "model string, params string, cv_score double, best boolean"))
    q.__doc__ = f"Grid search for '{kind}' (the original's grid and fold count): one row per combination."
    return q


register("tune_ridge")(_tune_query("ridge", "nosplit"))
register("tune_lasso")(_tune_query("lasso", "nosplit"))
register("tune_logistic")(_tune_query("logistic", "class"))
for _kind in ("random_forest", "xgboost", "xgboost_poisson"):
    register(f"tune_{_kind}")(_tune_query(_kind, "nosplit"))
register("tune_random_forest_classifier")(_tune_query("random_forest_classifier", "class"))


def _tune_one(kind):
    def q(spark, sf):
        prep, train = _nosplit_train(spark, sf)
        data, _ = assemble(train.where(F.col(ONE_FEATURE).isNotNull()), CFG, CFG.target, features=[ONE_FEATURE], null_policy="skip")
        found = grid_search(kind, data, data, KEY)
        prep.release()
        return rounded(spark.createDataFrame([(kind, float(p["alpha"]), s) for p, s in found.cv], "model string, alpha double, cv_score double"), 4)
    q.__doc__ = f"G1: the '{kind}' grid on one feature; mean of the folds' negative RMSE, checked in closed form."
    return q


def _tune_one_sql(kind):
    slope = {"ridge": "cxy * n / (vx * n + alpha)", "lasso": "sign(cxy) * greatest(abs(cxy) - alpha, 0) / vx"}[kind]
    alphas = ", ".join(f"({a}::DOUBLE)" for a in GRIDS[kind]["alpha"])
    return O.prepared_base(("nosplit",)) + f"""
, d AS (SELECT {ONE_FEATURE} AS x, spell_episode_los AS y, {O.hash_bucket('spell_id', '42:fold', FOLDS[kind])} AS fold FROM prepared
        WHERE split = 'train' AND spell_episode_los IS NOT NULL AND {ONE_FEATURE} IS NOT NULL)
, f AS (SELECT DISTINCT fold AS k FROM d)
, s AS (SELECT k, count(*) AS n, avg(x) AS mx, avg(y) AS my, var_pop(x) AS vx, covar_pop(x, y) AS cxy FROM f JOIN d ON fold <> k GROUP BY k)
, c AS (SELECT k, alpha, {slope} AS b, my - ({slope}) * mx AS a FROM s, (VALUES {alphas}) AS v(alpha))
, r AS (SELECT k, alpha, sqrt(avg((y - a - b * x) * (y - a - b * x))) AS rmse FROM c JOIN d ON fold = k GROUP BY k, alpha)
SELECT '{kind}' AS model, alpha, (round(-avg(rmse), 4) + 0.0) AS cv_score FROM r GROUP BY alpha"""


for _kind in ("ridge", "lasso"):
    register(f"tune_{_kind}_one_feature", _tune_one_sql(_kind))(_tune_one(_kind))


# ----------------------------------------------- one boosting round in SQL --

def _one_stump(kind):
    def q(spark, sf):
        prep = prepare(stays(spark, sf), CFG, ("nosplit",))
        known = F.col(ONE_FEATURE).isNotNull()
        rows = {s: assemble(prep.family("nosplit", s).where(known), CFG, CFG.target, features=[ONE_FEATURE], null_policy="skip")[0] for s in ("train", "test")}
        plain = {"learning_rate": 1.0, "reg_lambda": 0.0} if kind == "xgboost" else {}
        model = fit(ModelSpec(kind, {"n_estimators": 1, "max_depth": 1, **plain}), rows["train"])
        return rounded(model.predict(rows["test"], KEY).select(KEY, "prediction"), 5)
    q.__doc__ = f"One round of '{kind}' at depth 1 on one feature: the best split and both leaves, checked in SQL."
    return q


_STUMP_SQL = _ONE_SQL + """
, v AS (SELECT x, count(*) AS n, sum(y) AS sy FROM d GROUP BY x)
, c AS (SELECT x, sum(n) OVER w AS ln, sum(sy) OVER w AS ls, sum(n) OVER () AS tn, sum(sy) OVER () AS ts,
               row_number() OVER (ORDER BY x DESC) AS above FROM v WINDOW w AS (ORDER BY x))
, b AS (SELECT *, ts / tn AS mu, ls - ts / tn * ln AS gl, (ts - ls) - ts / tn * (tn - ln) AS gr FROM c WHERE above > 1)
, best AS (SELECT * FROM b ORDER BY gl * gl / ln + gr * gr / (tn - ln) DESC, x LIMIT 1)
"""
_LEAVES = {
    "xgboost": ("ls / ln", "(ts - ls) / (tn - ln)"),
    "xgboost_poisson": tuple(f"mu * exp(0.3 * greatest(-0.7, least(0.7, {g} / (mu * {n} + 1))))" for g, n in (("gl", "ln"), ("gr", "(tn - ln)"))),
}
for _kind, (_left, _right) in _LEAVES.items():
    register(f"{_kind}_one_stump", _STUMP_SQL + f"""SELECT p.spell_id, {_r5(f'CASE WHEN p.{ONE_FEATURE} <= best.x THEN {_left} ELSE {_right} END')} AS prediction
FROM prepared p, best WHERE p.split = 'test' AND p.{ONE_FEATURE} IS NOT NULL AND p.spell_episode_los IS NOT NULL""")(_one_stump(_kind))


# ------------------------------- boosting rounds with missing values in SQL --

GROWN = ("frailty_score", "patient_age_on_admission")       # both with NULLs
ROUND_DEPTHS = (1, 2)


def _with_missing(spark, sf):
    prep = prepare(stays(spark, sf), CFG, ("nosplit",))
    train, test = (assemble(prep.family("nosplit", s).where(F.col(CFG.target).isNotNull()), CFG, CFG.target, features=list(GROWN), null_policy="missing")[0] for s in ("train", "test"))
    return train, test


def _round_level(level: int) -> str:
    """CTEs that split every node of r{level} and give r{level + 1}: the best of all
    (feature, value, side of missing values), the bound half way to the next value."""
    r, n = f"r{level}", level + 1
    cells = " UNION ALL ".join(f"SELECT node, {j} AS f, x{j} AS x, g FROM {r} WHERE split = 'train'" for j in (1, 2))
    step = " ".join(f"WHEN b.f = {j} THEN (CASE WHEN r.x{j} IS NULL THEN b.ml ELSE r.x{j} <= b.bound END)" for j in (1, 2))
    return f"""
, cell{n} AS ({cells})
, tot{n} AS (SELECT node, sum(g) AS g, count(*) AS h FROM {r} WHERE split = 'train' GROUP BY node)
, mis{n} AS (SELECT node, f, sum(g) AS gm, count(*) AS hm FROM cell{n} WHERE x IS NULL GROUP BY node, f)
, val{n} AS (SELECT node, f, x, sum(sum(g)) OVER w AS gl, sum(count(*)) OVER w AS hl FROM cell{n} WHERE x IS NOT NULL GROUP BY node, f, x WINDOW w AS (PARTITION BY node, f ORDER BY x))
, opt{n} AS (SELECT v.node, v.f, x, s.ml, t.g, t.h, gl + (CASE WHEN s.ml THEN coalesce(gm, 0) ELSE 0 END) AS gl, hl + (CASE WHEN s.ml THEN coalesce(hm, 0) ELSE 0 END) AS hl
           FROM val{n} v JOIN tot{n} t USING (node) LEFT JOIN mis{n} m ON m.node = v.node AND m.f = v.f JOIN (VALUES (false), (true)) s(ml) ON NOT s.ml OR hm > 0)
, gain{n} AS (SELECT *, gl * gl / (hl + 1) + (g - gl) * (g - gl) / (h - hl + 1) - g * g / (h + 1) AS gain FROM opt{n} WHERE hl >= 1 AND h - hl >= 1)
, best{n} AS (SELECT q.node, q.f, q.ml, CASE WHEN u.after IS NULL THEN 'infinity'::DOUBLE ELSE (q.x + u.after) / 2 END AS bound
           FROM gain{n} q JOIN u ON u.f = q.f AND u.x = q.x WHERE gain > 1e-6
           QUALIFY row_number() OVER (PARTITION BY node ORDER BY round(gain, 8) DESC, q.f, q.x, q.ml) = 1)
, {f'r{n}'} AS (SELECT r.spell_id, r.split, r.x1, r.x2, r.g, CASE WHEN b.node IS NULL THEN r.node WHEN (CASE {step} END) THEN 2 * r.node ELSE 2 * r.node + 1 END AS node
           FROM {r} r LEFT JOIN best{n} b ON b.node = r.node)
"""


def _round_sql() -> str:
    ends = " UNION ALL ".join(
        f"SELECT {d} AS depth, r.spell_id, {_r5('base - 0.3 * l.g / (l.h + 1)')} AS prediction FROM r{d} r "
        f"JOIN (SELECT node, sum(g) AS g, count(*) AS h FROM r{d} WHERE split = 'train' GROUP BY node) l USING (node), mean WHERE r.split = 'test'" for d in ROUND_DEPTHS)
    return O.prepared_base(("nosplit",)) + f"""
, known AS (SELECT spell_id, split, {GROWN[0]} AS x1, {GROWN[1]} AS x2, spell_episode_los AS y FROM prepared WHERE spell_episode_los IS NOT NULL)
, mean AS (SELECT avg(y) AS base FROM known WHERE split = 'train')
, u AS (SELECT f, x, lead(x) OVER (PARTITION BY f ORDER BY x) AS after FROM (SELECT DISTINCT 1 AS f, x1 AS x FROM known WHERE split = 'train' AND x1 IS NOT NULL
        UNION ALL SELECT DISTINCT 2, x2 FROM known WHERE split = 'train' AND x2 IS NOT NULL))
, r0 AS (SELECT spell_id, split, x1, x2, CASE WHEN split = 'train' THEN base - y END AS g, CAST(1 AS BIGINT) AS node FROM known, mean)
{"".join(_round_level(d) for d in range(max(ROUND_DEPTHS)))}
{ends}"""


@register("xgboost_one_round", _round_sql())
def q_xgboost_one_round(spark, sf):
    """M5: one round at depth 1 and 2 on two features with NULLs -- L2 leaf term,
    learning rate, learned side of missing values -- checked in SQL."""
    train, test = _with_missing(spark, sf)
    parts = [fit(ModelSpec("xgboost", {"n_estimators": 1, "max_depth": d}), train).predict(test, KEY).select(F.lit(d).alias("depth"), KEY, "prediction") for d in ROUND_DEPTHS]
    return rounded(parts[0].unionByName(parts[1]), 5)


CHILD_WEIGHTS = (1, 3, 5, 500, 4000)


def _child_weight_sql() -> str:
    left, right = _LEAVES["xgboost_poisson"]
    best = "".join(f", best{w} AS (SELECT * FROM b WHERE mu * ln >= {w} AND mu * (tn - ln) >= {w} ORDER BY gl * gl / (mu * ln + 1) + gr * gr / (mu * (tn - ln) + 1) DESC, x LIMIT 1)" for w in CHILD_WEIGHTS)
    ends = " UNION ALL ".join(f"""SELECT {w} AS min_child_weight, p.spell_id, {_r5(f'CASE WHEN best{w}.x IS NULL THEN (SELECT any_value(mu) FROM b) WHEN p.{ONE_FEATURE} <= best{w}.x THEN {left} ELSE {right} END')} AS prediction
FROM prepared p LEFT JOIN best{w} ON true WHERE p.split = 'test' AND p.{ONE_FEATURE} IS NOT NULL AND p.spell_episode_los IS NOT NULL""" for w in CHILD_WEIGHTS)
    return _STUMP_SQL.rstrip() + best + "\n" + ends


@register("xgboost_poisson_child_weight", _child_weight_sql())
def q_xgboost_poisson_child_weight(spark, sf):
    """M6: one round at depth 1 with the hessian bound of the grid and two that bind."""
    prep = prepare(stays(spark, sf), CFG, ("nosplit",))
    known = F.col(ONE_FEATURE).isNotNull()
    rows = {s: assemble(prep.family("nosplit", s).where(known), CFG, CFG.target, features=[ONE_FEATURE], null_policy="skip")[0] for s in ("train", "test")}
    binned, out = Binned(rows["train"]), None
    for w in CHILD_WEIGHTS:
        model = fit(ModelSpec("xgboost_poisson", {"n_estimators": 1, "max_depth": 1, "min_child_weight": w}), rows["train"], binned=binned)
        part = model.predict(rows["test"], KEY).select(F.lit(w).alias("min_child_weight"), KEY, "prediction")
        out = part if out is None else out.unionByName(part)
    binned.release()
    return rounded(out, 5)


# ------------------------------------------------- Newton steps in SQL --

LOGISTIC_C = (0.01, 1.0, 100.0)


def _logistic_sql() -> str:
    points = ", ".join(f"({c}::DOUBLE)" for c in LOGISTIC_C)
    return O.prepared_base(("class",)).replace("WITH ", "WITH RECURSIVE ", 1) + f"""
, d AS (SELECT {ONE_FEATURE} AS x, CAST(is_outlier AS DOUBLE) AS y FROM prepared WHERE split = 'train' AND {ONE_FEATURE} IS NOT NULL)
, step AS (SELECT 0 AS it, c, 0.0::DOUBLE AS a, 0.0::DOUBLE AS b FROM (VALUES {points}) v(c)
  UNION ALL
  SELECT it + 1, c, a - (ga * (hbb + 1 / c) - (gb + b / c) * hab) / (haa * (hbb + 1 / c) - hab * hab), b - ((gb + b / c) * haa - ga * hab) / (haa * (hbb + 1 / c) - hab * hab)
  FROM (SELECT it, c, a, b, sum(p - y) AS ga, sum((p - y) * x) AS gb, sum(p * (1 - p)) AS haa, sum(p * (1 - p) * x) AS hab, sum(p * (1 - p) * x * x) AS hbb
        FROM (SELECT it, c, a, b, x, y, 1 / (1 + exp(-(a + b * x))) AS p FROM step, d WHERE it < 12) GROUP BY it, c, a, b))
SELECT c AS "C", (round(b, 4) + 0.0) AS slope, (round(a, 4) + 0.0) AS intercept FROM step WHERE it = 12"""


@register("logistic_one_feature", _logistic_sql())
def q_logistic_one_feature(spark, sf):
    """M7: the l2 fit on one feature vs Newton steps in SQL."""
    prep = prepare(stays(spark, sf), CFG, ("class",))
    data, _ = assemble(prep.family("class", "train").where(F.col(ONE_FEATURE).isNotNull()), CFG, CFG.class_target, features=[ONE_FEATURE], null_policy="error")
    data = placed(data).persist()
    rows = []
    for c in LOGISTIC_C:
        m = fit(ModelSpec("logistic", {"C": c, "max_iter": 500}), data, is_placed=True).model
        rows.append((c, float(m.coefficients[0]), float(m.intercept)))
    data.unpersist()
    return rounded(spark.createDataFrame(rows, "C double, slope double, intercept double"), 4)
