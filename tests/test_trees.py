"""Trees grown by Spark jobs: against brute force, between their ways of growing, and searches against single fits."""

import math

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from stayline.operators.metrics import roc_auc, roc_auc_by
from stayline.operators.models import ensembles, newton
from stayline.operators.models.ensembles import FOLD, Binned, boost, forest_scores
from stayline.operators.models.estimators import ModelSpec, tree_fit
from stayline.operators.models.trainer import TrainedModel, fit, placed
from stayline.operators.models.trees import MISSING, NODE, Rule, Tree, grow, rebased, split_of
from stayline.operators.splits import fold_of
from stayline.operators.tuning import grid_search


def table(spark, n=700, classes=False, nulls=False):
    rng = np.random.default_rng(4)
    x = np.c_[rng.integers(0, 12, n), rng.integers(0, 7, n), rng.normal(0, 1, n).round(1)].astype(float)
    y = x[:, 0] / 3 + np.sin(x[:, 1]) + rng.normal(0, 0.5, n).round(2)
    if nulls:
        x[rng.random(x.shape) < 0.2] = np.nan
        y = np.where(np.isnan(x[:, 1]), y + 3, y)
    y = (y > 2).astype(float) if classes else np.abs(y)
    df = spark.createDataFrame([(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))], "k long, a double, b double, c double, label double")
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features", handleInvalid="keep").transform(df).select("k", "label", "features").persist(), x, y


def folded(data, k=3):
    return data.withColumn(FOLD, fold_of(F.col("k"), k, 42))


def predictions(model, data):
    return np.array([r["prediction"] for r in model.predict(data, "k").orderBy("k").collect()])


def best_by_hand(bins, a, b, rule):
    best, whole_a, whole_b = (0, -1, 0, False), a.sum(), b.sum()
    own = rule.score(whole_a, whole_b)
    for j in range(bins.shape[1]):
        v = bins[:, j]
        for t in sorted(set(v[v != MISSING].tolist())):
            for goes_left in (False, True):
                left = np.where(v == MISSING, goes_left, v <= t)
                if left.all() or not left.any() or goes_left and not (v == MISSING).any():
                    continue
                h = b[left].sum()
                if min(h, whole_b - h) < rule.min_child_weight:
                    continue
                gain = rule.score(a[left].sum(), h) + rule.score(whole_a - a[left].sum(), whole_b - h) - own
                if gain > best[0] + 1e-9:
                    best = (gain, j, t, goes_left)
    return best[1:]


@pytest.mark.parametrize("weight", [0.0, 1.0, 3.0, 8.0])
def test_both_ways_find_the_best_split(weight):
    for s in range(25):
        rng = np.random.default_rng(s)
        bins = rng.integers(0, 6, (60, 3)).astype(np.uint8)
        bins[rng.random((60, 3)) < 0.2] = MISSING
        a, b = rng.normal(0, 1, 60) + bins[:, 1] * 0.01, rng.random(60) + 0.2
        rule = Rule("newton", 1, 1.0, weight)
        node = grow(bins, a, b, rule, np.arange(3), (1, 1), 1)[0]
        want = best_by_hand(bins, a, b, rule)
        assert (node["feature"], node["bound"], bool(node["left_missing"])) == want
        offsets = np.array([0, 7, 14, 21])
        code = (np.where(bins == MISSING, 6, bins) + offsets[:3]).ravel()
        sums = [np.bincount(code, w, 21) for w in (None, np.repeat(a, 3), np.repeat(b, 3))]
        found, left = split_of(sums[0], sums[1], sums[2], offsets, rule, np.arange(3), (1, 1), 1, 1)
        assert (found["feature"][0], found["bound"][0], bool(found["left_missing"][0])) == want
        v = bins[:, want[0]]
        assert left == np.where(v == MISSING, want[2], v <= want[1]).sum()


def test_heap_numbers_below_a_node():
    assert rebased(np.array([5, 10, 11, 20, 23]), 5).tolist() == [1, 2, 3, 4, 7]
    top = 1 << 40 | 3
    assert rebased(np.array([top, 2 * top + 1, 8 * top + 6]), top).tolist() == [1, 3, 14]


def test_a_tree_read_less_deep_is_the_tree_grown_less_deep():
    rng = np.random.default_rng(0)
    bins, w = rng.integers(0, 9, (500, 4)).astype(np.uint8), rng.integers(1, 4, 500).astype(float)
    y = bins[:, 0] + rng.normal(0, 1, 500)
    tree = Tree(grow(bins, w * y, w, Rule("mean", 60), np.arange(4), (1, 1), 3), Rule("mean"))
    depths, splits = [2, 5, 60], [2, 30]
    read = tree.variants(bins, depths, splits)
    for j, depth in enumerate(depths):
        for i, least in enumerate(splits):
            own = Tree(grow(bins, w * y, w, Rule("mean", depth, min_split=least), np.arange(4), (1, 1), 3), Rule("mean"))
            assert np.allclose(read[:, j, i], own.value[own.leaves(bins)])


@pytest.mark.parametrize("spec", [
    ModelSpec("random_forest", {"n_estimators": 4}), ModelSpec("random_forest", {"n_estimators": 3, "max_depth": 3, "min_samples_leaf": 4}),
    ModelSpec("random_forest_classifier", {"n_estimators": 4, "class_weight": "balanced_subsample", "criterion": "entropy"}),
    ModelSpec("xgboost", {"n_estimators": 5, "max_depth": 4, "subsample": 0.8}), ModelSpec("xgboost_poisson", {"n_estimators": 4, "colsample_bytree": 0.7})])
def test_large_nodes_split_by_sums_give_the_same_model(spark, monkeypatch, spec):
    data, _, _ = table(spark, classes=spec.is_classifier, nulls=True)
    handed = predictions(fit(spec, data), data)
    monkeypatch.setattr(ensembles, "CELLS", 150)
    monkeypatch.setattr(ensembles, "LEAST_ROWS", 40)
    monkeypatch.setattr(ensembles, "SUMS_BYTES", 3000)
    monkeypatch.setattr(ensembles, "BLOCK_ROWS", 64)
    assert np.allclose(predictions(fit(spec, data), data), handed)


def test_one_round_learns_the_side_of_missing_values(spark):
    data, x, y = table(spark, nulls=True)
    model = fit(ModelSpec("xgboost", {"n_estimators": 1, "max_depth": 1, "learning_rate": 1.0}), data)
    g = y.mean() - y
    best = None
    for j in range(3):
        known = np.unique(x[~np.isnan(x[:, j]), j])
        for t in known:
            for side in (False, True):
                left = np.where(np.isnan(x[:, j]), side, x[:, j] <= t)
                if left.any() and not left.all():
                    gain = sum(g[s].sum() ** 2 / (s.sum() + 1) for s in (left, ~left))
                    if best is None or gain > best[0] + 1e-9:
                        best = (gain, left)
    want = y.mean() + np.where(best[1], *(-g[s].sum() / (s.sum() + 1) for s in (best[1], ~best[1])))
    assert np.allclose(predictions(model, data), want)


def test_a_tree_uses_only_the_features_of_its_round(spark):
    data, _, _ = table(spark)
    binned = Binned(data)
    own = tree_fit(ModelSpec("xgboost", {"n_estimators": 12, "colsample_bytree": 0.4}), 3)
    trees = boost(binned, [own])[0][0]
    used = [set(t.feature[t.feature >= 0].tolist()) for t in trees]
    assert all(len(u) <= 1 for u in used) and len(set().union(*used)) > 1
    binned.release()


@pytest.mark.parametrize("weight", [1.0, 5.0, 60.0])
def test_both_children_have_their_hessian(spark, weight):
    data, _, y = table(spark)
    model = fit(ModelSpec("xgboost_poisson", {"n_estimators": 1, "max_depth": 6, "min_child_weight": weight}), data).model
    bins = ensembles.to_bins(np.array([r["x"] for r in data.orderBy("k").select(vector_to_array("features").alias("x")).collect()]), model.cuts)
    at = model.trees[0].leaves(bins)
    sums = [y.mean() * (at == leaf).sum() for leaf in np.unique(at)]
    assert min(sums) >= weight - 1e-6 and len(sums) > 2


def test_weights_of_each_bootstrap_sample_differ_from_those_of_all_rows(spark):
    data, _, _ = table(spark, classes=True)
    found = [np.array([r["score"] for r in fit(ModelSpec("random_forest_classifier", {"n_estimators": 3, "max_depth": 2, "class_weight": c}), data).predict(data, "k").orderBy("k").collect()])
             for c in ("balanced", "balanced_subsample", None)]
    assert 0 < np.abs(found[0] - found[1]).max() < 0.2 < np.abs(found[0] - found[2]).max() + 0.2
    binned = Binned(data)
    own = tree_fit(ModelSpec("random_forest_classifier", {"n_estimators": 1, "max_depth": 1, "class_weight": "balanced_subsample"}), 3)
    tree = ensembles.forest(binned, own)[0]
    assert tree.value[0] == pytest.approx(0.5)          # both classes weigh the same in the sample
    binned.release()


def fold_rmse(spec, data, k=3):
    tagged, out = folded(data, k), []
    for f in range(k):
        model = fit(spec, tagged.where(F.col(FOLD) != f).drop(FOLD))
        pred = model.predict(tagged.where(F.col(FOLD) == f).drop(FOLD), "k", clip=False)
        out.append(math.sqrt(pred.select(F.avg((F.col("label") - F.col("prediction")) ** 2)).first()[0]))
    return -sum(out) / k


@pytest.mark.parametrize("kind", ["xgboost", "xgboost_poisson"])
def test_the_score_of_a_shorter_fit_is_that_of_its_own_fit(spark, kind):
    data, _, _ = table(spark)
    fixed = {"max_depth": 3, "learning_rate": 0.2}
    found = dict((p["n_estimators"], s) for p, s in grid_search(kind, data, data, "k", {"n_estimators": [4, 9], **{k: [v] for k, v in fixed.items()}}, folds=3).cv)
    for n in (4, 9):
        # bins of a fold's own rows can differ from those of all rows by a bound between two values
        assert found[n] == pytest.approx(fold_rmse(ModelSpec(kind, {"n_estimators": n, **fixed}), data), abs=0.02)
    binned = Binned(folded(data))
    fits = [tree_fit(ModelSpec(kind, {"n_estimators": n, **fixed}), 3, 1) for n in (4, 9)]
    _, long = boost(binned, fits[1:], (4, 9))
    _, short = boost(binned, fits[:1], (4,))
    assert long[0, 4] == short[0, 4] and long[0, 9] != short[0, 4]
    binned.release()


@pytest.mark.parametrize("small_nodes", [False, True])
def test_truncated_scores_are_those_of_forests_grown_so(spark, monkeypatch, small_nodes):
    data, _, _ = table(spark, nulls=True)
    if small_nodes:
        monkeypatch.setattr(ensembles, "CELLS", 150)
        monkeypatch.setattr(ensembles, "LEAST_ROWS", 60)
    monkeypatch.setattr(ensembles, "BLOCK_ROWS", 100)
    binned = Binned(folded(data))
    spec = lambda n, d, s: tree_fit(ModelSpec("random_forest", {"n_estimators": n, "max_depth": d, "min_samples_split": s}), 3, 1)
    depths, splits, sizes = [2, 4, 60], [2, 25], [2, 5]
    rows = {tuple(r[:3]): r["e"] for r in forest_scores(binned, [spec(5, None, 2)], depths, splits, sizes).groupBy("trees", "depth", "split").agg(
        F.avg((F.col("y") - F.col("score")) ** 2).alias("e")).collect()}
    assert len(rows) == 12
    for i, n in enumerate(sizes):
        for j, d in enumerate(depths):
            for m, s in enumerate(splits):
                alone = forest_scores(binned, [spec(n, None if d == 60 else d, s)], [60], [2], [n]).agg(F.avg((F.col("y") - F.col("score")) ** 2), F.count(F.lit(1))).first()
                assert rows[i, j, m] == pytest.approx(alone[0], rel=1e-9) and alone[1] == binned.folds[1][0]
    binned.release()


def test_a_search_of_forests_and_classifiers(spark):
    data, _, _ = table(spark)
    found = grid_search("random_forest", data, data, "k", {"n_estimators": [3, 6], "max_depth": [2, None], "min_samples_split": [2, 40]}, folds=3)
    assert len({s for _, s in found.cv}) == 6 and found.best_params == max(found.cv, key=lambda x: x[1])[0]
    labelled, _, _ = table(spark, classes=True)
    found = grid_search("random_forest_classifier", labelled, labelled, "k", {"n_estimators": [3, 6], "max_depth": [2, None], "class_weight": ["balanced"], "criterion": ["gini", "entropy"]}, folds=2)
    assert len(found.cv) == 8 and all(0.6 < s <= 1 for _, s in found.cv)


def test_more_values_than_bins(spark):
    data, x, y = table(spark, 3000)
    wide = data.select("k", "label", F.col("features"))
    model = fit(ModelSpec("random_forest", {"n_estimators": 3, "max_bins": 4}), wide).model
    assert [len(c) for c in model.cuts] == [3, 3, 3] or max(len(c) for c in model.cuts) <= 3
    full = fit(ModelSpec("random_forest", {"n_estimators": 3}), wide).model
    assert [len(c) for c in full.cuts] == [len(np.unique(x[:, j])) - 1 for j in range(3)]


def test_rows_that_repeat_are_sampled_apart(spark):
    data, _, _ = table(spark, 40)
    many = data.where("k < 4").crossJoin(spark.range(100)).select(*data.columns)
    binned = Binned(many)
    seen = [np.frombuffer(r["u"], np.uint64) for r in binned.blocks.select("u").collect()]
    assert len(np.unique(np.concatenate(seen))) == 400
    binned.release()


def test_area_of_every_group_is_that_of_the_group(spark):
    rows = spark.range(4000).select((F.col("id") % 3).cast("string").alias("g"), (F.col("id") % 7 % 2).cast("double").alias("y"), ((F.col("id") * 37) % 101 % 20).cast("double").alias("s"))
    rows = rows.unionAll(spark.createDataFrame([("one class", 1.0, 0.3)], "g string, y double, s double"))
    found = {r["g"]: r["auc"] for r in roc_auc_by(rows, "g", "y", "s").collect()}
    for g in ("0", "1", "2"):
        assert found[g] == pytest.approx(roc_auc(rows.where(F.col("g") == g), "y", "s").first()["auc"])
    assert found["one class"] is None


def newton_points(spark, problems, n=500):
    data, x, y = table(spark, n, classes=True)
    rows = newton.Rows(placed(folded(data).select(FOLD, *data.columns)))
    newton.solve(rows, problems)
    fold = np.array([r[0] for r in folded(data).orderBy("k").select(FOLD).collect()])
    return rows, x, y, fold


@pytest.mark.parametrize("ratio, C, balance", [(0.0, 1.0, False), (0.0, 0.01, True), (1.0, 0.1, False), (0.5, 10.0, True)])
def test_newton_steps_reach_the_optimum(spark, ratio, C, balance):
    problem = newton.Problem(C, ratio, 1, balance)
    _, x, y, fold = newton_points(spark, [problem])
    b, own = problem.path[-1], fold != 1
    x1, t = np.c_[np.ones(own.sum()), x[own]], y[own]
    w = np.where(t == 1, len(t) / 2 / t.sum(), len(t) / 2 / (1 - t).sum()) if balance else np.ones(len(t))
    slope = x1.T @ (w * (1 / (1 + np.exp(-x1 @ b)) - t)) + np.r_[0, (1 - ratio) / C * b[1:]]
    # at the optimum: no slope, or for a zero coefficient one within the l1 bound
    assert abs(slope[0]) < 1e-5
    for s, c in zip(slope[1:], b[1:]):
        assert abs(s + ratio / C * np.sign(c)) < 1e-5 if c else abs(s) <= ratio / C + 1e-5
    assert len(problem.path) < 30


def test_problems_together_are_problems_alone(spark):
    many = [newton.Problem(C, r, f) for C in (0.1, 1.0) for r in (0.0, 1.0) for f in (0, 1)]
    newton_points(spark, many)
    alone = newton.Problem(0.1, 1.0, 1)
    newton_points(spark, [alone])
    assert np.allclose(many[3].path[-1], alone.path[-1], atol=1e-7)
    assert NODE.itemsize


@pytest.mark.parametrize("kind", ["random_forest", "random_forest_classifier"])
@pytest.mark.parametrize("small_nodes", [False, True])
def test_a_forest_kept_as_a_table_is_the_collected_one(spark, monkeypatch, tmp_path, kind, small_nodes):
    data, _, _ = table(spark, classes=kind != "random_forest", nulls=True)
    if small_nodes:
        monkeypatch.setattr(ensembles, "CELLS", 150)
        monkeypatch.setattr(ensembles, "LEAST_ROWS", 40)
    monkeypatch.setattr(ensembles, "BLOCK_ROWS", 64)
    spec = ModelSpec(kind, {"n_estimators": 4})
    held = fit(spec, data)
    assert held.model.table is None and len(held.model.trees) == 4
    monkeypatch.setattr(ensembles, "FOREST_NODES", 10)
    kept = fit(spec, data)
    assert not kept.model.trees
    assert predictions(kept, data).tolist() == predictions(held, data).tolist()
    kept.save(str(tmp_path / "m"))
    twice = data.unionAll(data.where("k < 5")).withColumn("k", F.when(F.col("k") > 3, F.col("k")))
    rows = lambda m: sorted(map(str, m.predict(twice, "k").collect()))
    assert rows(TrainedModel.load(spark, str(tmp_path / "m"))) == rows(held)


def test_the_l1_step_ends_with_the_exact_solution_of_its_signs():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 12))
    x[:, 1:6] = x[:, :1] + 2e-4 * x[:, 1:6]            # nearly equal columns, on which single coordinates creep
    h, g, b = x.T @ x, x.T @ rng.normal(size=400), rng.normal(size=12) * (rng.random(12) < 0.5)
    for l1, l2 in ((2.0, 0.0), (0.5, 0.5)):
        d = newton.descend(g, h, b, l1, l2)
        at = b + d
        slope = g + h @ d + np.r_[0.0, l2 * at[1:]]
        assert abs(slope[0]) < 1e-7
        assert all(abs(s + l1 * np.sign(c)) < 1e-7 if c else abs(s) <= l1 + 1e-7 for s, c in zip(slope[1:], at[1:]))
        signs = np.sign(at) * (np.abs(at) > 0)
        assert np.allclose(newton.with_signs(g, h, b, signs, l1, l2), d, atol=1e-6)
        assert newton.with_signs(g, h, b, -signs, l1, l2) is None


@pytest.mark.parametrize("kind", ["xgboost", "xgboost_poisson"])
def test_all_rounds_of_small_tables_take_a_few_jobs(spark, monkeypatch, kind):
    data, _, _ = table(spark, 900, nulls=True)
    binned = Binned(folded(data))
    fits = lambda: [tree_fit(ModelSpec(kind, {"n_estimators": 12, "max_depth": d, "subsample": s, "colsample_bytree": 0.7}), 3, f) for d, s in ((3, 0.8), (5, 1.0)) for f in range(3)]
    spark.sparkContext.setJobGroup(f"rounds of {kind}", "")
    trees, scores = boost(binned, fits(), (5, 12))
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"rounds of {kind}"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs < 12
    monkeypatch.setattr(ensembles, "WHOLE", 0)
    others, known = boost(binned, fits(), (5, 12))
    assert scores.keys() == known.keys()
    assert all(scores[k] == pytest.approx(known[k], rel=1e-9) for k in known)
    for own, other in zip(trees, others):
        assert [t.ids.tolist() for t in own] == [t.ids.tolist() for t in other]
        assert all(np.allclose(t.value, o.value) for t, o in zip(own, other))
    binned.release()


@pytest.mark.parametrize("kind", ["random_forest", "random_forest_classifier"])
def test_trees_dealt_to_tasks_that_read_all_rows_are_those_of_shuffled_rows(spark, monkeypatch, kind):
    data, _, _ = table(spark, 600, classes=kind.endswith("classifier"), nulls=True)
    binned = Binned(folded(data))
    monkeypatch.setattr(ensembles, "CHUNK", 2)
    monkeypatch.setattr(ensembles, "REST_ROWS", 50)
    own = {"class_weight": "balanced_subsample"} if kind.endswith("classifier") else {}
    fits = lambda: [tree_fit(ModelSpec(kind, {"n_estimators": 7, "min_samples_leaf": 2, **own}), 3, f) for f in range(3)]
    point = ["fit", "trees", "depth", "split"]
    found = lambda: {tuple(r[:4]): tuple(r[4:]) for r in forest_scores(binned, fits(), [3, 60], [2, 6], [3, 7]).groupBy(*point).agg(
        F.count(F.lit(1)), F.sum("y"), F.sum("score"), F.sum(F.col("score") * F.col("y"))).collect()}
    dealt = found()
    assert len(dealt) == 3 * 2 * 2 * 2
    monkeypatch.setattr(ensembles, "WHOLE", 0)
    shuffled = found()
    assert dealt.keys() == shuffled.keys()
    assert all(dealt[k] == pytest.approx(shuffled[k], rel=1e-9) for k in dealt)
    binned.release()


def test_of_two_children_only_the_smaller_one_is_summed(monkeypatch):
    from stayline.operators.models import trees
    rng = np.random.default_rng(8)
    bins, a, seen, sums = rng.integers(0, 9, (4000, 3)).astype(np.uint8), rng.normal(0, 1, 4000), [], trees.level_sums
    monkeypatch.setattr(trees, "level_sums", lambda own, a, b, rows, *rest: seen.append(len(own[0]) if rows is None else len(rows)) or sums(own, a, b, rows, *rest))
    nodes = grow(bins, a, np.ones(4000), Rule("newton", 4, reg_lambda=1.0), np.arange(3), (1.0, 1.0), 1)
    assert seen[0] == 4000 and all(n <= 2000 for n in seen[1:]) and len(seen) == 4
    tree = Tree(nodes, Rule("newton", 4, reg_lambda=1.0))
    at = tree.leaves(bins)
    assert all(math.isclose(tree.value[k], -a[at == k].sum() / ((at == k).sum() + 1), rel_tol=1e-9) for k in np.unique(at))
    assert (tree.moved(bins.ravel(), np.arange(4000) * 3) == tree.value[at]).all()


@pytest.mark.parametrize("whole", [True, False])
def test_sums_of_features_counted_together_are_those_of_each(monkeypatch, whole):
    from stayline.operators.models import trees
    monkeypatch.setattr(trees, "MANY_ROWS", 900)
    monkeypatch.setattr(trees, "SOME_ROWS", 300)
    monkeypatch.setattr(trees, "SOME_CELLS", 60)
    rng = np.random.default_rng(2)
    bins = np.stack([rng.integers(0, w, 3000) for w in (4, 30, 2, 5, 9)], 1).astype(np.uint8)
    bins[rng.random(bins.shape) < 0.1] = MISSING
    bins[:, 2] = MISSING
    a, b = (rng.integers(0, 5, 3000).astype(float), rng.integers(1, 4, 3000).astype(float)) if whole else (rng.normal(0, 1, 3000), rng.random(3000) + 0.1)
    lay, rows, sizes, calls, count = trees.Layout(bins), rng.permutation(3000)[:2100], [1000, 400, 40, 500, 160], [], np.bincount
    weights = trees.Weights(a, b, rows, b[rows], Rule("mean"))
    monkeypatch.setattr(trees.np, "bincount", lambda x, *rest, **kw: calls.append(len(x)) or count(x, *rest, **kw))
    n, found_a, found_b = weights.read(trees.level_sums(lay.own, a, b, rows, lay, sizes, weights))
    assert sum(calls) < (1 if whole else 2) * 5 * 2100                  # not every feature for itself
    for k, mine in enumerate(np.split(rows, np.cumsum(sizes)[:-1])):
        for j in range(5):
            code = np.where(bins[mine, j] == MISSING, lay.widths[j], bins[mine, j])
            want = [count(code, w, lay.widths[j] + 1)[:len(lay.cells[j])] for w in (None, a[mine], b[mine])]
            assert ((n[k, lay.cells[j]] > 0) == (want[0] > 0)).all()
            assert np.allclose(found_a[k, lay.cells[j]], want[1], atol=1e-9) and np.allclose(found_b[k, lay.cells[j]], want[2], atol=1e-9)


@pytest.mark.parametrize("rule", [Rule("newton", 5, reg_lambda=1.0), Rule("mean", 60), Rule("gini", 60, features=2)])
def test_growing_gives_each_row_its_value(rule):
    from stayline.operators.models import trees
    rng = np.random.default_rng(6)
    bins = rng.integers(0, 12, (5000, 4)).astype(np.uint8)
    bins[rng.random(bins.shape) < 0.1] = MISSING
    y, rows, values = (bins[:, 0] + rng.normal(0, 2, 5000) > 6).astype(float), np.flatnonzero(rng.random(5000) < 0.7), np.full(5000, np.nan)
    a, b = (0.4 - y, 0.3 + rng.random(5000)) if rule.kind == "newton" else (y, np.ones(5000)) if rule.kind == "mean" else (y, 1 - y)
    nodes = trees.grow_laid(trees.Layout(bins), rows, a, b, rule, np.arange(4), (1.0, 1.0), 5, values=values)
    assert nodes.tolist() and sorted(nodes["id"].tolist()) == sorted(grow(bins[rows], a[rows], b[rows], rule, np.arange(4), (1.0, 1.0), 5)["id"].tolist())
    tree = Tree(nodes, rule)
    assert np.allclose(values[rows], tree.value[tree.leaves(bins[rows])]) and np.isnan(np.delete(values, rows)).all()


def test_the_deepest_leaves_of_large_nodes_take_no_pass(spark, monkeypatch):
    data, _, _ = table(spark, nulls=True)
    binned, fits = Binned(data), lambda: [tree_fit(ModelSpec("xgboost", {"n_estimators": 2, "max_depth": 2, "min_child_weight": 60}), 3)]
    want, asked, split_nodes = boost(binned, fits())[0][0], [], ensembles.Growth.split_nodes
    monkeypatch.setattr(ensembles, "WHOLE", 0)
    monkeypatch.setattr(ensembles, "CELLS", 30)
    monkeypatch.setattr(ensembles, "LEAST_ROWS", 10)
    monkeypatch.setattr(ensembles.Growth, "split_nodes", lambda self, blocks, todo: asked.append(max(node for _, node in todo)) or split_nodes(self, blocks, todo))
    found = boost(binned, fits())[0][0]
    assert asked and max(asked) < 4
    assert all(a.ids.tolist() == b.ids.tolist() and np.allclose(a.value, b.value) for a, b in zip(found, want))
    binned.release()
