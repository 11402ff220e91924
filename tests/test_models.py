import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from stayline.operators.models.estimators import ModelSpec
from stayline.operators.models.iforest import IsolationForest, IsolationForestModel, run_isolation_forest
from stayline.operators.models.poisson_boost import PoissonBoostRegressor, poisson_deviance
from stayline.operators.models.trainer import TrainedModel, fit


@pytest.fixture(scope="module")
def linear_data(spark):
    rng = np.random.default_rng(11)
    X = rng.normal(0, 1, (400, 3)) * [1.0, 2.0, 0.5]
    y = 1.5 + X @ np.array([2.0, -1.0, 0.3]) + rng.normal(0, 0.5, 400)
    rows = [(i, float(a), float(b), float(c), float(t)) for i, ((a, b, c), t) in enumerate(zip(X, y))]
    df = spark.createDataFrame(rows, "k long, a double, b double, c double, label double")
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df).persist(), X, y


def _centered(X, y):
    return X - X.mean(0), y - y.mean()


def test_ols_matches_least_squares(linear_data):
    df, X, y = linear_data
    m = fit(ModelSpec("linear"), df).model
    A = np.c_[np.ones(len(y)), X]
    beta = np.linalg.lstsq(A, y, rcond=None)[0]
    assert np.allclose(m.coefficients.toArray(), beta[1:], atol=1e-9)
    assert m.intercept == pytest.approx(beta[0], abs=1e-9)


def test_ridge_matches_closed_form(linear_data):
    df, X, y = linear_data
    for alpha in (1.0, 50.0):
        m = fit(ModelSpec("ridge", {"alpha": alpha}), df).model
        Xc, yc = _centered(X, y)
        w = np.linalg.solve(Xc.T @ Xc + alpha * np.eye(3), Xc.T @ yc)
        assert np.allclose(m.coefficients.toArray(), w, atol=1e-6)


def _lasso_cd(X, y, alpha, iters=5000):
    Xc, yc = _centered(X, y)
    n = len(y)
    w = np.zeros(X.shape[1])
    for _ in range(iters):
        for j in range(len(w)):
            r = yc - Xc @ w + Xc[:, j] * w[j]
            rho = Xc[:, j] @ r / n
            z = Xc[:, j] @ Xc[:, j] / n
            w[j] = np.sign(rho) * max(abs(rho) - alpha, 0) / z
    return w


def test_lasso_matches_coordinate_descent(linear_data):
    df, X, y = linear_data
    for alpha in (0.1, 1.0):
        m = fit(ModelSpec("lasso", {"alpha": alpha}), df).model
        assert np.allclose(m.coefficients.toArray(), _lasso_cd(X, y, alpha), atol=1e-5)


def test_logistic_matches_newton(spark):
    rng = np.random.default_rng(2)
    X = rng.normal(0, 1, (400, 2))
    p = 1 / (1 + np.exp(-(0.5 + X @ np.array([1.5, -2.0]))))
    y = (rng.uniform(size=400) < p).astype(float)
    df = spark.createDataFrame([(i, float(a), float(b), float(t)) for i, ((a, b), t) in enumerate(zip(X, y))],
                               "k long, a double, b double, label double")
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    C = 1.0
    m = fit(ModelSpec("logistic", {"C": C, "max_iter": 500}), df).model
    # Newton on 0.5||w||^2 + C * sum(logloss), intercept unpenalised.
    A = np.c_[np.ones(400), X]
    w = np.zeros(3)
    for _ in range(50):
        q = 1 / (1 + np.exp(-A @ w))
        reg = np.r_[0.0, w[1:]]
        g = C * A.T @ (q - y) + reg
        H = C * (A.T * (q * (1 - q))) @ A + np.diag([0.0, 1.0, 1.0])
        w -= np.linalg.solve(H, g)
    assert np.allclose(m.coefficients.toArray(), w[1:], atol=1e-4)
    assert m.intercept == pytest.approx(w[0], abs=1e-4)


def test_trees_beat_mean_predictor(linear_data):
    df, X, y = linear_data
    base = np.sqrt(np.mean((y - y.mean()) ** 2))
    for spec in (ModelSpec("random_forest", {"n_estimators": 20, "max_depth": 6}),
                 ModelSpec("xgboost", {"n_estimators": 20})):
        pred = fit(spec, df).predict(df, "k")
        rmse = pred.select(F.sqrt(F.avg((F.col("label") - F.col("prediction")) ** 2))).first()[0]
        assert rmse < 0.7 * base


def test_poisson_boost_lowers_deviance(spark):
    rng = np.random.default_rng(0)
    x = rng.uniform(-2, 2, 400)
    cnt = rng.poisson(np.exp(0.5 * x))
    df = spark.createDataFrame([(i, float(a), float(c)) for i, (a, c) in enumerate(zip(x, cnt))],
                               "k long, x double, label double")
    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    model = PoissonBoostRegressor(n_estimators=8, max_depth=3, key="k").fit(df)
    dev = poisson_deviance(model.transform(df))
    mean_dev = poisson_deviance(df.withColumn("prediction", F.lit(float(cnt.mean()))))
    assert dev < 0.8 * mean_dev
    with pytest.raises(ValueError):
        PoissonBoostRegressor(n_estimators=1, key="k").fit(df.withColumn("label", F.lit(-1.0)))


def test_isolation_forest_ranks_planted_anomalies_first(spark):
    rng = np.random.default_rng(1)
    pts = np.vstack([rng.normal(0, 1, (990, 3)), rng.uniform(6, 9, (10, 3)) * rng.choice([-1, 1], (10, 3))])
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(pts)], "k long, a double, b double, c double")
    df = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)
    out = run_isolation_forest(df, "k", n_estimators=50)
    top = {r["k"] for r in out.orderBy("anomaly_score").limit(10).collect()}
    assert top == set(range(990, 1000))
    assert {r["anomaly"] for r in out.select("anomaly").distinct().collect()} <= {-1, 1}


def test_model_save_load_roundtrip(spark, linear_data, tmp_path):
    df, _, _ = linear_data
    m = fit(ModelSpec("ridge", {"alpha": 1.0}), df, ["a", "b", "c"])
    m.save(str(tmp_path / "m"))
    back = TrainedModel.load(spark, str(tmp_path / "m"))
    a = {r["k"]: r["prediction"] for r in m.predict(df, "k").collect()}
    b = {r["k"]: r["prediction"] for r in back.predict(df, "k").collect()}
    assert a == b and back.feature_names == ["a", "b", "c"]


def _mixed(spark, n=1500):
    df = spark.range(n).select(F.col("id").alias("k"), ((F.col("id") * 37) % 101).cast("double").alias("a"), ((F.col("id") * 53) % 17).cast("double").alias("b"))
    df = df.withColumn("label", F.floor(F.col("a") / 20 + F.col("b") / 4 + (F.col("k") % 3)).cast("double"))
    return VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)


@pytest.mark.parametrize("spec", [
    ModelSpec("random_forest", {"n_estimators": 5, "max_depth": 6}),
    ModelSpec("xgboost_poisson", {"n_estimators": 4, "max_depth": 3, "subsample": 0.8, "colsample_bytree": 0.5}),
    ModelSpec("random_forest_classifier", {"n_estimators": 5, "max_depth": 6, "class_weight": "balanced"})])
def test_fits_do_not_depend_on_the_partitions(spark, spec):
    data = _mixed(spark)
    if spec.is_classifier:
        data = data.withColumn("label", (F.col("label") > 5).cast("double"))
    found = []
    for parts in (2, 5, 13):
        pred = fit(spec, data.repartition(parts)).predict(data, "k")
        found.append(sorted(tuple(r) for r in pred.collect()))
    assert found[0] == found[1] == found[2]


def test_isolation_forest_does_not_depend_on_the_partitions_and_is_saved(spark, tmp_path):
    data = _mixed(spark)
    model = IsolationForest(n_estimators=10, contamination=0.1, key="k").fit(data.repartition(2))
    rows = lambda m: sorted(tuple(r) for r in m.transform(data).select("k", "anomaly_score", "anomaly").collect())
    first = rows(model)
    assert rows(IsolationForest(n_estimators=10, contamination=0.1, key="k").fit(data.repartition(13))) == first
    model.save(spark, str(tmp_path / "forest"))
    loaded = IsolationForestModel.load(spark, str(tmp_path / "forest"))
    assert rows(loaded) == first
    assert sorted(tuple(r) for r in run_isolation_forest(data, "k", model=loaded).select("k", "anomaly_score", "anomaly").collect()) == first


def test_isolation_forest_of_repeated_rows_and_keys(spark):
    data = _mixed(spark, 600)
    anomalies = data.limit(1).select("k", "label", "features")
    for doubled in (data.unionAll(data), data.withColumn("k", F.col("k") % 9)):
        model = IsolationForest(n_estimators=20, key="k").fit(doubled)
        assert len(model.trees) == 20 and model.psi == 256
        sizes = [sum(t["feature"] < 0) for t in model.trees]
        assert min(sizes) > 20
        assert model.transform(anomalies).count() == 1
    one = IsolationForest(n_estimators=5, key="k").fit(data.limit(1).unionAll(data.limit(1)).unionAll(data.limit(1)))
    assert one.psi == 3 and all(len(t["feature"]) == 1 for t in one.trees)


def test_isolation_sample_takes_every_copy_with_equal_chance(spark):
    data = _mixed(spark, 300)
    many = data.where("k = 5").crossJoin(spark.range(300)).select(*data.columns).unionAll(data)      # half of the rows are one row
    forest = IsolationForest(n_estimators=200, key="k", max_samples=30)
    own = data.where("k = 5").first()["features"].toArray().tolist()
    found = forest.sample(many.repartition(3), "features", 600, 30, 0.05)
    share = found.where(F.col("x") == F.array(*map(F.lit, own))).count() / found.count()
    assert 0.4 < share < 0.6


def test_poisson_one_stump_in_closed_form(spark):
    """One round at depth 1: best split by Newton gain, clipped leaf steps."""
    x = [0.0, 1.0, 2.0, 3.0, 4.0, 5.0] * 5
    y = [0.0, 1.0, 0.0, 4.0, 5.0, 6.0] * 5
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(zip(x, y))], "k long, x double, label double")
    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    model = PoissonBoostRegressor(n_estimators=1, max_depth=1, learning_rate=0.5, key="k").fit(df)
    x, y = np.array(x), np.array(y)
    mu = y.mean()

    def parts(t):
        return [((y - mu)[side].sum(), mu * side.sum()) for side in (x <= t, x > t)]
    best = max((0.5, 1.5, 2.5, 3.5, 4.5), key=lambda t: sum(g * g / h for g, h in parts(t)))
    step = [0.5 * np.clip(g / (h + 1.0), -0.7, 0.7) for g, h in parts(best)]
    want = mu * np.exp(np.where(x <= best, step[0], step[1]))
    got = [r["prediction"] for r in model.transform(df).orderBy("k").collect()]
    assert np.allclose(got, want)


def test_poisson_scores_as_its_trees_and_is_saved(spark, tmp_path):
    data = _mixed(spark, 600)
    model = fit(ModelSpec("xgboost_poisson", {"n_estimators": 12, "max_depth": 3}), data)
    before = sorted(tuple(r) for r in model.predict(data, "k").collect())
    model.save(str(tmp_path / "m"))
    assert sorted(tuple(r) for r in TrainedModel.load(spark, str(tmp_path / "m")).predict(data, "k").collect()) == before


def test_random_forest_classifier_finds_the_rule(spark):
    data = _mixed(spark).withColumn("label", (F.col("label") > 5).cast("double"))
    pred = fit(ModelSpec("random_forest_classifier", {"n_estimators": 20}), data).predict(data, "k")
    assert pred.where("label = prediction").count() > 0.9 * pred.count()


def test_unknown_parameters_and_depths_raise(spark):
    data = _mixed(spark, 50)
    for spec in (ModelSpec("ridge", {"alfa": 1.0}), ModelSpec("random_forest", {"max_depth": 31}), ModelSpec("xgboost_poisson", {"gamma": 1}),
                 ModelSpec("logistic", {"penalty": "l3"}), ModelSpec("nothing")):
        with pytest.raises(ValueError):
            fit(spec, data.withColumn("label", (F.col("label") > 3).cast("double")))
