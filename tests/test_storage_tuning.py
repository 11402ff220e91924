import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from stayline.config import STAYS
from stayline.operators.models.estimators import ModelSpec
from stayline.operators.models.trainer import TrainedModel, fit, placed
from stayline.operators.tuning import GRIDS, combos, grid_search, tuning_rows
from stayline.plans.datasets import prepare
from stayline.plans.flows import family_data, flow_no_split, train_evaluate_classifier
from stayline.sources import storage as S
from stayline.sources.fixtures import stays

from conftest import SF0001


def test_write_and_load_families(spark, tmp_path):
    prep = prepare(stays(spark, SF0001), STAYS)
    path = str(tmp_path / "ds")
    S.write_datasets(prep.data, path)
    train, test = S.load_family(spark, path, "class", STAYS)
    assert "is_outlier" in train.columns and STAYS.target not in train.columns
    assert train.count() + test.count() == 1000
    train, test = S.load_family(spark, path, "outlier", STAYS)
    assert train.count() + test.count() == 23
    with pytest.raises(FileNotFoundError):
        S.load_family(spark, str(tmp_path / "missing"), "class", STAYS)
    prep.release()


def test_missing_csv_raises(spark, tmp_path):
    from pyspark.errors import AnalysisException
    with pytest.raises(AnalysisException):
        S.read_spells_csv(spark, str(tmp_path / "nope.csv")).count()


def test_grid_search_picks_best_cv_score(spark):
    df = spark.range(0, 600).select(F.col("id").alias("k"), (F.col("id") % 17).cast("double").alias("a"),
                                    (F.col("id") % 5).cast("double").alias("b"))
    df = df.withColumn("label", 2 * F.col("a") - F.col("b") + F.sin(F.col("k")))
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    train, test = df.where(F.col("k") % 5 != 0), df.where(F.col("k") % 5 == 0)
    res = grid_search("ridge", train, test, "k", grid={"alpha": [0.01, 1000.0]}, folds=3)
    scores = dict((p["alpha"], s) for p, s in res.cv)
    assert res.best_params["alpha"] == max(scores, key=scores.get) == 0.01
    assert {r["metric"]: r["value"] for r in res.test_metrics.collect()}["rmse"] < 1.0
    rows = tuning_rows(res, "f").collect()
    assert [r["metric"] for r in rows] == ["cv_score"] * 2 + ["best rmse", "best mae", "best r2", "best n"]


def _line(spark, sign=1.0):
    df = spark.range(0, 400).select(F.col("id").alias("k"), (F.col("id") % 19).cast("double").alias("a"))
    df = df.withColumn("label", sign * (1 + 2 * F.col("a")))
    return VectorAssembler(inputCols=["a"], outputCol="features").transform(df)


def test_search_scores_raw_predictions(spark):
    data = _line(spark, -1.0)
    res = grid_search("ridge", data, data, "k", grid={"alpha": [1e-6]}, folds=2)
    assert res.cv[0][1] > -1e-3                     # a clipped score would be about -20
    assert {r["metric"]: r["value"] for r in res.test_metrics.collect()}["rmse"] > 10    # the run's report is clipped


def test_every_logistic_point_is_scored(spark):
    data = _line(spark).withColumn("label", ((F.col("k") * 7) % 10 + F.col("label") / 8 > 7).cast("double"))
    grid = {"penalty": ["l1", "l2", "elasticnet"], "C": [1.0], "class_weight": ["balanced", None], "max_iter": [1, 100, 200]}
    res = grid_search("logistic", data, data, "k", grid=grid, folds=2)
    assert len(res.cv) == 18 and all(0.5 < s <= 1 for _, s in res.cv)
    metrics = {r["metric"]: r["value"] for r in res.test_metrics.collect()}
    assert {"roc_auc", "1 precision", "accuracy f1", "macro avg recall", "weighted avg support"} <= set(metrics)


def test_ignored_axis_shares_its_fit(spark):
    data = _line(spark)
    grid = {"n_estimators": [3], "max_depth": [2], "min_samples_split": [2, 5]}
    res = grid_search("random_forest", data, data, "k", grid=grid, folds=2)
    assert len(res.cv) == 2 and res.cv[0][1] == res.cv[1][1]
    assert "min_samples_split" in tuning_rows(res, "f").first()["params"]


def test_grid_sizes():
    assert {k: len(combos(g)) for k, g in GRIDS.items()} == {
        "ridge": 6, "lasso": 6, "random_forest": 24, "xgboost": 72, "xgboost_poisson": 216, "logistic": 90, "random_forest_classifier": 108}


def test_csv_families(spark, tmp_path):
    prep = prepare(stays(spark, SF0001), STAYS, ("class",))
    path = str(tmp_path / "csv")
    S.write_datasets(prep.data, path, "csv")
    train, test = S.load_family(spark, path, "class", STAYS, "csv")
    want = {r[STAYS.key]: r["comorbidity_score"] for r in prep.data.collect()}
    got = {r[STAYS.key]: r["comorbidity_score"] for r in train.unionByName(test).collect()}
    assert got == pytest.approx(want)
    with pytest.raises(FileNotFoundError):
        S.load_family(spark, path, "outlier", STAYS, "csv")
    prep.release()


def test_scalers_survive_a_save(spark, tmp_path):
    prep = prepare(stays(spark, SF0001), STAYS)
    S.save_preprocessing(spark, str(tmp_path), prep.standard, prep.robust, prep.encoder)
    std, rob, enc = S.load_preprocessing(spark, str(tmp_path), by="family")
    assert std.params == prep.standard.params and rob.params == prep.robust.params
    assert enc.global_mean == prep.encoder.global_mean
    prep.release()


def test_flows_with_search_report_and_saved_models(spark, tmp_path):
    prep = prepare(stays(spark, SF0001), STAYS, ("class", "nosplit"))
    report, models = str(tmp_path / "report"), str(tmp_path / "models")
    rows = flow_no_split(prep, ("linear", "ridge"), tune=True, use_tuned=True, report=report, save_dir=models).collect()
    assert [(r["model"], r["scale"]) for r in rows] == [("linear", "days"), ("linear", "log"), ("ridge", "days"), ("ridge", "log")]
    _, cls, _ = train_evaluate_classifier(ModelSpec("logistic"), prep, report=report)
    assert cls.where("class = 'accuracy'").count() == 1
    stored = spark.read.parquet(report)
    assert stored.where("metric = 'cv_score'").count() == 6 and stored.where("metric = 'log rmse'").count() == 2
    text = S.render_markdown(stored, "Report")
    assert text.startswith("# Report") and "## ridge on nosplit" in text and "| 1 recall |" in text
    loaded = TrainedModel.load(spark, f"{models}/nosplit_ridge")
    train, test, names = family_data(prep, "nosplit")
    assert loaded.feature_names == names and loaded.predict(test.drop("label"), STAYS.key).columns == [STAYS.key, "prediction"]
    prep.release()


@pytest.mark.parametrize("kind", ["ridge", "lasso"])
def test_a_linear_fit_takes_few_passes(spark, kind):
    df = spark.range(0, 500).select(F.col("id").alias("k"), (F.col("id") % 17).cast("double").alias("a"), (F.col("id") % 17 + F.col("id") % 3 / 100).alias("b"))
    df = df.withColumn("label", 2 * F.col("a") - F.col("b") + F.sin(F.col("k")))
    data = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df).select("k", "label", "features")
    spark.sparkContext.setJobGroup(f"passes of {kind}", kind)
    fit(ModelSpec(kind, {"alpha": 0.01}), placed(data).persist(), is_placed=True)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"passes of {kind}")) <= 12
