"""Inputs that would lose rows, columns or meaning silently raise."""

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stayline.config import STAYS, RoleConfig
from stayline.operators.clean import fill_defaults
from stayline.operators.features import assemble, class_weights
from stayline.operators.metrics import classification_report
from stayline.operators.scalers import apply_scaler, fit_standard
from stayline.operators.stats import quantiles
from stayline.operators.target_encoder import apply_target_encoder, fit_target_encoder
from stayline.session import ensure_checkpoint_dir


@pytest.fixture()
def rows(spark):
    return spark.createDataFrame([(1, 2.0, "x", 1.0), (2, 3.0, "y", None)], "spell_id long, a double, b string, spell_episode_los double")


def test_string_features_raise(rows):
    with pytest.raises(ValueError, match="b \\(string\\)"):
        assemble(rows, STAYS, STAYS.target)


def test_null_labels(rows):
    data = rows.drop("b")
    with pytest.raises(PySparkException, match="NULL"):
        assemble(data, STAYS, STAYS.target, null_policy="error")[0].count()
        assemble(data, STAYS, STAYS.target, null_policy="error")[0].collect()
    assert assemble(data, STAYS, STAYS.target, null_policy="sentinel")[0].count() == 1
    assert assemble(data, STAYS, None, null_policy="sentinel")[0].columns == ["spell_id", "features"]


def test_number_into_string_default_raises(rows):
    with pytest.raises(TypeError):
        fill_defaults(rows, RoleConfig(na_defaults={"b": 0}))


def test_unseen_groups_raise(spark, rows):
    data = rows.withColumn("family", F.lit("p"))
    other = rows.withColumn("family", F.lit("q"))
    with pytest.raises(PySparkException, match="no scaler"):
        apply_scaler(other, fit_standard(data, ["a"], by="family")).collect()
    enc = fit_target_encoder(data, ["b"], "a", by="family")
    with pytest.raises(PySparkException, match="no encoder"):
        apply_target_encoder(other, enc).collect()


def test_a_label_with_many_values_is_no_class(spark):
    with pytest.raises(ValueError):
        class_weights(spark.range(10_050).select(F.col("id").cast("double").alias("label")), "label")


@pytest.mark.parametrize("n", [1, 2, 3, 10, 2000])
def test_quantiles_equal_numpy_on_distinct_values(spark, n):
    x = np.random.default_rng(n).normal(0, 1, n)
    df = spark.createDataFrame([(float(v), float(-v), None) for v in x], "a double, b double, c double").repartition(5)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    got = quantiles(df, ["a", "b", "c"], probs)
    assert np.allclose(got["a"], np.quantile(x, probs), rtol=0, atol=1e-12)
    assert np.allclose(got["b"], np.quantile(-x, probs), rtol=0, atol=1e-12)
    assert got["c"] == [None] * 6


def test_quantiles_by_group_with_a_hot_value(spark):
    df = spark.range(3000).select((F.col("id") % 2).alias("g"), F.when(F.col("id") < 2000, 5.0).otherwise(F.col("id").cast("double")).alias("v"))
    df = df.unionAll(spark.createDataFrame([(7, float("nan")), (None, 1.0)], "g long, v double"))
    got = quantiles(df, ["v"], [0.25, 0.5, 0.9], by="g")
    for g in (0, 1):
        own = [5.0 if i < 2000 else float(i) for i in range(3000) if i % 2 == g]
        assert np.allclose(got[g]["v"], np.quantile(own, [0.25, 0.5, 0.9]))
    assert got[7]["v"] == [None] * 3 and got[None]["v"] == [1.0] * 3


def test_report_reads_its_input_once(spark, capsys, tmp_path):
    path = str(tmp_path / "cls")
    spark.range(50).select((F.col("id") % 3).cast("int").alias("a"), (F.col("id") % 2).cast("int").alias("p")).write.parquet(path)
    report = classification_report(spark.read.parquet(path), "a", "p")
    report.explain()
    assert capsys.readouterr().out.count("FileScan") == 1
    rows = {r["class"]: r for r in report.collect()}
    assert set(rows) == {"0", "1", "2", "accuracy", "macro avg", "weighted avg"} and rows["2"]["precision"] == 0 and rows["accuracy"]["support"] == 50


def test_cluster_needs_a_shared_checkpoint_folder():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
