import numpy as np
import pytest

from stayline.operators import metrics as M


def _brute_auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    gt = (pos[:, None] > neg[None, :]).sum()
    eq = (pos[:, None] == neg[None, :]).sum()
    return (gt + 0.5 * eq) / (len(pos) * len(neg))


def test_auc_exact_with_ties_vs_brute_force(spark, monkeypatch):
    monkeypatch.setattr(M, "AUC_ROWS", 8)       # several ranges
    rng = np.random.default_rng(7)
    y = rng.integers(0, 2, 5000)
    s = np.round(np.clip(rng.normal(0.4 + 0.2 * y, 0.2), 0, 1), 2)  # many ties
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "label int, score double")
    got = M.roc_auc(df, "label", "score").first()["auc"]
    assert got == pytest.approx(_brute_auc(y, s), abs=1e-12)


def test_regression_metrics_vs_numpy(spark):
    rng = np.random.default_rng(1)
    a = rng.normal(5, 2, 300)
    p = a + rng.normal(0, 1, 300)
    df = spark.createDataFrame([(float(x), float(z)) for x, z in zip(a, p)], "a double, p double")
    r = M.regression_metrics(df, "a", "p").first()
    assert r["rmse"] == pytest.approx(np.sqrt(np.mean((a - p) ** 2)))
    assert r["mae"] == pytest.approx(np.mean(np.abs(a - p)))
    assert r["r2"] == pytest.approx(1 - np.sum((a - p) ** 2) / np.sum((a - a.mean()) ** 2))


def test_classification_report_vs_manual(spark):
    actual = [0] * 80 + [1] * 20
    pred = [0] * 70 + [1] * 10 + [0] * 5 + [1] * 15
    df = spark.createDataFrame(list(zip(actual, pred)), "a int, p int")
    rep = {r["class"]: r for r in M.classification_report(df, "a", "p").collect()}
    assert rep["1"]["precision"] == pytest.approx(15 / 25) and rep["1"]["recall"] == pytest.approx(15 / 20)
    assert rep["0"]["precision"] == pytest.approx(70 / 75) and rep["0"]["support"] == 80
    assert rep["accuracy"]["f1"] == pytest.approx(85 / 100)
    f1 = [2 * 0.6 * 0.75 / 1.35, 2 * (70 / 75) * (70 / 80) / ((70 / 75) + (70 / 80))]
    assert rep["macro avg"]["f1"] == pytest.approx(sum(f1) / 2)
    assert rep["weighted avg"]["f1"] == pytest.approx((f1[0] * 20 + f1[1] * 80) / 100)


def test_report_zero_division_is_zero(spark):
    df = spark.createDataFrame([(0, 0), (1, 0)], "a int, p int")
    rep = {r["class"]: r for r in M.classification_report(df, "a", "p").collect()}
    assert rep["1"]["precision"] == 0.0 and rep["1"]["f1"] == 0.0


def test_areas_over_many_ranges_use_one_set_of_bounds(spark, monkeypatch):
    from pyspark.sql import functions as F
    monkeypatch.setattr(M, "AUC_ROWS", 5_000)
    rows = spark.range(0, 60_000, 1, 6).select(
        (F.col("id") % 2).alias("g"), F.rand(7).alias("s"), (F.rand(8) < 0.3).cast("double").alias("y")).localCheckpoint()
    data = rows.toPandas()

    def area(part):
        rank = part["s"].rank()
        p = (part["y"] == 1).sum()
        return (rank[part["y"] == 1].sum() - p * (p + 1) / 2) / (p * (len(part) - p))

    assert M.roc_auc(rows, "y", "s").first()["auc"] == pytest.approx(area(data), abs=1e-9)
    found = {r["g"]: r["auc"] for r in M.roc_auc_by(rows, "g", "y", "s").collect()}
    assert found == {g: pytest.approx(area(part), abs=1e-9) for g, part in data.groupby("g")}
