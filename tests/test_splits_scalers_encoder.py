import numpy as np
import pytest
from pyspark.sql import functions as F

from stayline.config import RoleConfig
from stayline.operators.scalers import apply_scaler, fit_robust, fit_standard
from stayline.operators.splits import kfold_column, split_column, stratified_kfold_column
from stayline.operators.target_encoder import apply_target_encoder, fit_target_encoder

CFG = RoleConfig(key="k")


def test_split_is_deterministic_disjoint_and_partition_invariant(spark):
    df = spark.range(0, 20000).withColumnRenamed("id", "k")
    a = split_column(df, CFG).select("k", "split")
    b = split_column(df.repartition(13), CFG).select("k", F.col("split").alias("split2"))
    j = a.join(b, "k")
    assert j.count() == 20000
    assert j.where(F.col("split") != F.col("split2")).count() == 0
    frac = a.where(F.col("split") == "test").count() / 20000
    assert 0.18 < frac < 0.22


def test_folds_cover_and_balance(spark):
    df = spark.range(0, 9000).withColumnRenamed("id", "k").withColumn("y", (F.col("k") % 10 == 0).cast("int"))
    f = kfold_column(df, CFG, 5).groupBy("fold").count().collect()
    assert sorted(r["fold"] for r in f) == [0, 1, 2, 3, 4]
    s = stratified_kfold_column(df, CFG, "y", 3).groupBy("y", "fold").count().collect()
    per = {}
    for r in s:
        per.setdefault(r["y"], []).append(r["count"])
    for counts in per.values():
        assert len(counts) == 3 and max(counts) / min(counts) < 1.3


def test_standard_scaler_population_std_and_zero_variance(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(50, 10, 500)
    df = spark.createDataFrame([(i, float(v), 3.0) for i, v in enumerate(x)] + [(999, None, 3.0)],
                               "k long, a double, c double")
    st = fit_standard(df, ["a", "c"])
    m, s = st.params["__all__"]["a"]
    assert m == pytest.approx(x.mean()) and s == pytest.approx(x.std(ddof=0))
    assert st.params["__all__"]["c"][1] == 1.0
    out = apply_scaler(df, st)
    assert out.where(F.col("k") == 999).first()["a"] is None
    assert out.agg(F.stddev_pop("a")).first()[0] == pytest.approx(1.0)


def test_robust_scaler_exact_quantiles(spark):
    x = np.arange(1, 102, dtype=float) ** 1.5
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)], "k long, a double")
    st = fit_robust(df, ["a"])
    med, iqr = st.params["__all__"]["a"]
    q1, q2, q3 = np.percentile(x, [25, 50, 75])
    assert med == pytest.approx(q2) and iqr == pytest.approx(q3 - q1)


def _numpy_encoding(cats, y):
    m, v = y.mean(), y.var()
    out = {}
    for c in set(cats):
        yy = y[[ci == c for ci in cats]]
        n, mc, vc = len(yy), yy.mean(), yy.var()
        den = v * n + vc
        lam = v * n / den if den != 0 else float("nan")
        out[c] = m if np.isnan(lam) else lam * mc + (1 - lam) * m
    return out, m


def test_target_encoder_matches_numpy_and_handles_null_and_unseen(spark):
    rng = np.random.default_rng(5)
    cats = [rng.choice(["a", "b", "c", None]) for _ in range(400)] + ["solo"]
    y = rng.normal(2, 1, 401)
    df = spark.createDataFrame([(i, c, float(v)) for i, (c, v) in enumerate(zip(cats, y))], "k long, g string, y double")
    st = fit_target_encoder(df, ["g"], "y", checkpoint=False)
    expect, m = _numpy_encoding(cats, y)
    got = {r["category"]: r["encoding"] for r in st.table.collect()}
    for c, e in expect.items():
        assert got[c] == pytest.approx(e, rel=1e-12, abs=1e-12)
    assert st.global_mean["__all__"] == pytest.approx(m)
    new = spark.createDataFrame([(1, "zzz"), (2, None), (3, "a")], "k long, g string")
    enc = {r["k"]: r["g"] for r in apply_target_encoder(new, st).collect()}
    assert enc[1] == pytest.approx(m) and enc[2] == pytest.approx(expect[None]) and enc[3] == pytest.approx(expect["a"])
    # Every encoding lies between the global and the category mean.
    for c in ["a", "b", "c"]:
        mc = y[[ci == c for ci in cats]].mean()
        assert min(m, mc) - 1e-12 <= got[c] <= max(m, mc) + 1e-12


def test_encoder_apply_is_a_broadcast_join(spark, capsys):
    df = spark.createDataFrame([(i, f"c{i % 7}", float(i % 5)) for i in range(200)], "k long, g string, y double")
    st = fit_target_encoder(df, ["g"], "y", checkpoint=False)
    apply_target_encoder(df.select("k", "g"), st).explain()
    plan = capsys.readouterr().out
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
