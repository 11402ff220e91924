"""Evaluation: actual/predicted frames, regression metrics, confusion matrix,
classification report, exact ROC-AUC, anomaly label counts.

Every metric is an aggregate over a distributed (actual, predicted) table;
only the few result numbers are small.  ROC-AUC is exact and tie-aware
without a single-partition sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import clip_nonneg, col, inverse_log_target, safe_div
from ..session import written


def regression_frame(pred: DataFrame, key: str, actual: str = "label", predicted: str = "prediction",
                     unpack: bool = True, clip: bool = False, eps: float = 1e-9) -> DataFrame:
    """(key, actual_los, predicted_los); ``unpack`` maps both back from the
    log scale and floors them to whole days."""
    a, p = col(actual).cast("double"), col(predicted).cast("double")
    if clip:
        p = clip_nonneg(p)
    if unpack:
        a, p = inverse_log_target(a, eps), inverse_log_target(p, eps)
    return pred.select(col(key), a.alias("actual_los"), p.alias("predicted_los"))


def classification_frame(pred: DataFrame, key: str, actual: str = "label",
                         predicted: str = "prediction") -> DataFrame:
    return pred.select(col(key), col(actual).cast("int").alias("actual_outlier"),
                       col(predicted).cast("int").alias("predicted_outlier"))


def _error_sums(a: Column, p: Column, prefix: str = "") -> list[Column]:
    known = a.isNotNull() & p.isNotNull()
    err = a - p
    return [F.count_if(known).alias(f"{prefix}n"), F.sum(err * err).alias(f"{prefix}sse"),
            F.sum(F.abs(err)).alias(f"{prefix}sae"), F.var_pop(F.when(known, a)).alias(f"{prefix}va")]


def _errors(prefix: str = "") -> list[Column]:
    c = lambda name: F.col(prefix + name)
    n = F.nullif(c("n"), F.lit(0))
    return [F.sqrt(c("sse") / n).alias("rmse"), (c("sae") / n).alias("mae"),
            (F.lit(1.0) - safe_div(c("sse"), c("va") * c("n"), None)).alias("r2"), c("n").alias("n")]


def regression_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """One row: rmse, mae, r2, n.  R² = 1 - SSres / SStot with
    SStot = n * var_pop(actual); one pass."""
    return df.agg(*_error_sums(col(actual).cast("double"), col(predicted).cast("double"))).select(*_errors())


def metrics_on_scales(df: DataFrame, actual: str, scales: dict[str, tuple[str, bool]], eps: float = 1e-9) -> DataFrame:
    """Rows (scale, rmse, mae, r2, n) for several predictions of a log target in
    one pass; a scale is (prediction column, whether to unpack to whole days)."""
    sums = []
    for i, (predicted, unpack) in enumerate(scales.values()):
        a, p = col(actual).cast("double"), col(predicted).cast("double")
        if unpack:
            a, p = inverse_log_target(a, eps), inverse_log_target(p, eps)
        sums += _error_sums(a, p, f"s{i}_")
    rows = F.array(*[F.struct(F.lit(name).alias("scale"), *_errors(f"s{i}_")) for i, name in enumerate(scales)])
    return df.agg(*sums).select(F.explode(rows).alias("r")).select("r.*")


def confusion_matrix(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """(actual, predicted, rows) for the pairs that occur."""
    return df.groupBy(col(actual).cast("int").alias("actual"), col(predicted).cast("int").alias("predicted")) \
        .agg(F.count(F.lit(1)).alias("rows"))


def classification_report(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Per-class precision, recall, F1 and support, then 'accuracy',
    'macro avg' and 'weighted avg' rows (0/0 -> 0).

    The input is read once: each row counts for its actual and its predicted
    class, and the per-class table (k rows) is folded into one row whose
    array of result rows is exploded."""
    pair = df.select(col(actual).cast("int").alias("a"), col(predicted).cast("int").alias("p"))
    counted = pair.groupBy("a", "p").agg(F.count(F.lit(1)).alias("n"))      # at most k * k rows from here on
    side = F.explode(F.array(
        F.struct(F.col("a").alias("cls"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted_n")),
        F.struct(F.col("p").alias("cls"), F.lit(0).cast("long").alias("support"), F.col("n").alias("predicted_n")))).alias("x")
    hit = F.when(F.col("a").eqNullSafe(F.col("p")) & (F.col("x.support") > 0), F.col("n")).otherwise(0)
    t = (counted.select("a", "p", "n", side).select("x.*", hit.alias("tp"))
         .groupBy("cls").agg(F.sum("support").alias("support"), F.sum("predicted_n").alias("predicted_n"), F.sum("tp").alias("tp")))
    number = lambda name: F.col(name).cast("double")
    t = t.select(F.col("cls").cast("string").alias("class"), safe_div(number("tp"), number("predicted_n")).alias("precision"),
                 safe_div(number("tp"), number("support")).alias("recall"), "support", "tp")
    t = t.withColumn("f1", safe_div(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
    row = lambda name, p, r, f, n: F.struct(name.alias("class"), p.cast("double").alias("precision"), r.cast("double").alias("recall"),
                                            f.cast("double").alias("f1"), n.cast("bigint").alias("support"))
    own = row(F.col("class"), F.col("precision"), F.col("recall"), F.col("f1"), F.col("support"))
    mean = lambda name: F.avg(name)
    share = lambda name: safe_div(F.sum(F.col(name) * F.col("support")), F.sum("support").cast("double"))
    none = F.lit(None)
    folded = t.agg(F.collect_list(own).alias("classes"),
                   row(F.lit("accuracy"), none, none, safe_div(F.sum("tp").cast("double"), F.sum("support").cast("double")), F.sum("support")).alias("accuracy"),
                   row(F.lit("macro avg"), mean("precision"), mean("recall"), mean("f1"), F.sum("support")).alias("macro"),
                   row(F.lit("weighted avg"), share("precision"), share("recall"), share("f1"), F.sum("support")).alias("weighted"))
    rows = F.concat("classes", F.array("accuracy"), F.array("macro"), F.array("weighted"))
    return folded.select(F.explode(rows).alias("r")).select("r.*")


AUC_ROWS = 100_000      # distinct scores per range


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Exact, tie-aware ROC-AUC as a one-row frame (column ``auc``).

    AUC = sum over positives of (negatives with a lower score + half the
    negatives with an equal score) / (P * N).  The counts per distinct score
    are computed once and range-partitioned, in a number of ranges that
    follows from their count; a running sum in each range starts from the
    total of the ranges before it (one row per range)."""
    y, s = col(label).cast("double"), col(score).cast("double")
    per_score = df.where(y.isNotNull() & s.isNotNull()).groupBy(s.alias("s")).agg(
        F.sum(y).alias("pos"), F.sum(F.lit(1.0) - y).alias("neg")).persist()
    ranges = max(1, -(-per_score.count() // AUC_ROWS))
    # written: planned twice, the ranges would be cut at the bounds of two different samples
    dealt = written(per_score.repartitionByRange(ranges, "s").select("*", F.spark_partition_id().alias("b")), "scores")
    per_score.unpersist()
    below = Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy("b").agg(F.sum("neg").alias("n")).select("b", F.coalesce(F.sum("n").over(below), F.lit(0.0)).alias("off"))
    inside = Window.partitionBy("b").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    ranked = dealt.join(F.broadcast(offsets), "b").withColumn("below", F.col("off") + F.coalesce(F.sum("neg").over(inside), F.lit(0.0)))
    found = ranked.agg(F.sum(F.col("pos") * (F.col("below") + 0.5 * F.col("neg"))).alias("num"),
                       F.sum("pos").alias("p"), F.sum("neg").alias("n")).first()
    area = found["num"] / (found["p"] * found["n"]) if found["p"] and found["n"] else None
    return df.sparkSession.createDataFrame([(area,)], "auc double")


def roc_auc_by(df: DataFrame, by: str, label: str, score: str) -> DataFrame:
    """(``by``, auc): the exact ROC-AUC of every group, all groups in one job.

    As ``roc_auc``: counts per group and distinct score are range-partitioned, and
    a running sum inside a range starts from the group's total in the ranges
    before it (one row per range and group)."""
    y, s = col(label).cast("double"), col(score).cast("double")
    per_score = df.where(y.isNotNull() & s.isNotNull()).groupBy(col(by).alias("g"), s.alias("s")).agg(
        F.sum(y).alias("pos"), F.sum(F.lit(1.0) - y).alias("neg")).persist()
    ranges = max(1, -(-per_score.count() // AUC_ROWS))
    dealt = written(per_score.repartitionByRange(ranges, "g", "s").select("*", F.spark_partition_id().alias("b")), "scores")
    per_score.unpersist()
    below = Window.partitionBy("g").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy("g", "b").agg(F.sum("neg").alias("n")).select("g", "b", F.coalesce(F.sum("n").over(below), F.lit(0.0)).alias("off"))
    inside = Window.partitionBy("g", "b").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    ranked = dealt.join(offsets, ["g", "b"]).withColumn("below", F.col("off") + F.coalesce(F.sum("neg").over(inside), F.lit(0.0)))
    found = ranked.groupBy("g").agg(F.sum(F.col("pos") * (F.col("below") + 0.5 * F.col("neg"))).alias("num"), F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    return found.select(F.col("g").alias(by), safe_div(F.col("num"), F.col("p") * F.col("n"), None).alias("auc"))


def anomaly_counts(df: DataFrame, label: str = "anomaly") -> DataFrame:
    """(anomaly, rows), most frequent first."""
    return df.groupBy(col(label)).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"))
