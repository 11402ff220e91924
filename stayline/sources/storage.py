"""Sources and sinks: the spell CSV, the prepared datasets, metrics
reports, fitted preprocessing state.

* ``read_spells_csv``: header CSV with an explicit schema (``inferSchema``
  only when none is given -- it costs a full extra pass).  A missing path
  raises; the original printed a message and carried on with stale files.
* ``write_datasets`` / ``load_family``: the eight outputs of the original
  (train/test x inlier, outlier, class, no-split) are one table partitioned
  by ``family`` and ``split``, so loading one dataset reads only its
  directories (partition pruning).
* Metrics are rows in a table, appended per run; markdown is rendered from
  them (the only collect is of the few metric rows).
* Preprocessing state is the scaler parameters and the encoding table as
  Parquet (no pickle).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import RoleConfig
from ..operators.scalers import ScalerState
from ..operators.target_encoder import EncoderState


def read_spells_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
                    sep: str = ",") -> DataFrame:
    reader = spark.read.option("header", True).option("sep", sep).option("mode", "FAILFAST")
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_datasets(data: DataFrame, path: str, fmt: str = "parquet") -> None:
    """One write for all families; ``data`` carries ``family`` and
    ``split`` columns (see plans.datasets.prepare)."""
    w = data.write.mode("overwrite").partitionBy("family", "split")
    if fmt == "parquet":
        w.parquet(path)
    elif fmt == "csv":
        w.option("header", True).csv(path)
    else:
        raise ValueError(f"unknown format {fmt!r}")


def load_family(spark: SparkSession, path: str, family: str, cfg: RoleConfig,
                fmt: str = "parquet") -> tuple[DataFrame, DataFrame]:
    """(train, test) of one family; raises FileNotFoundError when either
    partition is absent."""
    for split in ("train", "test"):
        if not _exists(spark, os.path.join(path, f"family={family}", f"split={split}")):
            raise FileNotFoundError(f"{family} {split} data not found under {path}")
    reader = spark.read if fmt == "parquet" else spark.read.option("header", True).option("inferSchema", True)
    df = reader.parquet(path) if fmt == "parquet" else reader.csv(path)
    from ..plans.datasets import family_columns
    df = df.where(F.col("family") == F.lit(family))
    cols = [c for c in family_columns(df.columns, family, cfg) if c != "family"]
    df = df.select(*cols)
    return (df.where(F.col("split") == "train").drop("split"),
            df.where(F.col("split") == "test").drop("split"))


def _exists(spark: SparkSession, path: str) -> bool:
    """True when the directory exists, in whatever store the path names."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


METRIC_COLUMNS = ["family", "model", "params", "metric", "value"]


def append_metrics(metrics: DataFrame, path: str) -> None:
    """Append (family, model, params, metric, value) rows to a report table."""
    if metrics.columns != METRIC_COLUMNS:
        raise ValueError(f"metric rows have the columns {METRIC_COLUMNS}")
    metrics.write.mode("append").parquet(path)


def long_metrics(rows: DataFrame, family: str, model: str, params: str, group: str, values: list[str]) -> DataFrame:
    """Wide metric rows as (family, model, params, metric, value)."""
    cells = F.explode(F.array(*[F.struct(F.concat_ws(" ", F.col(group), F.lit(v)).alias("metric"), F.col(v).cast("double").alias("value"))
                                for v in values])).alias("x")
    return rows.select(F.lit(family).alias("family"), F.lit(model).alias("model"), F.lit(params).alias("params"), cells).select(
        "family", "model", "params", "x.*")


def render_markdown(report: DataFrame, title: str) -> str:
    """Markdown of a (small) report table: a section per family and model with
    its parameters, a list of its metrics in stored order."""
    lines, seen = [f"# {title}"], None
    for r in report.collect():
        if (r["family"], r["model"], r["params"]) != seen:
            seen = (r["family"], r["model"], r["params"])
            lines += ["", f"## {r['model']} on {r['family']}", "", f"Parameters: `{r['params']}`", "", "| metric | value |", "|---|---|"]
        lines.append(f"| {r['metric']} | {'' if r['value'] is None else format(r['value'], '.4f')} |")
    return "\n".join(lines) + "\n"


def save_preprocessing(spark: SparkSession, path: str, standard: ScalerState, robust: ScalerState,
                       encoder: EncoderState) -> None:
    standard.to_df(spark).unionByName(robust.to_df(spark)).write.mode("overwrite").parquet(
        os.path.join(path, "scalers"))
    encoder.table.write.mode("overwrite").parquet(os.path.join(path, "encoder"))
    spark.createDataFrame([(str(g), float(m)) for g, m in encoder.global_mean.items()],
                          "grp string, global_mean double").write.mode("overwrite").parquet(
        os.path.join(path, "encoder_global"))


def load_preprocessing(spark: SparkSession, path: str, by: str | None = None
                       ) -> tuple[ScalerState, ScalerState, EncoderState]:
    sc = spark.read.parquet(os.path.join(path, "scalers"))
    std = ScalerState.from_df(sc.where(F.col("kind") == "standard"), by)
    rob = ScalerState.from_df(sc.where(F.col("kind") == "robust"), by)
    table = spark.read.parquet(os.path.join(path, "encoder"))
    glob = {r["grp"]: r["global_mean"] for r in spark.read.parquet(os.path.join(path, "encoder_global")).collect()}
    sizes = {r["column"]: r["k"] for r in table.groupBy("column").agg(F.count(F.lit(1)).alias("k")).collect()}
    columns = sorted(sizes)
    return std, rob, EncoderState(table, glob, columns, sizes, by)
