"""Scoring spells as they arrive (the batch ``run`` over micro-batches).

Everything fitted is static: scaler parameters are literals, the encoding
table is a static broadcast side of a stream-static join, and MLlib models
transform streaming frames.  So the stream is stateless -- no watermark or
state store -- and each micro-batch is one pipelined pass:

    readStream(parquet) → clean → impute → scale → encode → assemble →
    model → floor(expm1(prediction)) → writeStream(parquet)

The sink's checkpoint location sits under the session's checkpoint folder,
so a restarted query resumes after the last committed batch.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import RoleConfig
from ..functions.scalar import col, inverse_log_target
from ..operators.clean import clean_and_impute
from ..operators.features import FEATURES, SENTINEL
from ..operators.models.trainer import PREDICTION, TrainedModel
from ..operators.scalers import ScalerState, apply_scaler
from ..operators.target_encoder import EncoderState, apply_target_encoder

FAMILY = "family"


def prepare_features(df: DataFrame, cfg: RoleConfig, family: str, standard: ScalerState,
                     robust: ScalerState, encoder: EncoderState, feature_names: list[str]) -> DataFrame:
    """Raw spells (batch or stream) → (key, features) with one family's
    fitted state; missing feature values take the sentinel."""
    clean = clean_and_impute(df, cfg).withColumn(FAMILY, F.lit(family))
    out = apply_target_encoder(apply_scaler(apply_scaler(clean, standard), robust), encoder)
    cast = [F.coalesce(col(c).cast("double"), F.lit(SENTINEL)).alias(f"f{i}") for i, c in enumerate(feature_names)]
    base = out.select(col(cfg.key), *cast)
    va = VectorAssembler(inputCols=[f"f{i}" for i in range(len(feature_names))], outputCol=FEATURES)
    return va.transform(base).select(col(cfg.key), FEATURES)


def scored(df: DataFrame, cfg: RoleConfig, family: str, standard: ScalerState, robust: ScalerState,
           encoder: EncoderState, model: TrainedModel) -> DataFrame:
    """(key, predicted_los in whole days) for raw spells."""
    feats = prepare_features(df, cfg, family, standard, robust, encoder, model.feature_names)
    pred = model.model.transform(feats)
    p = col(PREDICTION)
    if model.spec.clips:
        p = F.greatest(p, F.lit(0.0))
    return pred.select(col(cfg.key), inverse_log_target(p).alias("predicted_los"))


def score_stream(spark: SparkSession, source_dir: str, schema: T.StructType, cfg: RoleConfig, family: str,
                 standard: ScalerState, robust: ScalerState, encoder: EncoderState, model: TrainedModel,
                 sink_dir: str, checkpoint_dir: str, available_now: bool = True,
                 max_files_per_trigger: int | None = None):
    """Start the scoring query; with ``available_now`` it processes what is
    in ``source_dir`` (in bounded micro-batches) and stops."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_dir)
    out = scored(stream, cfg, family, standard, robust, encoder, model)
    writer = (out.writeStream.format("parquet").option("path", sink_dir)
              .option("checkpointLocation", checkpoint_dir).outputMode("append"))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
