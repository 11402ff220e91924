from stayline.config import STAYS
from stayline.operators.features import assemble
from stayline.operators.models.estimators import ModelSpec
from stayline.operators.models.trainer import fit
from stayline.plans.datasets import prepare
from stayline.sources.fixtures import stays
from stayline.streaming.scoring import score_stream, scored

from conftest import SF0001


def test_stream_scores_equal_batch_scores(spark, tmp_path):
    raw = stays(spark, SF0001)
    src = str(tmp_path / "src")
    raw.repartition(3).write.parquet(src)
    prep = prepare(raw, STAYS, ("nosplit",))
    tr, feats = assemble(prep.family("nosplit", "train"), STAYS, STAYS.target, null_policy="sentinel")
    model = fit(ModelSpec("ridge"), tr, feats)
    q = score_stream(spark, src, raw.schema, STAYS, "nosplit", prep.standard, prep.robust, prep.encoder,
                     model, str(tmp_path / "sink"), str(tmp_path / "ckpt"), max_files_per_trigger=1)
    q.awaitTermination()
    streamed = {r["spell_id"]: r["predicted_los"] for r in spark.read.parquet(str(tmp_path / "sink")).collect()}
    batch = {r["spell_id"]: r["predicted_los"] for r in
             scored(raw, STAYS, "nosplit", prep.standard, prep.robust, prep.encoder, model).collect()}
    assert len(streamed) == 1000 and streamed == batch
    # The prepared test rows and the stream agree on the same spells.
    te, _ = assemble(prep.family("nosplit", "test"), STAYS, STAYS.target, features=feats, null_policy="sentinel")
    from stayline.operators.metrics import regression_frame
    frame = {r["spell_id"]: r["predicted_los"] for r in regression_frame(model.predict(te, "spell_id"), "spell_id").collect()}
    assert all(streamed[k] == v for k, v in frame.items())
