"""The corpus pipeline, stage by stage against plain versions."""

import hashlib

import corpus_pipeline
import public_tokenizers
from stayline.llm import pii
from tokenizers import Tokenizer

from llm_cases import edge_docs, empty_docs
from test_llm_decontam import plain as plain_hits
from test_llm_quality import plain as plain_quality
from test_llm_simhash import plain_components, plain_fingerprint

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality rules", "simhash near-dedup", "benchmark decontamination", "personal data", "bpe"]
    by = lambda frame: {r["doc_id"]: r["text"] for r in frame.collect()}

    good = stages["quality rules"](spark, docs, SF)
    all_texts, texts = by(docs), by(good)
    assert good.columns == docs.columns
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    for i, t in all_texts.items():
        if plain_quality(t)[5]:
            assert i not in texts
        elif labels.get(i) == 1:
            assert i in texts

    first = stages["simhash near-dedup"](spark, good, SF)
    ids = sorted(texts)
    groups = plain_components([plain_fingerprint(texts[i]) for i in ids])
    assert first.columns == docs.columns and set(by(first)) == {ids[c] for c in groups}

    clean = stages["benchmark decontamination"](spark, first, SF)
    items = [(str(r["item_id"]), r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert clean.columns == docs.columns
    assert set(by(clean)) == {i for i, t in by(first).items() if not plain_hits(t, items)[1]}

    masked = stages["personal data"](spark, clean, SF)
    assert masked.columns == docs.columns and masked.where("n_chars <> length(text)").count() == 0
    before, after = by(clean), by(masked)
    assert set(before) == set(after)
    for i, t in before.items():
        spans = pii.base_spans(t)[0]
        assert (t == after[i]) or spans
        assert not any(t[a:b] in after[i] for _, a, b in spans)

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = stages["bpe"](spark, masked, SF).collect()
    assert len(rows) == len(after)
    for r in rows:
        ids = tok.encode(after[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_run_is_the_chain(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    rows = lambda frame: sorted(tuple(r) for r in frame.collect())
    assert rows(corpus_pipeline.run(spark, SF)) == rows(docs)


def test_stages_on_edge_cases(spark):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty_docs(spark), SF).count() == 0
    for name, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, edge_docs(spark), SF).count() >= 10, name
