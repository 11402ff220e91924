"""BPE, token counts and token files against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from stayline.llm import bpe, queries, token_count, token_files
from stayline.llm.varbyte import pack, unpack
from stayline.session import scratch_path
from tokenizers import Tokenizer

from llm_cases import TEXTS, edge_docs, empty_docs, rows_of

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"


def library(path):
    tok = Tokenizer.from_file(path)
    return tok, lambda t: tok.encode(t or "", add_special_tokens=False).ids


def odd_texts(seed, n=300):
    pick = random.Random(seed)
    parts = ["a", "B", "é", "É", " ", "  ", "\n", "\t", "'s", "'LL", "12", "٣", "½", "!?", "<|", "<|endoftext|>", "|>", "日", "Σ", "\x1c", " ", "the", "ing", "́", "\U0001f600"]
    return ["".join(pick.choice(parts) for _ in range(pick.randrange(40))) for _ in range(n)]


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_encoder_equals_library(path):
    tok, encode = library(path)
    texts = TEXTS + odd_texts(1)
    flat, lengths = bpe.Encoder(path).encode(texts)
    ends = np.cumsum(lengths)
    for t, a, b in zip(texts, ends - lengths, ends):
        assert flat[a:b].tolist() == encode(t), t


def test_encoder_forgets_and_relearns(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_LIMIT", 20)
    _, encode = library(BYTE)
    encoder = bpe.Encoder(BYTE)
    for t in odd_texts(2, 60):
        assert encoder.encode([t])[0].tolist() == encode(t)


def test_bpe_query_digests(spark):
    tok, encode = library(BYTE)
    want = []
    for r in edge_docs(spark).select("doc_id", "text").collect():
        ids = encode(r["text"])
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want.append((r["doc_id"], len(ids), sha(",".join(map(str, ids))), sha(tok.decode(ids, skip_special_tokens=False))))
    assert rows_of(bpe.digests(edge_docs(spark), BYTE)) == sorted(want, key=repr)
    assert bpe.digests(empty_docs(spark), BYTE).count() == 0


def test_encode_keeps_other_columns(spark):
    docs = edge_docs(spark)
    coded = bpe.encode(docs, BYTE, ids="tokens")
    assert coded.columns == docs.columns + ["tokens"]
    assert bpe.decode(coded, BYTE, "tokens").where("decoded <> coalesce(text, '')").count() == 0


def test_token_counts(spark, monkeypatch):
    monkeypatch.setattr(token_count, "CHUNK_DOCS", 4)
    _, encode = library(WORD)
    want = [(r["doc_id"], len((r["text"] or "").encode()), len(encode(r["text"])), len(encode(r["text"])) > 2048) for r in edge_docs(spark).select("doc_id", "text").collect()]
    assert rows_of(token_count.token_counts(edge_docs(spark), WORD)) == sorted(want, key=repr)
    assert token_count.token_counts(empty_docs(spark), WORD).count() == 0


def test_varbyte_round_trip():
    pick = np.random.default_rng(3)
    lengths = np.array([0, 1, 4, 5, 0, 300, 7])
    ranks = pick.integers(0, 2 ** pick.integers(1, 32, lengths.sum()))
    control, data, _, _ = pack(ranks, lengths)
    assert unpack(control, data, lengths).tolist() == ranks.tolist()


def test_token_files(spark):
    _, encode = library(BYTE)
    rows = sorted(((r["doc_id"], r["text"]) for r in edge_docs(spark).select("doc_id", "text").collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    folder = scratch_path(spark, "test-files")
    token_files.write_token_files(edge_docs(spark), folder, BYTE, end_id=2)
    read = {}
    for r in token_files.read_token_files(spark, folder).collect():
        read.setdefault(r["start"], []).append((r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist()))
    at, seen = 0, []
    while at in read:
        (doc_id, ids), = read.pop(at)
        seen.append((doc_id, ids))
        at += len(ids)
    assert not read and [d for d, _ in seen] == [d for d, _ in rows]
    assert sorted(map(repr, seen)) == sorted(repr((d, encode(t) + [2])) for d, t in rows)
    empty = scratch_path(spark, "test-files")
    token_files.write_token_files(empty_docs(spark), empty, BYTE, end_id=2)
    assert token_files.read_token_files(spark, empty).count() == 0


def test_token_file_query(spark):
    _, encode = library(BYTE)
    at, want = 0, []
    for r in sorted(spark.read.parquet(f"{SF}/documents.parquet").collect(), key=lambda r: r["doc_id"]):
        ids = encode(r["text"]) + [2]
        want.append((r["doc_id"], at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert rows_of(queries.op8(spark, SF)) == sorted(want, key=repr)


def test_normalisation_of_every_character_is_the_librarys():
    split, normalizer = bpe.PreTokens(bpe.Tables(WORD)), Tokenizer.from_file(WORD).normalizer
    points = [c for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    for a in range(0, len(points), 5000):
        text = "".join(f"a{chr(c)}b" for c in points[a:a + 5000])
        assert split.normalize(text) == normalizer.normalize_str(text)
        for c in points[a:a + 5000:97]:
            assert split.normalize(f"Q{chr(c)}") == normalizer.normalize_str(f"Q{chr(c)}")


def test_chunks_that_begin_with_several_spaces_keep_to_their_text():
    tok, encode = library(BYTE)
    texts = ["  ", " \t", "  \n x", " \n", "   a"]
    flat, lengths = bpe.Encoder(BYTE).encode(texts)
    ends = np.cumsum(lengths)
    assert [flat[a:b].tolist() for a, b in zip(ends - lengths, ends)] == [encode(t) for t in texts]


def test_a_chunk_of_documents_is_packed_in_bounded_memory():
    import tracemalloc
    import pyarrow as pa
    docs, each = 1000, 600
    chunk = token_count.Chunk(0, [f"w{i}" for i in range(4000)])
    chunk.add(pa.array(range(docs), pa.int64()), pa.array(["x"] * docs), np.random.default_rng(0).integers(0, 4000, docs * each), np.full(docs, each))
    n = docs * each
    tracemalloc.start()
    batches = list(chunk.batches())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(b.num_rows for b in batches) == 4001
    assert peak < 45 * n


def test_numbers_packed_in_pieces_read_back(monkeypatch):
    monkeypatch.setattr(token_count, "PIECE", 64)
    for n in (0, 1, 63, 64, 65, 130):
        numbers = np.random.default_rng(n).integers(0, 1 << 31, n) >> np.arange(n) % 31
        assert token_count.unpacked(token_count.packed(numbers), n).tolist() == numbers.tolist()


def test_hashed_pairs_are_found_past_each_other():
    tables = bpe.Tables.__new__(bpe.Tables)
    left, right = (x.ravel() for x in np.meshgrid(np.arange(60), np.arange(60)))
    known = (left + right) % 3 > 0
    tables.keys = np.sort(((left << 32) | right)[known])
    tables.slots = bpe.hashed(tables.keys)
    at = tables.pair_index(left, right)
    assert (at[~known] == -1).all()
    assert (tables.keys[at[known]] == ((left << 32) | right)[known]).all()
