"""Registered queries of the training-data operators and their DuckDB SQL."""

import public_tokenizers
from pyspark.sql import functions as F

from . import bpe, decontam, divergence, html_extract, jaccard, language, merkle, pii, quality, ring, simhash, token_count, token_files
from ..session import scratch_path
from .oracle import DECONTAM_SQL, DIVERGENCE_SQL, MERKLE_SQL, QUALITY_SQL

QUERIES, ORACLE = {}, {}


def register(name, sql=None):
    def keep(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f
    return keep


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register("op1_pii")
def op1(spark, sf_dir):
    found = pii.detected(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["base"])
    count = lambda kind: F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")
    return found.select(F.col("row.doc_id").alias("doc_id"), *map(count, pii.KINDS), F.sha2(pii.listed(base), 256).alias("base_sha256"),
                        pii.listed(F.col("spans")).alias("spans"))


@register("op2_simhash")
def op2(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@register("op3_token_counts")
def op3(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_count.token_counts(docs, public_tokenizers.path("word_bpe_49k.json"), limit=2048)


@register("op4_html_text")
def op4(spark, sf_dir):
    return html_extract.extracted(table(spark, sf_dir, "pages"))


@register("op5_language_id")
def op5(spark, sf_dir):
    found = language.identified(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"), carry=["page_id", "url"])
    return found.select(F.col("row.page_id").alias("page_id"), F.col("row.url").alias("url"), "declared", "text_lang", "lang", F.round("probability", 6).alias("probability"))


@register("op6_quality_rules", QUALITY_SQL)
def op6(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.judged(docs).select(F.col("row.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                       "n_repeat_words", "base_failed", "kept")


@register("op7_bpe")
def op7(spark, sf_dir):
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@register("op8_token_files")
def op8(spark, sf_dir):
    folder = scratch_path(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    read = token_files.read_token_files(spark, folder)
    return read.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


@register("op9_decontamination", DECONTAM_SQL)
def op9(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.searched(docs, table(spark, sf_dir, "benchmark"), window=10)
    return found.select(F.col("row.doc_id").alias("doc_id"), "found.n_words", "found.n_hit", F.size("found.items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("found.items", ","), 256).alias("items_sha256"), (F.col("found.longest") > 0).alias("contaminated"),
                        F.col("found.longest").alias("longest"), F.coalesce("found.longest_at", F.lit(-1)).cast("long").alias("longest_at"))


@register("op10_sharding")
def op10(spark, sf_dir):
    return ring.shard_documents(table(spark, sf_dir, "documents"), shards=24)


@register("op11_divergence", DIVERGENCE_SQL)
def op11(spark, sf_dir):
    return divergence.divergence(table(spark, sf_dir, "documents"))


@register("op12_merkle_manifest", MERKLE_SQL)
def op12(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return merkle.manifest(docs, tampered=F.crc32(F.col("doc_id").cast("string")) % 2 == 0)


@register("op13_jaccard_join")
def op13(spark, sf_dir):
    return jaccard.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
