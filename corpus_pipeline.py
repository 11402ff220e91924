"""A corpus from raw documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
it as Parquet in the shared scratch folder and reads it back as the next
stage's input, so a lost executor costs at most the running stage.  All stages
but the last return the columns of their input.  Null and empty texts do not
pass the quality rules; the other stages keep them and treat them as empty.
"""

import public_tokenizers
from pyspark.sql import functions as F

from stayline.llm import bpe, decontam, pii, quality, simhash
from stayline.llm.scratch import drop, saved


def quality_rules(spark, docs, sf_dir):
    """Documents that pass the threshold table."""
    return quality.keep_good(docs)


def near_dedup(spark, docs, sf_dir):
    """One document of each group of SimHash near-duplicates: 3-word shingles, at most 3 differing bits."""
    return simhash.keep_first(docs, shingle=3, radius=3)


def decontamination(spark, docs, sf_dir):
    """Documents without a 10-word window of a benchmark item."""
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=10)


def personal_data(spark, docs, sf_dir):
    """Documents with personal data replaced by its kind; n_chars follows the new text."""
    masked = pii.masked(docs)
    return masked.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else masked


def bpe_round_trip(spark, docs, sf_dir):
    """Ids per document, their digest, and the digest of the text decoded from them."""
    return bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("personal data", personal_data),
    ("bpe", bpe_round_trip),
]

#: The tokenizer and the trained span classifier are beyond SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The result of all stages over ``documents``."""
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        docs, path = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if last:
            drop(spark, last)
        last = path
    return docs
