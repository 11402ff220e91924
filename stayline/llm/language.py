"""Language of web pages by Bayesian evidence fusion.

Four sources of evidence are combined in log space:
  text      character-trigram likelihoods, trained on all labelled documents
            (hashed to ``BUCKETS`` counts per language); long texts count as
            ``EFFECTIVE`` trigrams at most, since trigrams are not independent;
  declared  the markup's language, through P(declared | language);
  suffix    the last label of the address, through P(suffix | language);
  host      a prior of the page's host, smoothed towards its domain's, and that
            towards the corpus'; the page's own share is left out.
The last three are estimated from the pages' text posteriors by grouped
aggregation over all pages; hot hosts are pre-aggregated, and the joins carry
no texts.

Defined cases: a null page or address gives empty text, declaration or host;
a page without any evidence gets the corpus prior; ties go to the first
language in alphabetical order; without labelled documents the language is
null; repeated rows are scored alike; an empty table gives an empty result;
rows are packed in a struct, so no column name clashes.
"""

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import text_slices
from .html_extract import extract
from .scratch import saved

BUCKETS = 1 << 15
EFFECTIVE = 60              # trigrams a text counts for at most
MOST_LANGUAGES = 256        # bound of the model: BUCKETS counts per language
HOST_WEIGHT, DOMAIN_WEIGHT = 10.0, 20.0     # pseudo-pages of the parent's prior
SMOOTH = 0.5
DECLARED = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]{2,3})\b", re.I)
META = re.compile(r"<meta\b[^>]*?http-equiv\s*=\s*[\"']?content-language[\"']?[^>]*?content\s*=\s*[\"']?([A-Za-z]{2,3})\b", re.I)


def trigrams(texts):
    """(bucket of every character trigram, trigrams per text); digits and marks do not count."""
    plain = [" " + " ".join(re.findall(r"[^\W\d_]+", (t or "").lower())) + " " for t in texts]
    lengths = np.array([len(p) for p in plain], np.int64)
    codes = np.frombuffer("".join(plain).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    if len(codes) < 3:
        return np.empty(0, np.int64), np.zeros(len(texts), np.int64)
    mixed = (codes[:-2] * np.uint64(0x9E3779B97F4A7C15) + codes[1:-1]) * np.uint64(0xC2B2AE3D27D4EB4F) + codes[2:]
    bucket = ((mixed * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)
    owner = np.repeat(np.arange(len(plain)), lengths)
    inner = owner[:-2] == owner[2:]
    return bucket[inner], np.bincount(owner[:-2][inner], minlength=len(plain))


def trigram_counts(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, bucket, n) over all labelled documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {}
        for batch in batches:
            at = 0
            for part in text_slices(batch.column(1)):
                names = batch.column(0).slice(at, len(part)).to_pylist()
                at += len(part)
                buckets, counts = trigrams(part.to_pylist())
                owner = np.repeat(np.arange(len(names)), counts)
                for name in set(names) - {None}:
                    own = np.array([n == name for n in names])
                    total[name] = total.get(name, 0) + np.bincount(buckets[own[owner]], minlength=BUCKETS)
        for name, counts in total.items():
            seen = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(seen), pa.string()), pa.array(seen, pa.int32()), pa.array(counts[seen], pa.int64())], ["lang", "bucket", "n"])

    own = docs.select(F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").alias("text")).where("lang is not null")
    return own.mapInArrow(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, text: str = "text", lang: str = "lang"):
    """(languages in alphabetical order, log-probability of each bucket per language)."""
    counts, _ = saved(trigram_counts(docs, text, lang), "trigrams")
    names = sorted(r["lang"] for r in counts.select("lang").distinct().limit(MOST_LANGUAGES + 1).collect())
    if len(names) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages are declared")
    table = np.full((len(names), BUCKETS), SMOOTH)
    for r in counts.toLocalIterator():          # at most MOST_LANGUAGES * BUCKETS rows, one at a time
        table[names.index(r["lang"]), r["bucket"]] += r["n"]
    return names, np.log(table / table.sum(axis=1, keepdims=True))


def log_likelihoods(texts, model):
    """Tempered log-likelihood of every text under every language."""
    buckets, counts = trigrams(texts)
    sums = np.stack([segment_sums_float(row[buckets], counts) for row in model], axis=1)
    return sums * np.minimum(1.0, EFFECTIVE / np.maximum(counts, 1))[:, None]


def segment_sums_float(values, lengths):
    total = np.concatenate([[0.0], np.cumsum(values)])
    ends = np.cumsum(lengths)
    return total[ends] - total[ends - lengths]


def softmax(logits: Column) -> Column:
    """Probabilities of an array of log scores."""
    shifted = F.transform(logits, lambda x: F.exp(x - F.array_max(logits)))
    return F.transform(shifted, lambda x: x / F.aggregate(shifted, F.lit(0.0), lambda a, y: a + y))


def scored(pages: DataFrame, names, model, html: str = "html", url: str = "url", carry=None) -> DataFrame:
    """row, host, domain, suffix, declared, and the text's log-likelihoods and posterior."""
    sent = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            declared, scores = [], []
            for part in text_slices(batch):
                pages_ = [p or "" for p in part.to_pylist()]
                tags = [DECLARED.search(p) or META.search(p) for p in pages_]
                declared += [t.group(1).lower() if t else "" for t in tags]
                scores += log_likelihoods([extract(p) for p in pages_], sent.value).tolist()
            yield pa.StructArray.from_arrays([pa.array(declared, pa.string()), pa.array(scores, pa.list_(pa.float64()))], ["declared", "loglik"])

    read = F.arrow_udf(run, "struct<declared: string, loglik: array<double>>")
    address = F.lower(F.coalesce(F.col(f"`{url}`"), F.lit("")))
    host = F.regexp_extract(address, r"^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1)
    row = F.struct(*[F.col(f"`{c}`") for c in carry or pages.columns]).alias("row")
    found = pages.select(row, host.alias("host"), read(F.col(f"`{html}`")).alias("found"))
    return found.select("row", "host", F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1).alias("domain"), F.regexp_extract("host", r"\.([^.]+)$", 1).alias("suffix"),
                        F.when(F.col("found.declared").isin(list(names)), F.col("found.declared")).otherwise("").alias("declared"),
                        F.col("found.loglik").alias("loglik")).withColumn("q", softmax(F.col("loglik")))


def identified(pages: DataFrame, docs: DataFrame, html: str = "html", url: str = "url", text: str = "text", lang: str = "lang", carry=None) -> DataFrame:
    """row (the columns ``carry``, by default all), declared, text_lang, lang and probability for every row of ``pages``."""
    names, model = fit(docs, text, lang)
    if not names:
        row = F.struct(*[F.col(f"`{c}`") for c in carry or pages.columns]).alias("row")
        none = F.lit(None).cast("string")
        return pages.select(row, F.lit("").alias("declared"), none.alias("text_lang"), none.alias("lang"), F.lit(None).cast("double").alias("probability"))
    n = len(names)
    own, _ = saved(scored(pages, names, model, html, url, carry), "scored")
    languages = F.lit(list(names))
    sums = [F.sum(F.get("q", F.lit(k))).alias(f"s{k}") for k in range(n)]
    again = [F.sum(f"s{k}").alias(f"s{k}") for k in range(n)]
    mass = F.array(*[F.col(f"s{k}") for k in range(n)])
    # one pass over the pages; everything else is summed from these groups
    groups, _ = saved(own.groupBy("host", "domain", "suffix", "declared").agg(F.count(F.lit(1)).alias("n"), *sums), "hosts")
    total = groups.agg(F.sum("n").alias("n"), *again).first()
    whole = [float(total[f"s{k}"] or 0.0) + SMOOTH for k in range(n)]
    base = F.lit([w / sum(whole) for w in whole])
    mixed = lambda part, size, parent, weight: F.zip_with(part, parent, lambda s, p: (s + weight * p) / (size + weight))
    domains = groups.groupBy("domain").agg(F.sum("n").alias("n"), *again).select("domain", mixed(mass, F.col("n"), base, DOMAIN_WEIGHT).alias("domain_prior"))
    hosts = groups.groupBy("host").agg(F.sum("n").alias("host_n"), *again).select("host", "host_n", mass.alias("host_mass"))

    def rates(column):
        """log P(value of the column | language); an absent value says nothing."""
        values = groups.groupBy(column).agg(*again).select(column, mass.alias("m"))
        count = values.count()
        of = F.zip_with("m", F.lit(whole), lambda s, t: F.log((s + SMOOTH) / (t + SMOOTH * (count + 1))))
        return values.select(column, F.when(F.col(column) == "", F.lit([0.0] * n)).otherwise(of).alias(f"{column}_rate"))

    joined = (own.join(hosts, "host").join(domains, "domain").join(rates("declared"), "declared").join(rates("suffix"), "suffix"))
    others = F.zip_with("host_mass", "q", lambda s, q: F.greatest(s - q, F.lit(0.0)))
    prior = F.when(F.col("host") == "", base).otherwise(mixed(others, F.col("host_n") - 1, F.col("domain_prior"), HOST_WEIGHT))
    add = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    logits = add(add(add(F.col("loglik"), F.col("declared_rate")), F.col("suffix_rate")), F.transform(prior, lambda p: F.log(p)))
    fused = joined.withColumn("logits", logits).withColumn("p", softmax(F.col("logits")))
    best = lambda scores: F.get(languages, (F.array_position(scores, F.array_max(scores)) - 1).cast("int"))
    return fused.select("row", "declared", best(F.col("loglik")).alias("text_lang"), best(F.col("logits")).alias("lang"), F.array_max("p").alias("probability"))
