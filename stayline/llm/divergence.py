"""How sources of a language differ in their words: pair tasks merge sparse counts.

Terms are runs of letters (A-Z lower-cased, every character beyond ASCII).  A
language keeps the terms of at least ``least_docs`` of its documents.  A group
(language, source) gives each kept term a smoothed share in billionths,

    p = 1 + floor(10^9 * (count + 2) / (N + 2 * V)),

N being the group's count of kept terms and V their number; the same holds for
a whole language.  Two shares p and q differ by floor((p - q)^2 / (p + q)).

* ``pairs``: the sum over all kept terms for every two sources of a language.
  A group's counts lie in sorted (term id, count) arrays, cut into blocks of
  ids so that no array grows with the vocabulary.  One task row per unordered
  pair and block holds both arrays; a galloping intersection finds the common
  ids (the shorter array is searched in the longer one), and common,
  one-sided and absent terms are priced apart -- all absent terms of a pair
  have one price, charged once at the end.  The price is symmetric, so a pair
  is priced once and reported both ways.
* ``terms``: the terms that a source uses more than its language.

All arithmetic is on integers and exact.  Documents are counted in one pass
with counts combined inside each task, so a source or a word that holds a third
of all rows costs one row per task and term.

Defined cases: a null text, language or source is ''; a text of any length is
read whole, a piece at a time; a group without kept terms is priced at the
shares of count 0, and with V = 0 at 0; ties in value rank by the item's bytes;
repeated rows count each; an empty table gives an empty result; other columns
are not read.
"""

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .numbering import numbered
from .scratch import saved

LEAST_DOCS = 10
TOP_TERMS = 10
BILLION = 1_000_000_000
BLOCK = 12              # term ids per block: 2 to this power
PIECE = 4_000_000       # bytes of text split at once
HELD = 400_000          # counts a task holds before it hands them on

#: Every byte that is no letter ends a term; A-Z become a-z.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, in lists of bounded size; a term is never cut."""
    start = 0
    while start < len(text):
        end = min(start + PIECE, len(text))
        piece = text[start:end].translate(LETTERS)
        if end < len(text):
            cut = piece.rfind(b" ") + 1
            if cut:
                piece, end = piece[:cut], start + cut
            else:                       # one term longer than a piece
                rest = text[end:].translate(LETTERS)
                length = rest.find(b" ")
                end = len(text) if length < 0 else end + length
                piece = text[start:end].translate(LETTERS)
        yield piece.split()
        start = end


def counted(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents; term '' stands for the group itself."""
    schema = "lang string, source string, term binary, n long, docs long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, held = {}, 0

        def flushed():
            for (own_lang, own_source), (n, of) in groups.items():
                found = [b"", *n]
                yield pa.RecordBatch.from_arrays([
                    pa.array([own_lang] * len(found), pa.string()), pa.array([own_source] * len(found), pa.string()), pa.array(found, pa.binary()),
                    pa.array([0, *n.values()], pa.int64()), pa.array([0, *map(of.__getitem__, n)], pa.int64())], ["lang", "source", "term", "n", "docs"])

        for batch in batches:
            texts = batch.column(0).cast(pa.binary())
            for value, own_lang, own_source in zip(texts, batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                key = (own_lang, own_source)
                if key not in groups:
                    groups[key] = (Counter(), Counter())
                n, of = groups[key]
                before, met = len(n), set()
                for words in terms_of(value.as_py()):
                    n.update(words)
                    met.update(words)
                of.update(met)
                held += len(n) - before
                if held > HELD:
                    yield from flushed()
                    groups, held = {}, 0
        yield from flushed()

    filled = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c2) for c, c2 in ((text, "text"), (lang, "lang"), (source, "source"))])
    return filled.mapInArrow(run, schema).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


class Profile:
    """The kept counts of a corpus: tables ``counts`` (lang, source, term, id, n),
    ``langs`` (lang, term, id, n) and ``groups`` (lang, source, total, lang_total, terms)."""

    def __init__(self, docs: DataFrame, least_docs: int = LEAST_DOCS, text: str = "text", lang: str = "lang", source: str = "source"):
        every, _ = saved(counted(docs, text, lang, source), "term-counts")
        known = every.where(F.length("term") > 0)
        kept = known.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).where(F.col("docs") >= least_docs)
        self.langs, _ = saved(numbered(kept.drop("docs"), "lang", ["term"], "id", "terms"), "kept-terms")
        self.counts, _ = saved(known.select("lang", "source", "term", "n").join(self.langs.drop("terms"), ["lang", "term"]), "kept-counts")
        own = self.counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        whole = self.langs.groupBy("lang").agg(F.sum("lang_n").alias("lang_total"), F.max("terms").alias("terms"))
        groups = every.where(F.length("term") == 0).select("lang", "source").join(own, ["lang", "source"], "left").join(whole, "lang", "left")
        self.groups, _ = saved(groups.na.fill(0, ["total", "lang_total", "terms"]), "groups")


def share_column(count: Column, total: Column, terms: Column) -> Column:
    """p of a count as a column (exact for counts beyond 10^9)."""
    wide = lambda c: c.cast("decimal(20,0)")
    return F.lit(1) + F.call_function("div", F.lit(BILLION).cast("decimal(10,0)") * (wide(count) + 2), wide(total) + wide(terms) * 2)


def price_column(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def share(count, total, terms):
    """p of an array of counts: 10^9 / (N + 2V) by long division, three digits at a time."""
    whole = total + 2 * terms
    rest, quotient = np.asarray(count, np.int64) + 2, 0
    for _ in range(3):
        part, rest = np.divmod(rest * 1000, whole)
        quotient = quotient * 1000 + part
    return quotient + 1


def price(p, q):
    return (p - q) ** 2 // (p + q)


def gallop(a, b):
    """Positions (in a, in b) of the common ids of two sorted arrays: the ids of the
    shorter one are searched in the longer one, each from the place of the one before."""
    if len(a) > len(b):
        at_b, at_a = gallop(b, a)
        return at_a, at_b
    at = np.searchsorted(b, a)
    met = np.flatnonzero(at < len(b))
    met = met[b[at[met]] == a[met]]
    return met, at[met]


def merge(a_ids, a_n, b_ids, b_n, a_total, b_total, terms):
    """(price of the terms that either group uses, how many those are) in one block."""
    both_a, both_b = gallop(a_ids, b_ids)
    pa_, pb = share(a_n, a_total, terms), share(b_n, b_total, terms)
    none_a, none_b = share(0, a_total, terms), share(0, b_total, terms)
    only_a, only_b = np.ones(len(pa_), bool), np.ones(len(pb), bool)
    only_a[both_a], only_b[both_b] = False, False
    total = price(pa_[both_a], pb[both_b]).sum() + price(pa_[only_a], none_b).sum() + price(pb[only_b], none_a).sum()
    return int(total), len(pa_) + len(pb) - len(both_a)


def arrays(counts: DataFrame) -> DataFrame:
    """(lang, source, block, terms_at): the sorted (id, n) of a group, a block of ids at a time."""
    entries = F.sort_array(F.collect_list(F.struct("id", "n")))
    blocks = counts.groupBy("lang", "source", F.shiftright("id", BLOCK).alias("block")).agg(entries.alias("e"))
    return blocks.select("lang", "source", "block", F.col("e.id").alias("ids"), F.col("e.n").alias("ns"))


def pairs(profile: Profile) -> DataFrame:
    """(lang, source, item, value) of every two sources of a language, both ways."""
    groups = profile.groups
    side = lambda s: groups.select("lang", F.col("source").alias(s), F.col("total").alias(f"{s}_total"), *(["terms"] if s == "a" else []))
    asked, _ = saved(side("a").join(side("b"), "lang").where("a < b"), "pairs")         # the rows that are asked for, once each
    blocks, _ = saved(arrays(profile.counts), "arrays")

    def of(s, names):
        return blocks.join(asked.select("lang", "a", "b"), (blocks["lang"] == asked["lang"]) & (blocks["source"] == asked[s])).select(
            asked["lang"], "a", "b", "block", F.col("ids").alias(names[0]), F.col("ns").alias(names[1]))

    # co-grouped by pair and block: a side without terms there is null
    met = of("a", ("a_ids", "a_ns")).join(of("b", ("b_ids", "b_ns")), ["lang", "a", "b", "block"], "full").join(asked, ["lang", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [(c.offsets.to_numpy(), c.values.to_numpy(zero_copy_only=False)) for c in map(batch.column, range(3, 7))]
            totals = [batch.column(k).to_numpy() for k in range(7, 10)]
            sums, used = [], []
            for i in range(batch.num_rows):
                a_ids, a_n, b_ids, b_n = (values[offsets[i]:offsets[i + 1]] for offsets, values in lists)
                value, n = merge(a_ids, a_n, b_ids, b_n, *(int(t[i]) for t in totals))
                sums.append(value)
                used.append(n)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sums, pa.int64()), pa.array(used, pa.int64())], ["lang", "a", "b", "value", "used"])

    none = F.array().cast("array<bigint>")
    filled = met.select("lang", "a", "b", *[F.coalesce(c, none).alias(c) for c in ("a_ids", "a_ns", "b_ids", "b_ns")], "a_total", "b_total", "terms")
    found = filled.mapInArrow(run, "lang string, a string, b string, value long, used long").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("used").alias("used"))
    whole = asked.join(found, ["lang", "a", "b"], "left").na.fill(0, ["value", "used"])
    absent = F.when(F.col("terms") > 0, (F.col("terms") - F.col("used")) * price_column(
        share_column(F.lit(0), F.col("a_total"), F.greatest("terms", F.lit(1))), share_column(F.lit(0), F.col("b_total"), F.greatest("terms", F.lit(1))))).otherwise(F.lit(0))
    priced = whole.select("lang", "a", "b", (F.col("value") + absent).alias("value"))
    both = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("x")
    return priced.select("lang", "value", both).select("lang", "x.source", "x.item", "value")


def terms(profile: Profile) -> DataFrame:
    """(lang, source, item, value) of the terms a source uses more than its language."""
    held = profile.counts.join(profile.groups, ["lang", "source"])
    shares = held.select("lang", "source", "term", share_column(F.col("n"), F.col("total"), F.col("terms")).alias("p"),
                         share_column(F.col("lang_n"), F.col("lang_total"), F.col("terms")).alias("q"))
    return shares.where("p > q").select("lang", "source", F.col("term").cast("string").alias("item"), price_column(F.col("p"), F.col("q")).alias("value"))


def divergence(docs: DataFrame, least_docs: int = LEAST_DOCS, top_terms: int = TOP_TERMS, **columns) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank: every other source
    of the language, and the ``top_terms`` words of the source, by falling value."""
    profile = Profile(docs, least_docs, **columns)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    ranked = lambda rows, part: rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    return ranked(pairs(profile), "pair").unionAll(ranked(terms(profile), "term").where(F.col("rank") <= top_terms))
