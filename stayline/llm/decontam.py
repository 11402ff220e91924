"""Benchmark decontamination with training suffix arrays.

Every task turns its documents into shards: words become numbers of the
benchmark's vocabulary, stretches of known words that are too short to hold a
window are dropped, and the suffixes of the rest are sorted by prefix
doubling.  All test suffixes are binary-searched in every shard: the range
that agrees on a whole window gives all its locations.  From every location the
longest verbatim match is extended: the place of the document's suffix among
the sorted test suffixes is found, and the longer agreement with its two
neighbours is the match.  ``decontaminate`` removes the documents in which a
location was found.  Agreements are lengths found by halving over prefix hashes
(two primes of 31 bits), so memory does not grow with the length of items or
matches.  ``longest_matches`` lists them by test suffix.

The benchmark is a stated query set.  It is sent to the tasks in blocks of at
most ``BLOCK_WORDS`` words, so that its size is bounded whatever its length;
each shard meets every block.

Defined cases: a null text has no words and is not contaminated; an item
without words is no window; a null item_id counts as the empty id, equal ids
count once; whole texts of any length are searched; an empty table or
benchmark gives no hits.  Rows of ``docs`` pass through packed in a struct, so
no column name clashes.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import spans_index, text_slices

BLOCK_WORDS = 1_000_000     # benchmark words per broadcast block (about 60 MB)
SHARD_BYTES = 16_000_000    # document text per suffix array
PART = 4_000_000            # of a long text, split into words at once

#: Bytes outside words become spaces, A to Z lower case; bytes from 128 on belong to words.
WORD_BYTES = bytes(b if b >= 128 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256))


def words_of(text):
    """Words of a text as bytes, in parts that bound the memory held."""
    raw = text.encode("utf-8", "surrogatepass").translate(WORD_BYTES)
    at = 0
    while at < len(raw):
        cut = len(raw) if len(raw) - at <= PART else raw.rfind(b" ", at, at + PART) + 1
        if cut <= at:
            cut = raw.find(b" ", at + PART) + 1 or len(raw)
        yield raw[at:cut].split()
        at = cut


PRIME, BASES = (1 << 31) - 1, (1_000_003, 998_244_353)


def powers(n):
    """The bases' powers 0 .. n - 1."""
    out = np.ones((len(BASES), max(n, 1)), np.int64)
    for row, base in zip(out, BASES):
        done, step = 1, base
        while done < n:
            more = min(done, n - done)
            row[done:done + more] = row[:more] * step % PRIME
            done, step = done + more, step * step % PRIME
    return out


class Words:
    """Word numbers with a 0 after each stretch, and hashes of their prefixes."""

    def __init__(self, ids):
        self.ids, stops = ids, np.flatnonzero(ids == 0)
        self.left = np.zeros(len(ids), np.int64)            # words up to the next 0
        upto = stops[-1] + 1 if len(stops) else 0
        self.left[:upto] = np.repeat(stops, np.diff(stops, prepend=-1)) - np.arange(upto)
        value = (ids.astype(np.int64) * 2_654_435_761 + 97) % PRIME
        self.sums = [np.concatenate([[0], np.cumsum(value * pw % PRIME)]) % PRIME for pw in powers(len(ids))]


def agreement(x, i, y, j, pw):
    """Words that the stretches from x[i] and y[j] have in common."""
    low, high, top = np.zeros(len(i), np.int64), np.minimum(x.left[i], y.left[j]), pw.shape[1] - 1
    while (low < high).any():
        n = (low + high + 1) // 2
        same = np.ones(len(i), bool)
        for sx, sy, p in zip(x.sums, y.sums, pw):
            same &= (sx[i + n] - sx[i]) % PRIME * p[top - i] % PRIME == (sy[j + n] - sy[j]) % PRIME * p[top - j] % PRIME
        low, high = np.where(same, n, low), np.where(same, high, n - 1)
    return low


def longest_agreement(x, i, y, order, pw):
    """(words, place in y) of the longest agreement of each stretch from x[i] with
    the suffixes of y at ``order``, which is sorted: one of its two neighbours."""
    low, high = np.zeros(len(i), np.int64), np.full(len(i), len(order), np.int64)
    while (open_ := low < high).any():
        middle = np.minimum((low + high) // 2, len(order) - 1)
        spot = order[middle]
        n = agreement(x, i, y, spot, pw)
        before = y.ids[spot + n] < x.ids[i + n]
        low, high = np.where(open_ & before, middle + 1, low), np.where(open_ & ~before, middle, high)
    best, where = np.zeros(len(i), np.int64), np.zeros(len(i), np.int64)
    for side in (low - 1, low):
        spot = order[np.clip(side, 0, len(order) - 1)]
        n = agreement(x, i, y, spot, pw)
        best, where = np.maximum(best, n), np.where(n > best, spot, where)
    return best, where


def suffix_order(ids, depth):
    """Positions of ``ids`` sorted by the words up to the next 0 (and ``depth`` at most)."""
    stop = ids == 0
    rank = np.where(stop, np.cumsum(stop) - 1, int(stop.sum()) + ids).astype(np.int64)
    order, step = np.argsort(rank, kind="stable"), 1
    while step < depth and len(rank):
        key = rank * (int(rank.max()) + 2)
        key[:-step] += rank[step:] + 1
        order = np.argsort(key, kind="stable")
        new = np.empty(len(rank), np.int64)
        new[order] = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        rank, step = new, 2 * step
        if rank[order[-1]] == len(rank) - 1:
            break
    return order


class Block:
    """Test suffixes of some benchmark items, as numbers of their vocabulary (from 1)."""

    def __init__(self, items, window):
        self.vocab, self.names = {}, sorted({name for name, _ in items})
        number = {name: i for i, name in enumerate(self.names)}
        texts = [np.array([self.vocab.setdefault(w, len(self.vocab) + 1) for w in words], np.int32) for _, words in items]
        self.depth = max(map(len, texts))
        self.flat = np.concatenate([np.append(t, np.int32(0)) for t in texts])
        starts = np.cumsum([0] + [len(t) + 1 for t in texts])
        self.words, self.window = Words(self.flat), window
        order = suffix_order(self.flat, self.depth)
        self.sorted = order[self.words.left[order] >= window]
        suffixes = {}
        for (name, _), text, start in zip(items, texts, starts):
            size = min(window, len(text))
            suffixes.setdefault(size, []).append(np.stack([
                start + np.arange(len(text) - size + 1), np.full(len(text) - size + 1, number[name]),
                len(text) - np.arange(len(text) - size + 1), np.arange(len(text) - size + 1)]))
        # per window size: the distinct windows, and the items that hold each
        self.groups, self.least = [], min(suffixes)
        for size, parts in sorted(suffixes.items()):
            at, item, left, place = np.concatenate(parts, axis=1)
            grid = np.lib.stride_tricks.sliding_window_view(self.flat, size)[at]
            order = np.lexsort(grid.T[::-1])
            new = np.concatenate([[True], (np.diff(grid[order], axis=0) != 0).any(axis=1)])
            window_of = np.empty(len(at), np.int64)
            window_of[order] = np.cumsum(new) - 1
            held = np.unique(window_of * len(self.names) + item)
            self.groups.append({"size": size, "windows": grid[order[new]], "at": at, "item": item, "left": left, "place": place,
                                "window_of": window_of, "owners": held % len(self.names),
                                "owner_count": np.bincount(held // len(self.names), minlength=int(new.sum()))})


def opened(sent):
    """The block of a broadcast, which carries plain data only."""
    block = Block.__new__(Block)
    block.__dict__.update(sent.value)
    words = Words.__new__(Words)
    words.__dict__.update(block.words)
    block.words = words
    return block


def plain(block):
    return {**vars(block), "words": vars(block.words)}


def blocks_of(spark, benchmark: DataFrame, window: int, item_id="item_id", text="text"):
    """Broadcast blocks of the benchmark, read piece by piece."""
    own = benchmark.select(F.coalesce(F.col(f"`{item_id}`").cast("string"), F.lit("")).alias("item"), F.col(f"`{text}`").alias("text"))
    blocks, held, size = [], [], 0
    for row in own.where("text is not null").toLocalIterator():
        words = [w for part in words_of(row["text"]) for w in part]
        if words:
            held.append((row["item"], words))
            size += len(words)
        if size > BLOCK_WORDS:
            blocks.append(spark.sparkContext.broadcast(plain(Block(held, window))))
            held, size = [], 0
    if held:
        blocks.append(spark.sparkContext.broadcast(plain(Block(held, window))))
    return blocks


class Shard:
    """Suffix array over the stretches of benchmark words in some documents."""

    def __init__(self, texts, block):
        get, parts, owner, place, self.n_words = block.vocab.get, [], [], [], []
        for i, text in enumerate(texts):
            seen = 0
            own = []
            for words in words_of(text or ""):
                own.append(np.fromiter((get(w, 0) for w in words), np.int32, len(words)))
                seen += len(words)
            self.n_words.append(seen)
            ids = np.concatenate([*own, np.zeros(1, np.int32)])
            # stretches of known words with at least ``least`` of them, and the 0 after each
            stops = np.flatnonzero(ids == 0)
            length = np.diff(stops, prepend=-1) - 1
            keep = length >= block.least
            at = spans_index(stops[keep] - length[keep], length[keep] + 1)
            parts.append(ids[at])
            place.append(at)
            owner.append(np.full(len(at), i))
        self.ids, self.place, self.owner = np.concatenate(parts), np.concatenate(place), np.concatenate(owner)
        self.words = Words(self.ids)
        self.order = suffix_order(self.ids, block.depth)
        self.order = self.order[self.words.left[self.order] >= block.least]
        self.padded = np.concatenate([self.ids, np.zeros(block.window, np.int32)])

    def bound(self, rows, above):
        """Insertion points of equally long word rows, after equals if ``above``."""
        low, high = np.zeros(len(rows), np.int64), np.full(len(rows), len(self.order), np.int64)
        span, each = np.arange(rows.shape[1]), np.arange(len(rows))
        while (open_ := low < high).any():
            middle = np.minimum((low + high) // 2, max(len(self.order) - 1, 0))
            here = self.padded[self.order[middle][:, None] + span]
            differs = here != rows
            first = differs.argmax(axis=1)
            a, b = here[each, first], rows[each, first]
            before = (a < b) | (above & (a == b))
            low, high = np.where(open_ & before, middle + 1, low), np.where(open_ & ~before, middle, high)
        return low

    def found(self, block):
        """(hit words per document, sorted item names per document, matches); a match
        is a document, its place there and its words."""
        docs = len(self.n_words)
        marks, pairs, matches = np.zeros(len(self.padded) + 1, np.int64), [], []
        if len(self.order):
            for g in block.groups:
                low, high = self.bound(g["windows"], False), self.bound(g["windows"], True)
                at = self.order[spans_index(low, high - low)]
                begins = np.unique(at)
                words = np.full(len(begins), g["size"])
                if g["size"] == block.window and len(begins):
                    words = longest_agreement(self.words, begins, block.words, block.sorted, powers(max(len(self.ids), len(block.flat)) + 1))[0]
                matches.append((self.owner[begins], self.place[begins], words))
                np.add.at(marks, at, 1)
                np.add.at(marks, at + g["size"], -1)
                window = np.unique(self.owner[at] * len(low) + np.repeat(np.arange(len(low)), high - low))
                many = g["owner_count"][window % len(low)]
                first = (np.cumsum(g["owner_count"]) - g["owner_count"])[window % len(low)]
                item = g["owners"][spans_index(first, many)]
                pairs.append(np.unique(np.repeat(window // len(low), many) * len(block.names) + item))
        hit = np.cumsum(marks)[: len(self.ids)] > 0
        pairs = np.unique(np.concatenate(pairs)) if pairs else np.empty(0, np.int64)
        names = [[] for _ in range(docs)]
        for doc, item in zip((pairs // len(block.names)).tolist(), (pairs % len(block.names)).tolist()):
            names[doc].append(block.names[item])
        return [(self.owner[hit], self.place[hit])], names, matches

    def longest(self, block):
        """Longest match of every test suffix whose window occurs: (item, its start, words, document, its start)."""
        out = []
        for g in block.groups if len(self.order) else []:
            low, high = self.bound(g["windows"], False), self.bound(g["windows"], True)
            some = np.flatnonzero((high > low)[g["window_of"]])
            if not len(some):
                continue
            pw = powers(max(len(self.ids), len(block.flat)) + 1)
            best, where = longest_agreement(block.words, g["at"][some], self.words, self.order, pw)
            out.extend(zip((block.names[i] for i in g["item"][some].tolist()), g["place"][some].tolist(), best.tolist(),
                           self.owner[where].tolist(), self.place[where].tolist()))
        return out


def searched(docs: DataFrame, benchmark: DataFrame, window: int = 10, text: str = "text", bench_id: str = "item_id", bench_text: str = "text") -> DataFrame:
    """``row`` (the input row) and ``found``: n_words, n_hit, the sorted items with
    occurring windows, and the longest verbatim match that begins at a window's
    location: its words (0 if there is none) and the first place of one so long
    (its word's number from 0; null if there is none)."""
    blocks = blocks_of(docs.sparkSession, benchmark, window, bench_id, bench_text)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [found(part.to_pylist()) for part in text_slices(batch, SHARD_BYTES)]
            yield pa.concat_arrays(parts)

    def found(texts):
        kind = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())), ("longest", pa.int64()), ("longest_at", pa.int64())])
        hits, names, matches, n_words = [], [set() for _ in texts], [], None
        for block in map(opened, blocks):
            shard = Shard(texts, block)
            own, items, more_matches = shard.found(block)
            matches.extend(more_matches)
            n_words = shard.n_words
            hits.extend(own)
            for held, more in zip(names, items):
                held.update(more)
        if n_words is None:
            n_words = [sum(len(p) for p in words_of(t or "")) for t in texts]
        n_hit = np.zeros(len(texts), np.int64)
        if hits:
            owner, place = (np.concatenate(x) for x in zip(*hits))
            spot = np.unique((owner.astype(np.int64) << 40) | place)
            n_hit = np.bincount(spot >> 40, minlength=len(texts))
        longest, longest_at = np.zeros(len(texts), np.int64), [None] * len(texts)
        if matches:
            owner, place, words = (np.concatenate(x).astype(np.int64) for x in zip(*matches))
            order = np.lexsort((place, -words, owner))
            first = order[np.flatnonzero(np.diff(owner[order], prepend=-1))]
            longest[owner[first]] = words[first]
            for i, at in zip(owner[first].tolist(), place[first].tolist()):
                longest_at[i] = at
        return pa.StructArray.from_arrays([pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array([sorted(n) for n in names], pa.list_(pa.string())),
                                           pa.array(longest), pa.array(longest_at, pa.int64())], fields=list(kind))

    search = F.arrow_udf(run, "struct<n_words: bigint, n_hit: bigint, items: array<string>, longest: bigint, longest_at: bigint>")
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), search(F.col(f"`{text}`")).alias("found"))


def longest_matches(docs: DataFrame, benchmark: DataFrame, window: int = 10, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """For every test suffix with an occurring window: the longest verbatim
    match in all documents and one place of it.  Each shard gives one place; of
    equally long ones the least xxhash64 of the doc_id decides, then the least
    start."""
    blocks = blocks_of(docs.sparkSession, benchmark, window)
    own = docs.select(F.col(f"`{doc_id}`").cast("string").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    names = ["item_id", "item_start", "n_words", "doc_id", "doc_start"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in text_slices(batch.column(1), SHARD_BYTES):
                ids = batch.column(0).slice(at, len(part)).to_pylist()
                at += len(part)
                for block in map(opened, blocks):
                    rows = [(i, s, n, ids[d], p) for i, s, n, d, p in Shard(part.to_pylist(), block).longest(block)]
                    columns = list(zip(*rows)) if rows else [[]] * 5
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64()))], names)

    found = own.mapInArrow(run, "item_id string, item_start long, n_words long, doc_id string, doc_start long")
    best = F.max_by(F.struct("n_words", "doc_id", "doc_start"), F.struct("n_words", F.negative(F.xxhash64("doc_id")), F.negative("doc_start")))
    return found.groupBy("item_id", "item_start").agg(best.alias("b")).select("item_id", "item_start", "b.*")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, text: str = "text") -> DataFrame:
    """The rows of ``docs`` without a location of a verbatim match that holds a window."""
    return searched(docs, benchmark, window, text).where("found.longest = 0").select("row.*")
