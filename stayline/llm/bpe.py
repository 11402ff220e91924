"""BPE encoding and decoding with batched numpy merge rounds.

A vocabulary file of the tokenizers library is read into numpy tables.  The
symbols of many pre-tokens lie in one flat array; a round looks up every
neighbouring pair in a hashed table of the pair keys, takes in each
pre-token the pair of lowest rank, and merges all its occurrences at once.
Rounds go on until no pre-token holds a known pair.  Each distinct pre-token
is merged once per task; documents gather their ids from that store.

Defined cases: a null text is an empty text (no ids, decoded as the empty
string); texts of any length are encoded whole; repeated rows and documents
are encoded alike; an empty table gives an empty result; all other columns
pass through, and the output column replaces one of the same name.
"""

import json
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import cached_property
from itertools import count, islice
from os.path import commonprefix

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .batches import Flat, segment_sums, spans_index, text_slices

#: The pre-token patterns of the two vocabulary kinds.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

# From here on, the library and the installed regex module may follow
# different Unicode versions; such chunks go through the library's own splitter.
FIRST_DISPUTED = "՘"
CACHE_LIMIT = 700_000       # distinct chunks or pre-tokens kept by a task
DECODE_IDS = 400_000        # ids turned into text at once


def byte_alphabet():
    """Character that stands for each byte in byte-level vocabularies: itself
    if printable, else the next code point from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    chars = {b: chr(b) for b in plain}
    for k, b in enumerate(b for b in range(256) if b not in chars):
        chars[b] = chr(256 + k)
    return [chars[b] for b in range(256)]


def home(keys, slots):
    """The slot, of a power of two, at which the search for a key begins."""
    return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(65 - slots.bit_length())).astype(np.int64)


def hashed(keys):
    """Table of slots holding places of distinct keys, -1 where free; a key lies in
    the first slot from its home on that was free."""
    slots = np.full(1 << (max(len(keys), 2).bit_length() + 2), -1, np.int32)
    todo, slot = np.arange(len(keys)), home(keys, len(slots))
    while todo.size:
        free = todo[slots[slot[todo]] < 0]
        slots[slot[free]] = free
        todo = todo[slots[slot[todo]] != todo]
        slot[todo] = (slot[todo] + 1) & (len(slots) - 1)
    return slots


class Tables:
    """Numpy tables of one vocabulary file."""

    def __init__(self, path):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        self.path, self.by_words = path, bool(suffix)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        alphabet = byte_alphabet()
        self.first = np.array([vocab[c] for c in alphabet], np.int32)
        self.last = np.array([vocab[c + suffix] for c in alphabet], np.int32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([(vocab[a] << 32) | vocab[b] for a, b in pairs], np.int64)
        # the last listing of a pair holds, as in a map filled in order
        order = np.lexsort((-np.arange(len(keys)), keys))
        order = order[np.concatenate([[True], np.diff(keys[order]) != 0])]
        merged = np.array([vocab[a + b] for a, b in pairs], np.int32)
        self.keys, self.ranks, self.merged = keys[order], order.astype(np.int32), merged[order]
        self.slots = hashed(self.keys)
        self.size = 1 + max([*vocab.values(), *self.special.values()])

    @cached_property
    def tokens(self):
        """(bytes of all tokens, where each begins, length of each), for decoding."""
        with open(self.path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        suffix = model.get("end_of_word_suffix") or ""
        cut, byte_of = len(suffix), {c: b for b, c in enumerate(byte_alphabet())}
        text = [b""] * self.size
        for token, i in model["vocab"].items():
            body = token[:-cut] if cut and token.endswith(suffix) else token
            text[i] = bytes(byte_of[c] for c in body) if all(c in byte_of for c in body) else body.encode()
        for token, i in self.special.items():
            text[i] = token.encode()
        length = np.array([len(t) for t in text], np.int64)
        return np.frombuffer(b"".join(text), np.uint8), np.cumsum(length) - length, length

    def merge_rounds(self, words):
        """Ids of byte strings: (flat ids, ids per word)."""
        length = np.array([len(w) for w in words], np.int64)
        if not length.any():
            return np.empty(0, np.int64), length
        raw = np.frombuffer(b"".join(words), np.uint8)
        symbol, word = self.first[raw], np.repeat(np.arange(len(words), dtype=np.int32), length)
        ends = np.cumsum(length)[length > 0] - 1
        symbol[ends] = self.last[raw[ends]]
        # index of the pair that each symbol opens, -1 if there is none
        pair = np.full(len(symbol), -1, np.int32)
        if len(symbol) > 1:
            inner = np.flatnonzero(word[:-1] == word[1:])
            pair[inner] = self.pair_index(symbol[inner], symbol[inner + 1])
        done_symbol, done_word = [], []
        while symbol.size:
            position = np.flatnonzero(pair >= 0)
            active = np.zeros(len(words), bool)
            active[word[position]] = True
            keep = active[word]
            done_symbol.append(symbol[~keep])
            done_word.append(word[~keep])
            if not position.size:
                break
            at, owner = pair[position], word[position]
            rank = self.ranks[at]
            starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            lowest = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.append(starts, len(owner))))
            chosen = rank == lowest
            position, at = position[chosen], at[chosen]
            # in a run such as "aaa" the pairs overlap: take every other one
            here = np.arange(len(position))
            opens = np.concatenate([[True], np.diff(position) != 1])
            alternate = (here - np.maximum.accumulate(np.where(opens, here, 0))) % 2 == 0
            position, at = position[alternate], at[alternate]
            symbol[position] = self.merged[at]
            keep[position + 1] = False
            # only the pairs at a merged symbol and before it are new
            new = np.zeros(len(symbol), bool)
            new[position] = True
            new[np.maximum(position - 1, 0)] |= position > 0
            symbol, word, pair, new = symbol[keep], word[keep], pair[keep], new[keep]
            merged = np.flatnonzero(new)
            new[np.maximum(merged - 1, 0)] |= merged > 0        # the symbol before may have gone
            again = np.flatnonzero(new)
            pair[again] = -1
            again = again[again + 1 < len(word)]
            again = again[word[again] == word[again + 1]]
            pair[again] = self.pair_index(symbol[again], symbol[again + 1])
        symbol, word = np.concatenate(done_symbol), np.concatenate(done_word)
        order = np.argsort(word, kind="stable")
        return symbol[order], np.bincount(word, minlength=len(words))

    def pair_index(self, left, right):
        """Place of each pair among the pair keys, -1 if it is none of them."""
        key = (left.astype(np.int64) << 32) | right
        slot = home(key, len(self.slots))
        found = self.slots[slot]
        off = np.flatnonzero((found >= 0) & (self.keys[found] != key))
        while off.size:         # another key's slot: look at the next one
            slot[off] = (slot[off] + 1) & (len(self.slots) - 1)
            found[off] = self.slots[slot[off]]
            off = off[(found[off] >= 0) & (self.keys[found[off]] != key[off])]
        return found

    def decode(self, ids, lengths):
        """Texts of documents given as flat ids and ids per document."""
        flat, start, length = self.tokens
        size = length[ids]
        raw = flat[spans_index(start[ids], size)].tobytes()
        ends = np.cumsum(segment_sums(size, lengths)).tolist()
        return [raw[a:b].decode("utf-8", "replace") for a, b in zip([0, *ends], ends)]


def newest(known, before):
    """The strings that a numbering took in since it held ``before``, in order."""
    return list(islice(reversed(known), len(known) - before))[::-1]


class PreTokens:
    """Splits texts into numbered pre-tokens.

    A text is first cut at every space that a visible character follows; no
    pre-token crosses such a cut, so each distinct chunk is split only once.
    """

    def __init__(self, tables):
        self.tables = tables
        by_words = tables.by_words
        self.pattern = regex.compile(WORD_PATTERN if by_words else BYTE_PATTERN)
        self.loose = regex.compile(r" (?!\S)")
        self.cut = regex.compile(r" (?=\S)")
        self.uneven = re.compile(r" (?!\S)")        # finds all that loose does (its white space is a superset), faster
        self.disputed = re.compile(f"[{FIRST_DISPUTED}-\U0010ffff]")
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(tables.special, key=len, reverse=True))) + ")") if tables.special else None
        # what every special string begins with, so that most texts are passed over quickly
        self.opens = commonprefix(list(tables.special)) if tables.special else ""
        self.library = self.normalizer = None
        self.clear()

    def clear(self):
        # maps that number strings in order of first sight; both kinds of pieces share the chunks' numbers
        chunk = count().__next__
        self.head, self.rest, self.word, self.words = defaultdict(chunk), defaultdict(chunk), defaultdict(count().__next__), []
        self.store, self.fresh, self.marks = Flat(), [], {}
        for content in self.tables.special:
            self.marks[content] = chunk()
            self.store.append(self.word_numbers([content]), [1])

    def word_numbers(self, tokens):
        numbers = np.fromiter(map(self.word.__getitem__, tokens), np.int64, len(tokens))
        self.words += newest(self.word, len(self.words))
        return numbers

    def piece_numbers(self, known, pieces, prefix=""):
        """Chunk numbers of pieces; new chunks wait in ``fresh`` until they are learned."""
        before = len(known)
        numbers = np.fromiter(map(known.__getitem__, pieces), np.int64, len(pieces))
        self.fresh += [prefix + p for p in newest(known, before)]
        return numbers

    def split(self, chunk):
        if not self.disputed.search(chunk):
            return self.pattern.findall(chunk)
        if self.library is None:
            from tokenizers import Tokenizer
            self.library = Tokenizer.from_file(self.tables.path).pre_tokenizer
        return [chunk[a:b] for _, (a, b) in self.library.pre_tokenize_str(chunk)]

    def learn(self):
        """Store the pre-tokens of the fresh chunks.  Chunks that open with a space and a
        visible character are split together: no pre-token crosses such a cut, so their ends are found
        by counting characters."""
        chunks, self.fresh = self.fresh, []
        if not chunks:
            return
        plain = np.array([c[0] == " " and len(c) > 1 and not c[1].isspace() and c not in self.marks for c in chunks])
        if self.disputed.search("".join(chunks)):
            plain &= [not self.disputed.search(c) for c in chunks]
        letters = plain & np.array([c[1:].isalpha() for c in chunks])       # one pre-token
        words = [c[1:] if self.tables.by_words else c for c, p in zip(chunks, letters.tolist()) if p]
        plain &= ~letters
        joined = [c for c, p in zip(chunks, plain.tolist()) if p]
        text = "".join(joined)
        tokens = self.pattern.findall(text)
        counts = letters.astype(np.int64)
        together = self.word_numbers(tokens)
        if self.tables.by_words:        # white space is no token: count by the tokens' own places
            starts = np.fromiter((m.start() for m in self.pattern.finditer(text)), np.int64, len(tokens))
        else:
            sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
            starts = np.cumsum(sizes) - sizes
        ends = np.cumsum(np.fromiter(map(len, joined), np.int64, len(joined)))
        counts[plain] = np.diff(np.searchsorted(starts, ends), prepend=0)
        alone = ~(plain | letters)
        single = [self.split(c) for c, p in zip(chunks, alone.tolist()) if p]
        counts[alone] = [len(x) for x in single]
        flat = np.empty(int(counts.sum()), np.int64)
        flat[np.repeat(plain, counts)] = together
        flat[np.repeat(letters, counts)] = self.word_numbers(words)
        flat[np.repeat(alone, counts)] = self.word_numbers([w for x in single for w in x])
        self.store.append(flat, counts)

    def normalize(self, text):
        """Composed and lower-cased, character by character, as the word vocabulary's
        file asks; its white-space rule is implied by the splitting.  Characters on
        which Unicode versions may differ go through the library's own normalizer."""
        import unicodedata
        if self.disputed.search(text):
            if self.normalizer is None:
                from tokenizers import Tokenizer
                self.normalizer = Tokenizer.from_file(self.tables.path).normalizer
            return self.normalizer.normalize_str(text)
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def is_plain(self, text):
        """Whether the chunks end at every space, and only there."""
        return bool(text) and not (self.special and self.opens in text) and (self.tables.by_words or not self.uneven.search(text))

    def plain_numbers(self, texts):
        """(flat chunk numbers, chunks per text) of plain texts; each distinct piece is looked up once."""
        lists = pc.split_pattern(pa.array(texts, pa.string()), " ")
        counts = lists.value_lengths().to_numpy().astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        words, at = coded.dictionary.to_numpy(zero_copy_only=False), coded.indices.to_numpy()
        heads = np.cumsum(counts) - counts
        kept = np.ones(len(at), bool)
        kept[heads] = False
        used = np.flatnonzero(np.bincount(at[kept], minlength=len(words)))
        place = np.full(len(words), -1)
        place[used] = self.piece_numbers(self.rest, words[used].tolist(), " ")
        numbers = place[at]
        first = words[at[heads]].tolist()
        begun = np.array([w != "" for w in first], bool)
        numbers[heads[begun]] = self.piece_numbers(self.head, [w for w in first if w])
        kept[heads] = begun
        return numbers[kept], counts - ~begun

    def chunk_numbers(self, text):
        parts = self.special.split(text) if self.special and self.opens in text else [text]
        numbers = []
        for part in parts:
            if part in self.marks:
                numbers.append(self.marks[part])
                continue
            if self.tables.by_words:
                part = self.normalize(part)
                pieces = part.split(" ")
            else:
                pieces = self.cut.split(part) if self.loose.search(part) else part.split(" ")
            if pieces[0]:
                numbers.extend(self.piece_numbers(self.head, pieces[:1]).tolist())
            numbers.extend(self.piece_numbers(self.rest, pieces[1:], " ").tolist())
        return numbers

    def codes(self, texts):
        """(flat pre-token numbers, pre-tokens per text); null counts as empty."""
        numbers, counts = self.numbers(texts)
        codes, sizes = self.store.gather(numbers)
        return codes, segment_sums(sizes, counts)

    def numbers(self, texts):
        """(flat numbers of learned chunks, chunks per text)."""
        if max(self.store.n, len(self.words)) > CACHE_LIMIT:
            self.clear()
        plain = np.array([self.is_plain(t) for t in texts], bool)
        together = [t for t, p in zip(texts, plain.tolist()) if p]
        together, many = self.plain_numbers([self.normalize(t) for t in together] if self.tables.by_words else together)
        single = [self.chunk_numbers(t) if t else [] for t, p in zip(texts, plain.tolist()) if not p]
        counts = np.zeros(len(texts), np.int64)
        counts[plain], counts[~plain] = many, [len(x) for x in single]
        numbers = np.empty(int(counts.sum()), np.int64)
        of = np.repeat(plain, counts)
        numbers[of], numbers[~of] = together, [n for x in single for n in x]
        self.learn()
        return numbers, counts


class Encoder:
    """Ids of texts; keeps the ids of the pre-tokens and chunks it has met."""

    def __init__(self, path, tables=None):
        self.tables = tables or Tables(path)
        self.split = PreTokens(self.tables)
        self.known, self.chunks, self.words = Flat(), Flat(), None

    def encode(self, texts):
        """(flat ids, ids per text)."""
        numbers, counts = self.split.numbers(texts)
        if self.words is not self.split.words:      # the splitter began a new numbering
            self.words, self.known, self.chunks = self.split.words, Flat(), Flat()
        fresh = self.words[self.known.n:]
        if fresh:
            special = self.tables.special
            marks = [i for i, w in enumerate(fresh) if w in special]
            ids, lengths = self.tables.merge_rounds([b"" if w in special else w.encode() for w in fresh])
            if marks:
                at = (np.cumsum(lengths) - lengths)[marks]
                ids, lengths = np.insert(ids, at, [special[fresh[i]] for i in marks]), lengths.copy()
                lengths[marks] = 1
            self.known.append(ids, lengths)
        codes, sizes = self.split.store.gather(np.arange(self.chunks.n, self.split.store.n))
        ids, lengths = self.known.gather(codes)
        self.chunks.append(ids, segment_sums(lengths, sizes))
        ids, lengths = self.chunks.gather(numbers)
        return ids, segment_sums(lengths, counts)


def list_array(flat, lengths, kind):
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))


def decoded_texts(tables, ids, lengths):
    """Texts of documents as an Arrow array, a bounded number of ids at once."""
    ends = np.cumsum(lengths)
    cuts = [0, *np.flatnonzero(np.diff(ends // DECODE_IDS) != 0) + 1, len(lengths)]
    parts = [pa.array(tables.decode(ids[ends[a] - lengths[a]:ends[b - 1]], lengths[a:b]), pa.string()) for a, b in zip(cuts, cuts[1:]) if a < b]
    return pa.concat_arrays(parts) if parts else pa.array([], pa.string())


def with_columns(docs: DataFrame, keep, added, make) -> DataFrame:
    """``docs`` cut to ``keep``, with ``added`` columns (name -> type) made from
    each Arrow batch by the function that ``make()`` gives once per task; it
    yields (rows of the batch, new arrays), so that large batches leave in parts."""
    keep = [c for c in keep if c not in added]
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(n, t) for n, t in added.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            for rows, arrays in step(batch):
                yield pa.RecordBatch.from_arrays([rows.column(rows.schema.get_field_index(c)) for c in keep] + arrays, schema.names)

    return docs.mapInArrow(run, schema)


def text_steps(batch, text):
    """(rows, texts) of a batch in parts."""
    at = 0
    for part in text_slices(batch.column(batch.schema.get_field_index(text))):
        yield batch.slice(at, len(part)), part.to_pylist()
        at += len(part)


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the ids of its whole texts in column ``ids``."""
    def make():
        encoder = Encoder(path)
        return lambda batch: ((rows, [list_array(*encoder.encode(texts), pa.int32())]) for rows, texts in text_steps(batch, text))

    return with_columns(docs, docs.columns, {ids: T.ArrayType(T.IntegerType())}, make)


def decode(encoded: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its ids in column ``text``; null ids give the empty string."""
    def make():
        tables = Tables(path)

        def step(batch):
            lists = batch.column(batch.schema.get_field_index(ids))
            lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            yield batch, [decoded_texts(tables, lists.flatten().to_numpy(zero_copy_only=False), lengths)]
        return step

    return with_columns(encoded, encoded.columns, {text: T.StringType()}, make)


def round_trip(docs: DataFrame, path: str, keep, text: str = "text") -> DataFrame:
    """Columns ``keep`` of ``docs``, the ids of its texts, and the texts decoded
    from those ids, in one pass (encode and decode without shipping the ids twice)."""
    def make():
        encoder = Encoder(path)

        def step(batch):
            for rows, texts in text_steps(batch, text):
                ids, lengths = encoder.encode(texts)
                yield rows, [list_array(ids, lengths, pa.int32()), decoded_texts(encoder.tables, ids, lengths)]
        return step

    return with_columns(docs, keep, {"ids": T.ArrayType(T.IntegerType()), "decoded": T.StringType()}, make)


def ids_digest(ids: Column) -> Column:
    """Lowercase hex SHA-256 of the decimal ids joined by commas."""
    return F.sha2(F.array_join(ids.cast("array<string>"), ","), 256)


def digests(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: id, number of ids, digest of the ids, digest of the text decoded from them."""
    own = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return round_trip(own, path, ["doc_id"]).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        ids_digest(F.col("ids")).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
