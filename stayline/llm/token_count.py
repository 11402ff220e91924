"""Token counts without token ids.

1. Each task splits its documents into pre-tokens and keeps, for a chunk of
   documents, the per-document frequencies (numbers into the chunk's list of
   distinct pre-tokens).  Both go to one table in the shared scratch folder.
2. The chunks' lists are dealt and sorted by pre-token, so that each distinct
   one of the whole corpus is counted in pieces once, and every chunk that
   lists it gets the count (one shuffle of strings for count and join).
3. The counts are gathered per chunk and joined to the frequencies; a
   document's tokens are the sum of frequency x pieces.

A pre-token is one row per chunk, whatever the number of its documents, so a
hot word is a small run of rows that its task streams through.

Defined cases: a null text has 0 bytes and 0 tokens; special strings inside a
text count as one token, as the library does by default; repeated rows and ids
give a row each; an empty table gives an empty result; other columns are not
read.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .batches import segment_sums, text_slices
from .bpe import PreTokens, Tables
from .varbyte import LENGTHS, pack, unpack

CHUNK_DOCS, CHUNK_BYTES = 16384, 64_000_000     # a chunk ends at either
ROWS = 50_000                                   # dictionary rows per Arrow batch
PIECE = 1 << 18                                 # numbers coded at once, a multiple of four


class Chunk:
    """Frequencies of some documents over one numbering of pre-tokens."""

    NAMES = ("chunk", "code", "pretoken", "doc_ids", "n_bytes", "n_distinct", "codes", "times")

    def __init__(self, number, words):
        self.number, self.words = number, words
        self.ids, self.sizes, self.codes, self.times, self.distinct, self.docs, self.bytes = [], [], [], [], [], 0, 0

    def add(self, ids, texts, codes, counts):
        """Documents with their pre-token numbers, ``counts`` of them each."""
        owner = np.repeat(np.arange(len(texts), dtype=np.int64), counts)
        key, times = np.unique((owner << 32) | codes, return_counts=True)     # by document, then number
        self.codes.append((key & 0xFFFFFFFF).astype(np.int32))
        self.times.append(times.astype(np.int32))
        self.distinct.append(np.bincount(key >> 32, minlength=len(texts)).astype(np.int32))
        self.ids.append(ids)
        self.sizes.append(pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64()))
        self.docs += len(texts)
        self.bytes += texts.nbytes

    def is_full(self, more):
        return self.docs > 0 and (self.docs + more > CHUNK_DOCS or self.bytes > CHUNK_BYTES)

    def batch(self, *columns):
        return pa.RecordBatch.from_arrays([pa.array([self.number] * len(columns[0]), pa.int64()), *columns], self.NAMES)

    def batches(self):
        """The distinct pre-tokens, then the row of frequency lists."""
        if not self.docs:
            return
        code, times, distinct = (np.concatenate(x) for x in (self.codes, self.times, self.distinct))
        self.codes, self.times = [], []
        occurs = np.zeros(len(self.words), bool)
        occurs[code] = True
        used, ids = np.flatnonzero(occurs), pa.concat_arrays(self.ids)
        for a in range(0, len(used), ROWS):
            words = [self.words[i] for i in used[a:a + ROWS].tolist()]
            none = [pa.nulls(len(words), t) for t in (pa.list_(ids.type), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(), pa.binary())]
            yield self.batch(pa.array(range(a, a + len(words)), pa.int32()), pa.array(words, pa.string()), *none)
        code = (np.cumsum(occurs, dtype=np.int32) - 1)[code]
        steps, opens = np.diff(code, prepend=np.int32(0)), (np.cumsum(distinct, dtype=np.int64) - distinct)[distinct > 0]
        steps[opens] = code[opens]          # codes of a document as differences
        whole = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
        yield self.batch(pa.array([-1], pa.int32()), pa.array([None], pa.string()), whole(ids), whole(pa.concat_arrays(self.sizes)),
                         whole(pa.array(distinct)), pa.array([packed(steps)]), pa.array([packed(times)]))


def frequencies(docs: DataFrame, path: str) -> DataFrame:
    """Rows of two kinds for each chunk: its distinct pre-tokens (code >= 0),
    and one row (code -1) with ids, bytes and frequency lists of its documents."""
    kinds = (T.LongType(), T.IntegerType(), T.StringType(), T.ArrayType(docs.schema["doc_id"].dataType), T.ArrayType(T.LongType()),
             T.ArrayType(T.IntegerType()), T.BinaryType(), T.BinaryType())
    schema = T.StructType([T.StructField(n, k) for n, k in zip(Chunk.NAMES, kinds)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = PreTokens(Tables(path))
        chunk = Chunk(TaskContext.get().partitionId() << 32, split.words)
        for batch in batches:
            at = 0
            for texts in text_slices(batch.column(1)):
                for a in range(0, len(texts), CHUNK_DOCS):
                    some = texts.slice(a, CHUNK_DOCS)
                    codes, counts = split.codes(some.to_pylist())
                    # a chunk ends when it is full or the splitter began a new numbering
                    if chunk.words is not split.words or chunk.is_full(len(some)):
                        yield from chunk.batches()
                        chunk = Chunk(chunk.number + 1, split.words)
                    chunk.add(batch.column(0).slice(at, len(some)), some, codes, counts)
                    at += len(some)
        yield from chunk.batches()

    return docs.mapInArrow(run, schema)


def packed(numbers):
    parts = [pack(numbers[a:a + PIECE], np.array([len(numbers[a:a + PIECE])]))[:2] for a in range(0, len(numbers), PIECE)]
    return b"".join([c.tobytes() for c, _ in parts] + [d.tobytes() for _, d in parts])


def unpacked(raw, n):
    raw, cut = np.frombuffer(raw, np.uint8), (n + 3) // 4
    numbers, at = np.empty(n, np.int32), cut
    for a in range(0, n, PIECE):
        many = min(PIECE, n - a)
        control = raw[a // 4:(a + many + 3) // 4]
        size = int(LENGTHS[control].ravel()[:many].sum(dtype=np.int64)) + many
        numbers[a:a + many] = unpack(control, raw[at:at + size], np.array([many]))
        at += size
    return numbers


def count_pieces(listed: DataFrame, path: str) -> DataFrame:
    """(chunk, counted) of rows sorted by pre-token, counted being code << 32 | pieces; a run of equal ones is counted once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, last = Tables(path), (None, 0)
        for batch in batches:
            coded = batch.column(2).dictionary_encode()
            words = coded.dictionary.to_pylist()
            fresh = words[words[:1] == [last[0]]:]
            _, pieces = tables.merge_rounds([b"" if w in tables.special else w.encode() for w in fresh])
            counts = [last[1]] * (len(words) - len(fresh)) + [1 if w in tables.special else n for w, n in zip(fresh, pieces.tolist())]
            if words:
                last = (words[-1], counts[-1])
            counted = (batch.column(1).to_numpy().astype(np.int64) << 32) | np.array(counts, np.int64)[coded.indices.to_numpy()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counted)], ["chunk", "counted"])

    dealt = listed.repartition("pretoken").sortWithinPartitions("pretoken")
    return dealt.select("chunk", "code", "pretoken").mapInArrow(run, "chunk long, counted long")


def sum_tokens(joined: DataFrame, id_type: T.DataType) -> DataFrame:
    """A row per document from the chunks joined with their piece counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1)
                flat = lambda name: one.column(one.schema.get_field_index(name)).flatten()
                pieces, counts = np.zeros(1, np.int64), flat("counts")
                if len(counts):
                    counted = counts.to_numpy(zero_copy_only=False)
                    pieces = np.zeros(int(counted.max() >> 32) + 1, np.int64)
                    pieces[counted >> 32] = counted & 0xFFFFFFFF
                distinct = flat("n_distinct").to_numpy(zero_copy_only=False).astype(np.int64)
                steps, times = (unpacked(one.column(one.schema.get_field_index(k))[0].as_py(), int(distinct.sum())) for k in ("codes", "times"))
                codes = np.cumsum(steps)
                before = np.concatenate([[0], codes])[np.cumsum(distinct) - distinct]
                n_tokens = segment_sums(pieces[codes - np.repeat(before, distinct)] * times, distinct)
                yield pa.RecordBatch.from_arrays([flat("doc_ids"), flat("n_bytes"), pa.array(n_tokens, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    schema = T.StructType([T.StructField("doc_id", id_type), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])
    return joined.mapInArrow(run, schema)


def token_counts(docs: DataFrame, path: str, limit: int = 2048, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of ``docs``."""
    spark = docs.sparkSession
    own = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    table = scratch_path(spark, "frequencies")
    frequencies(own, path).write.option("compression", "zstd").parquet(table)
    rows = spark.read.parquet(table)
    listed = rows.where("code >= 0").select("chunk", "code", "pretoken")
    found = count_pieces(listed, path).groupBy("chunk").agg(F.collect_list("counted").alias("counts"))
    chunks = rows.where("code = -1").drop("code", "pretoken")
    whole = chunks.join(found, "chunk", "left")
    return sum_tokens(whole, own.schema["doc_id"].dataType).withColumn("over_limit", F.col("n_tokens") > limit)
