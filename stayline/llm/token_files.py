"""Token ids in binary files: byte-aligned codes with separate control bytes.

Ids are replaced by their rank in the corpus (0 for the most frequent), so
frequent ids take one byte.  A rank takes one to four bytes, little end first;
the two-bit lengths of four ranks form a control byte.  Control and data bytes
lie apart, so a whole block is decoded by table lookup in numpy.

Layout of a written folder:
  ranks/   id of every rank (at most the vocabulary)
  blocks/  one row per block of documents, in ascending doc_id order within a
           shard and across shards: shard, block, start (ids before it in the
           shard), doc_ids, lengths (little-endian int64), control, data.
A document's control bytes start anew; unused slots of its last one are 0.

Defined cases: a null text is empty and holds the end id only; null doc_ids
come first; rows of equal id lie in the order of a hash of their ids; an empty
table gives empty folders that read back as no rows; other columns are not
written.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .batches import text_slices
from .bpe import Encoder, Tables
from .scratch import drop, saved
from .varbyte import pack, unpack

BLOCK_IDS = 1 << 19         # a block ends with the document that reaches this


def encoded(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """Rows of documents (doc_id, ids: little-endian unsigned integers of two or four
    bytes, the end id last) and one row per task with the ids it has written
    (``seen``, ``times``)."""
    counts = T.ArrayType(T.LongType())
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("ids", T.BinaryType()), T.StructField("seen", counts), T.StructField("times", counts)])
    tables = Tables(path)       # about 2 MB, sent along instead of read from the file in every task
    kind = id_kind(tables, end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, total, key = Encoder(path, tables), np.zeros(0, np.int64), None
        for batch in batches:
            at, key = 0, batch.schema.field(0).type
            for part in text_slices(batch.column(1)):
                flat, lengths = encoder.encode(part.to_pylist())
                flat = np.insert(flat, np.cumsum(lengths), end_id).astype(kind)
                own = np.bincount(flat, minlength=len(total))
                own[:len(total)] += total
                total = own
                ends = np.concatenate([[0], np.cumsum(lengths + 1)]) * flat.itemsize
                ids = pa.BinaryArray.from_buffers(pa.binary(), len(part), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(flat.tobytes())])
                none = pa.nulls(len(part), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(part)), ids, none, none], schema.names)
                at += len(part)
        seen = np.flatnonzero(total)
        if len(seen):
            yield pa.RecordBatch.from_arrays([pa.nulls(1, key), pa.nulls(1, pa.binary()), pa.array([seen], pa.list_(pa.int64())), pa.array([total[seen]], pa.list_(pa.int64()))], schema.names)

    return docs.mapInArrow(run, schema)


def id_kind(tables, end_id):
    return "<u2" if max(tables.size, end_id + 1) <= 1 << 16 else "<u4"


def flat_ids(array, kind):
    """(ids, ids per row) of an Arrow binary array."""
    offsets = np.frombuffer(array.buffers()[1], np.int32)[array.offset:array.offset + len(array) + 1].astype(np.int64)
    raw = np.frombuffer(array.buffers()[2], np.uint8)[offsets[0]:offsets[-1]] if len(array) and offsets[-1] > offsets[0] else np.empty(0, np.uint8)
    return np.frombuffer(raw.tobytes(), kind), np.diff(offsets) // np.dtype(kind).itemsize


def write_token_files(docs: DataFrame, folder: str, path: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> None:
    """Encode all texts and write them to ``folder``."""
    spark = docs.sparkSession
    own = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    # the order of rows of equal id is fixed before the ids are written
    table, held = saved(encoded(own, path, end_id).withColumn("tie", F.xxhash64("ids")), "ids")
    kind = id_kind(Tables(path), end_id)
    each = F.explode(F.arrays_zip("seen", "times")).alias("x")
    counts = table.where("seen is not null").select(each).groupBy(F.col("x.seen").alias("id")).agg(F.sum("x.times").alias("n")).collect()      # at most the vocabulary
    order = [r["id"] for r in sorted(counts, key=lambda r: (-r["n"], r["id"]))]
    spark.createDataFrame([(i, v) for i, v in enumerate(order)], "rank int, id int").coalesce(1).write.parquet(f"{folder}/ranks")
    rank_of = np.zeros(max(order, default=0) + 1, np.int64)
    rank_of[order] = np.arange(len(order))
    sent = spark.sparkContext.broadcast(rank_of)
    key = T.StructField("doc_id", own.schema["doc_id"].dataType)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Codes the documents of a shard and cuts them into blocks."""
        shard, block, start, n, held = TaskContext.get().partitionId(), 0, 0, 0, []

        def one():
            ids, lengths, control, data = zip(*held)
            lengths = np.concatenate(lengths)
            return pa.RecordBatch.from_pydict({
                "shard": pa.array([shard], pa.int32()), "block": pa.array([block], pa.int32()), "start": pa.array([start], pa.int64()),
                "n": pa.array([n], pa.int64()), "doc_ids": pa.ListArray.from_arrays(pa.array([0, len(lengths)], pa.int32()), pa.concat_arrays(ids)),
                "lengths": pa.array([lengths.astype("<i8").tobytes()]), "control": pa.array([b"".join(control)]), "data": pa.array([b"".join(data)])})

        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                flat, lengths = flat_ids(part.column(1), kind)
                control, data, c_size, d_size = pack(sent.value[flat], lengths)
                c_at, d_at, n_at = (np.concatenate([[0], np.cumsum(x)]) for x in (c_size, d_size, lengths))
                at = 0
                while at < len(lengths):
                    # up to and with the document that fills the block
                    to = min(int(np.searchsorted(n_at, n_at[at] + BLOCK_IDS - n)), len(lengths))
                    held.append((part.column(0).slice(at, to - at), lengths[at:to], control[c_at[at]:c_at[to]].tobytes(), data[d_at[at]:d_at[to]].tobytes()))
                    n += int(n_at[to] - n_at[at])
                    at = to
                    if n >= BLOCK_IDS:
                        yield one()
                        block, start, n, held = block + 1, start + n, 0, []
        if held:
            yield one()

    schema = T.StructType([T.StructField("shard", T.IntegerType()), T.StructField("block", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("n", T.LongType()),
                           T.StructField("doc_ids", T.ArrayType(key.dataType)), T.StructField("lengths", T.BinaryType()), T.StructField("control", T.BinaryType()), T.StructField("data", T.BinaryType())])
    docs_only = table.where("seen is null").select("doc_id", "ids", "tie")
    (docs_only.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").drop("tie")
     .mapInArrow(blocks, schema).write.option("compression", "none").parquet(f"{folder}/blocks"))
    drop(spark, held)


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), ids (little-endian unsigned 32-bit integers)."""
    ranks = spark.read.parquet(f"{folder}/ranks").orderBy("rank").collect()      # at most the vocabulary
    sent = spark.sparkContext.broadcast(np.array([r["id"] for r in ranks], "<u4"))
    files = spark.read.parquet(f"{folder}/blocks")
    totals = sorted((r["shard"], r["n"]) for r in files.groupBy("shard").agg(F.sum("n").alias("n")).collect())   # one row per shard
    before, bases = 0, []
    for shard, n in totals:
        bases.append((shard, before))
        before += n
    base = F.broadcast(spark.createDataFrame(bases, "shard int, base long"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                first, doc_ids, lengths, control, data = (batch.column(k)[row] for k in range(5))
                lengths = np.frombuffer(lengths.as_py(), "<i8")
                ids = sent.value[unpack(np.frombuffer(control.as_py(), np.uint8), np.frombuffer(data.as_py(), np.uint8), lengths)]
                ends = np.cumsum(lengths)
                cut = pa.BinaryArray.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer((4 * np.concatenate([[0], ends])).astype(np.int32)), pa.py_buffer(ids.tobytes())])
                yield pa.RecordBatch.from_arrays([doc_ids.values, pa.array(first.as_py() + ends - lengths, pa.int64()), cut], ["doc_id", "start", "ids"])

    kind = files.schema["doc_ids"].dataType.elementType
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("start", T.LongType()), T.StructField("ids", T.BinaryType())])
    placed = files.join(base, "shard").select((F.col("start") + F.col("base")).alias("first"), "doc_ids", "lengths", "control", "data")
    return placed.mapInArrow(run, schema)
