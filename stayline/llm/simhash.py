"""SimHash near-duplicates by tiled exact comparison.

A fingerprint's bit is set if more than half of the 64-bit hashes of the
text's word shingles set it.  The distinct fingerprints are sorted by the bit
counts of their eight bytes and cut into tiles; a tile pair is skipped when
the bit counts of the two (lower and upper bounds per byte) are further apart
than the radius, because every differing bit changes one of them by one.  The
other pairs are compared in full with numpy exclusive-or and bit counts,
block by block, where the same bound skips pairs of blocks.  Nothing is
approximate, and no group of copies is expanded into pairs: a tile pair gives
at most one link per fingerprint (a spanning forest), and distributed
components join them.

Defined cases: a null or wordless text has fingerprint zero, which links like
any other; a text of fewer words than a shingle is one shingle; rows with
equal ids or texts give a row each; the component of rows that all have a null
id is null; an empty table gives an empty result.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import text_slices
from .components import connected_components
from .scratch import saved

SEED = 42
SHINGLE, RADIUS = 3, 3
LEAST_TILE, MOST_TILE, TILES = 4096, 1 << 20, 128   # rows per tile: rows / TILES within these bounds
BLOCK = 256                                         # fingerprints that share a bound inside a tile
HASHES = 1 << 20                                    # hashes turned into bits at once


def fingerprint(text, shingle=SHINGLE):
    """Unsigned 64-bit fingerprint of one text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(b" ".join(words), SEED)
    total, n = np.zeros(64, np.int64), len(words) - shingle + 1
    for a in range(0, n, HASHES):
        part = words[a:min(a + HASHES, n) + shingle - 1]
        hashes = np.array([digest(b" ".join(w), SEED) for w in zip(*(part[k:] for k in range(shingle)))], ">u8")
        total += np.unpackbits(hashes.view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > n).tobytes(), "big")


def fingerprints(shingle: int = SHINGLE):
    """Column function text -> bigint holding the fingerprint's 64 bits."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            bits = [fingerprint(t, shingle) for part in text_slices(batch) for t in part.to_pylist()]
            yield pa.array(np.array(bits, np.uint64).view(np.int64))

    return F.arrow_udf(run, "bigint")


def byte_counts(prints):
    """Bit counts of the eight bytes of each fingerprint."""
    return np.bitwise_count(prints.astype(">u8").view(np.uint8).reshape(-1, 8)).astype(np.int8)


def gap(low_a, high_a, low_b, high_b):
    """Least possible distance between two groups with these byte-count bounds."""
    return np.maximum(np.maximum(low_b - high_a, low_a - high_b), 0).sum(axis=-1, dtype=np.int32)


def bounds(prints, size):
    counts, starts = byte_counts(prints), np.arange(0, len(prints), size)
    return np.minimum.reduceat(counts, starts), np.maximum.reduceat(counts, starts)


def link(label, a, b):
    """Join the classes of a[i] and b[i]; ``label`` holds each node's smallest known node."""
    while True:
        a, b = label[a], label[b]
        differ = a != b
        if not differ.any():
            return
        a, b = np.maximum(a, b)[differ], np.minimum(a, b)[differ]
        np.minimum.at(label, a, b)
        while not np.array_equal(label[label], label):
            label[:] = label[label]


def forest(a, b, radius, same):
    """(members, roots) linking all fingerprints of tiles ``a`` and ``b`` that lie within ``radius``."""
    whole = a if same else np.concatenate([a, b])
    label, shift = np.arange(len(whole)), 0 if same else len(a)
    low_a, high_a = bounds(a, BLOCK)
    low_b, high_b = (low_a, high_a) if same else bounds(b, BLOCK)
    for i in range(len(low_a)):
        near = np.flatnonzero(gap(low_a[i], high_a[i], low_b, high_b) <= radius)
        near = near[near >= i] if same else near
        rows = a[i * BLOCK:(i + 1) * BLOCK]
        for k in range(0, len(near), 16):
            columns = (near[k:k + 16, None] * BLOCK + np.arange(BLOCK)).ravel()
            columns = columns[columns < len(b)]
            for r in range(0, len(rows), 64):
                close = np.bitwise_count(rows[r:r + 64, None] ^ b[columns]) <= radius
                x, y = np.nonzero(close)
                if len(x):
                    link(label, x + (i * BLOCK + r), columns[y] + shift)
    member = np.flatnonzero(label != np.arange(len(whole)))
    return whole[member], whole[label[member]]


def tiles_of(prints: DataFrame, rows: int) -> DataFrame:
    """Distinct fingerprints (column fp) as sorted tiles: tile, low, high, fps."""
    size = min(max(LEAST_TILE, -(-rows // TILES)), MOST_TILE)
    key = sum((F.bit_count(F.shiftrightunsigned("fp", 8 * (7 - k)).bitwiseAND(255)).cast("long") * (16 ** (7 - k)) for k in range(8)), F.lit(0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = TaskContext.get().partitionId() << 32, np.empty(0, np.int64)

        def tile(part):
            own = part.view(np.uint64)
            low, high = bounds(own, len(own))
            return pa.RecordBatch.from_pydict({"tile": pa.array([number], pa.int64()), "low": pa.array([low.tobytes()]), "high": pa.array([high.tobytes()]),
                                               "fps": pa.array([part.tobytes()])})

        for batch in batches:
            held = np.concatenate([held, batch.column(0).to_numpy()])
            while len(held) >= size:
                yield tile(held[:size])
                held, number = held[size:], number + 1
        if len(held):
            yield tile(held)

    spread = prints.withColumn("key", key).repartitionByRange(max(1, -(-rows // size)), "key", "fp").sortWithinPartitions("key", "fp")
    return spread.select("fp").mapInArrow(run, "tile long, low binary, high binary, fps binary")


def links(prints: DataFrame, rows: int, radius: int = RADIUS) -> DataFrame:
    """Edges (a, b) that connect all distinct fingerprints within ``radius``."""
    spark = prints.sparkSession
    tiles, _ = saved(tiles_of(prints, rows), "tiles")
    # bounds of tiles, not fingerprints: at most rows / LEAST_TILE + partitions of 24 bytes
    known = sorted((r["tile"], r["low"], r["high"]) for r in tiles.select("tile", "low", "high").toLocalIterator())
    edge = lambda k: np.array([np.frombuffer(x[k], np.int8) for x in known]).reshape(-1, 8)
    sent = spark.sparkContext.broadcast((np.array([x[0] for x in known], np.int64), edge(1), edge(2)))

    def partners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, low, high = sent.value
        for batch in batches:
            for tile, fps in zip(batch.column(0).to_pylist(), batch.column(1)):
                i = int(np.searchsorted(number, tile))
                near = number[i:][gap(low[i], high[i], low[i:], high[i:]) <= radius]
                for other in near.tolist():
                    yield pa.RecordBatch.from_pydict({"tile": pa.array([other]), "from": pa.array([tile]), "own": pa.array([fps.as_py()])})

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, same in zip(batch.column(0), batch.column(1), batch.column(2).to_pylist()):
                member, root = forest(np.frombuffer(a.as_py(), np.uint64), np.frombuffer(b.as_py(), np.uint64), radius, same)
                yield pa.RecordBatch.from_arrays([pa.array(member.view(np.int64)), pa.array(root.view(np.int64))], ["a", "b"])

    pairs = tiles.select("tile", "fps").mapInArrow(partners, "tile long, from long, own binary").join(tiles.select("tile", "fps"), "tile")
    return pairs.select("own", "fps", (F.col("from") == F.col("tile")).alias("same")).mapInArrow(compare, "a long, b long")


def classes(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """fp, root and component_id of every distinct fingerprint in ``prints`` (doc_id, fp)."""
    first, _ = saved(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "prints")
    found = connected_components(links(first.select("fp"), first.count(), radius))
    rooted = first.join(found, first["fp"] == found["node"], "left").select("fp", "first", F.coalesce("component", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return rooted.join(least, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fp (64 bits as bigint), component_id for every row of ``docs``."""
    own, _ = saved(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), fingerprints(shingle)(F.col(f"`{text}`")).alias("fp")), "fingerprints")
    return own.join(classes(own, radius), "fp").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``docs`` per group of near-duplicates: the one with the smallest id.

    Where several rows have that id (repeated rows, or only null ids), the one
    with the smallest fingerprint stays, and of equals the one whose row hash
    is smallest.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    own, _ = saved(docs.select(row, F.col(f"`{doc_id}`").alias("doc_id"), fingerprints(shingle)(F.col(f"`{text}`")).alias("fp")), "fingerprints")
    found, _ = saved(classes(own.select("doc_id", "fp"), radius), "classes")
    firsts = (own.groupBy("fp", "doc_id").agg(F.count(F.lit(1)).alias("copies"))
              .join(found, (F.col("doc_id").eqNullSafe(F.col("component_id"))) & (own["fp"] == found["fp"]))
              .groupBy("root").agg(F.min_by(F.struct(own["fp"].alias("at"), F.col("doc_id").alias("first"), "copies"), own["fp"]).alias("w")).select("w.*"))
    # the key is fingerprint and id, so that a group of copies is spread by its ids
    kept = own.join(firsts, (own["fp"] == F.col("at")) & F.col("doc_id").eqNullSafe(F.col("first"))).select("row", "at", "copies")
    once = kept.where("copies = 1").select("row")
    more = kept.where("copies > 1").groupBy("at").agg(F.min_by("row", F.xxhash64("row")).alias("row")).select("row")
    return once.unionAll(more).select("row.*")
