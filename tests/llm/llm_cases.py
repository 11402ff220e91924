"""Shared rows for the tests of the training-data operators."""

from pyspark.sql import functions as F

LONG = "lorem ipsum dolor sit amet " * 20_000
TEXTS = [
    None, "", "   \n\t ", "one", "The quick brown fox jumps over the lazy dog and runs to the river.",
    "The quick brown fox jumps over the lazy dog and runs to the river.", LONG,
    "Écoutez: les élèves sont à l’école, n'est-ce pas?  Deux  espaces.\n\nFin", "<|endoftext|> tail <|startoftext|>",
    "日本語 ΑΣ İstanbul 12345 ½ ٣", "a b c d e f g h a b c d e f g h", "line one\nline one\n \nline two\r\nline one",
    "x" * 5000, "mail bob@example.com or 4111 1111 1111 1111", "\x1c\x85  odd spaces end ",
]


def edge_docs(spark):
    """Nulls, empty and long texts, repeated rows, a null id, and columns whose names the operators use themselves."""
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(4, TEXTS[4]), (None, TEXTS[4]), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return docs.withColumns({c: F.lit(7) for c in ("row", "found", "spans", "words", "ids", "n_words", "kept", "fp", "chunk", "position", "shard", "id", "at")})


def empty_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, row int, found int")


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)
