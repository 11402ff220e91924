"""Quality rules: a threshold table compiled into one Spark projection.

Each rule bounds a measure (length, symbol, stop-word or line ratio) from
below or above; ratios are compared as products, so nothing is divided.  All
measures are built-in functions over the words and lines of the whole text.

Defined cases: a null text has no words and is not kept; a text of any length
is read whole; repeated rows are judged alike; an empty table gives an empty
result.  The measures are computed beside the input row, packed in a struct,
so columns of the same names in ``docs`` neither clash nor change.
"""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The white space that ends a word, the counted symbols.
SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8

#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = sorted(set("""
    the of and to in is it that was for with as by on are this be at from an or not have which
    der die das und in den von zu mit sich des auf ist im dem nicht ein eine als auch es an
    le la les de des et en un une du que qui dans pour par sur au aux est ce pas plus
    el los las y del se con para su al lo como no por es una
""".split()))


class Rule(NamedTuple):
    """low * per <= measure <= high * per; a bound of None is open."""
    measure: str
    per: str
    low: float | None
    high: float | None


#: Production thresholds.
RULES = (
    Rule("n_words", "one", 20, None),
    Rule("word_chars", "n_words", 2.5, 11.0),
    Rule("n_symbols", "n_words", None, 0.2),
    Rule("n_exclaims", "n_words", None, 0.5),
    Rule("n_stop_words", "n_words", 0.06, None),
    Rule("n_dup_lines", "n_lines", None, 0.5),
    Rule("n_repeat_words", "n_words", None, 0.3),
)


def bind(value: Column, body) -> Column:
    """``body`` of a value that is computed once, also inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    bare = F.btrim(text, F.lit(SPACE))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, f"[{SPACE}]+"))


def count_chars(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def repeated_words(words: Column, hashes: Column) -> Column:
    """Words inside windows that occur twice or more: window hashes are sorted
    with their positions, equal neighbours are confirmed word by word, and the
    covered stretches of the found positions are added up."""
    def found(order):
        def same(x, y):
            window = lambda z: F.slice(words, z["i"] + 1, WINDOW)
            return F.coalesce((x["h"] == y["h"]) & (window(x) == window(y)), F.lit(False))
        return F.filter(order, lambda x, j: same(x, F.get(order, j - 1)) | same(x, F.get(order, j + 1)))

    def covered(at):
        step = lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get(at, j + 1) - p, F.lit(WINDOW)))
        return F.aggregate(F.transform(at, step), F.lit(0), lambda a, x: a + x)

    order = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    at = bind(order, lambda o: F.sort_array(F.transform(found(o), lambda x: x["i"])))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(bind(at, covered))


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """Columns ``row`` (the input row) and one per measure."""
    base = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    split = base.select("row", "text", words_of(F.col("text")).alias("words"),
                        F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "").alias("lines"))
    n = F.size("words")
    windows = F.when(n >= WINDOW, F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("words", i, WINDOW))))
    hashed = split.select("*", F.coalesce(windows, F.array().cast("array<bigint>")).alias("hashes"))
    stop = F.filter("words", lambda w: F.rtrim(F.lower(w), F.lit(".,;:!?")).isin(STOP_WORDS))
    long = lambda c, name: c.cast("long").alias(name)
    one = F.struct(
        F.lit(1).alias("one"), long(n, "n_words"), long(F.length(F.translate("text", SPACE, "")), "word_chars"),
        long(count_chars(F.col("text"), SYMBOLS), "n_symbols"), long(count_chars(F.col("text"), "!"), "n_exclaims"),
        long(F.size("lines"), "n_lines"), long(F.size("lines") - F.size(F.array_distinct("lines")), "n_dup_lines"),
        long(F.size(stop), "n_stop_words"), long(repeated_words(F.col("words"), F.col("hashes")), "n_repeat_words"))
    # a generated row of measures: the optimizer never moves a later filter below it, where
    # it would work out the words anew for every word
    return hashed.select("row", F.explode(F.array(one)).alias("m")).select("row", "m.*")


def verdict(rules=RULES) -> Column:
    """The threshold table as one boolean column over the measures."""
    passed = F.lit(True)
    for r in rules:
        if r.low is not None:
            passed = passed & (F.col(r.measure) >= r.low * F.col(r.per))
        if r.high is not None:
            passed = passed & (F.col(r.measure) <= r.high * F.col(r.per))
    return passed


def judged(docs: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """``row``, the measures, base_failed and kept."""
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return (measured(docs, text).withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & verdict(rules)))


def keep_good(docs: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns."""
    return judged(docs, text, rules).where("kept").select("row.*")
