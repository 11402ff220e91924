"""Quality rules against a plain Python version."""

import re

from stayline.llm import quality

from llm_cases import edge_docs, empty_docs

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = SPLIT.findall(text)
    seen, repeated = {}, set()
    for i in range(len(words) - 7):
        seen.setdefault(tuple(words[i:i + 8]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            repeated.update(p for i in places for p in range(i, i + 8))
    lines = [x for x in text.split("\n") if SPLIT.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated),
            len(words) < 20 or 100 * len(repeated) > 30 * len(words))


def test_measures_and_base(spark):
    docs = edge_docs(spark)
    extra = ["a b c d e f g h i " * 3, "x " * 9, "1 2 3 4 5 6 7 8 9 1 2 3 4 5 6 7 8 0 " + "q w e r t y u i o p " * 2, "#|#|\n#|#|\n\n#|#|", "a\x0bb\x0cc\rd"]
    docs = docs.select("doc_id", "text", "found", "words").unionAll(spark.createDataFrame([(50 + i, t, 1, 1) for i, t in enumerate(extra)], "doc_id long, text string, found int, words int"))
    got = quality.judged(docs).select("row.doc_id", "row.text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept").collect()
    assert len(got) == docs.count()
    for r in got:
        assert tuple(r)[2:8] == plain(r["text"]), r["text"] and r["text"][:80]
        assert not (r["kept"] and r["base_failed"])


def test_rules(spark):
    good = ("The river runs through the old town and the people of the valley meet on the bridge in the evening "
            "to talk about what they have seen, and it is said that they know all of the stories.")
    bad = ["no stop words " * 0 + " ".join(f"blarg{i}" for i in range(40)), " | ".join(good.split()), "!! ".join(good.split()),
           "\n".join(["the cat is on the mat"] * 3 + ["and the dog too of the house we saw in it was big as can be"]), " ".join(w * 4 for w in good.split()), "too short"]
    docs = spark.createDataFrame([(0, good)] + [(i + 1, t) for i, t in enumerate(bad)], "doc_id long, text string")
    assert [r["doc_id"] for r in quality.keep_good(docs).collect()] == [0]


def test_edge_cases(spark):
    docs = edge_docs(spark)
    assert quality.keep_good(docs).columns == docs.columns
    assert quality.keep_good(empty_docs(spark)).count() == 0


def test_plan_is_native(spark, capsys):
    quality.judged(edge_docs(spark)).explain()
    plan = capsys.readouterr().out
    assert not re.search("Python|Arrow|Pandas", plan)


def test_filter_stays_above_the_measures(spark, capsys):
    """Below them, the words would be split anew for every word of a text."""
    quality.keep_good(edge_docs(spark)).explain()
    plan = capsys.readouterr().out
    assert plan.index("Filter") < plan.index("Generate explode") < plan.rindex("split(")
