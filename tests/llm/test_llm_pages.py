"""Main text and language of pages."""

import html as entities
import re

from pyspark.sql import functions as F
from stayline.llm import html_extract, language, queries

SF = "/root/testdata/sf0.001"


def plain_article(page):
    """The one article of the test pages, by plain text cutting."""
    body = page[page.index("<article>") + len("<article>"):].split("</article>")[0]
    body = re.sub(r"<[^>]*>", " ", re.sub(r"</?(?:b|i|em|a)\b[^>]*>", "", body))
    return " ".join(entities.unescape(body).split())


def test_query_against_plain_cutting(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = queries.op4(spark, SF).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r["text"] == plain_article(pages[r["page_id"]]["html"])
        assert r["n_chars"] == len(r["text"]) and r["url"] == pages[r["page_id"]]["url"]


def test_density_without_semantic_markup():
    long = "A paragraph of real sentences about the river and the town. " * 6
    page = f"""<html><body><div><a href=1>Home</a> <a href=2>News</a> <a href=3>Sport</a></div>
      <div><div><h2>Head &amp; line</h2><p>{long}</p><p>{long}<a href=x>link</a> end</p></div>
      <div><a href=4>More one</a><br><a href=5>More two</a></div></div><div>Short line</div></body></html>"""
    text = html_extract.extract(page)
    assert text == " ".join(f"Head & line {long} {long}link end".split())


def test_named_parts_are_cut():
    page = """<body><header>Top</header><nav><a href=1>x</a></nav><main><h1>Title</h1><div class="cookie-notice">We use cookies</div>
      <p>First <b>bold</b>text<br>line</p><form>Name <input></form><script>var a="<p>no</p>"</script><style>p{}</style>
      <aside>Side</aside><p>Second</p><section id="comments"><p>A reader says so</p></section></main><footer>Foot</footer></body>"""
    assert html_extract.extract(page) == "Title First boldtext line Second"


def test_nested_and_sibling_articles():
    long = "A paragraph of real sentences about the river and the town. " * 4
    card = "An embedded card with its own short story. " * 3
    nested = f"<body><article><h1>Title</h1><p>{card}</p><article><p>{long}</p><p>{long}</p></article><p>The end.</p></article></body>"
    assert html_extract.extract(nested) == " ".join(f"Title {card} {long} {long} The end.".split())
    for outer in ("main", "body", "div"):
        parts = f"<{outer}><article><h2>One</h2><p>{long}</p><p>{long}</p></article><article><p>{card}</p></article></{outer}>"
        assert html_extract.extract(parts) == " ".join(f"One {long} {long} {card}".split())


def test_selection_inside_an_article():
    long = "A paragraph of real sentences about the river and the town. " * 4
    page = f"""<main><h1><a href=0>Title</a></h1><p>By us</p><div><p>{long}</p><p>{long}</p><p>{long}<a href=x>a</a></p></div>
      <div><a href=1>More one</a><br><a href=2>More two</a></div><p>Note</p></main>"""
    assert html_extract.extract(page) == " ".join(f"Title By us {long} {long} {long}a Note".split())


def test_names_lower_a_standing_only():
    long = "A paragraph of real sentences about the river and the town. " * 4
    story = f"<p>{long}</p><p>{long}</p>"
    text = " ".join(f"{long} {long}".split())
    for name in ("layout has-sidebar", "no-header", "ad-free", "no-comments", "sidebar", "comments"):
        assert html_extract.extract(f"<body><a href=#c>Skip to content</a><div id=page class='{name}'>{story}</div></body>") == text
    real = "".join(f"<{tag}>Real words of this part.</{tag.split()[0]}>" for tag in (
        "section id='related-work'", "section id=search", "section id=navigation", "section id=copyright", "p class=notice", "div class='share-price'", "h4 id=social"))
    noise = f"""<div class="sidebar"><p>{long}</p></div><section class="related-posts"><a href=1>{long}</a></section><div class="ad-slot">Buy</div>"""
    got = html_extract.extract(f"<main><article><h1>T</h1>{story * 4}{real}</article>{noise}</main>")
    assert got == " ".join(["T", *[text] * 4, *["Real words of this part."] * 7])
    reader = f"<div id=comments>{story * 5}</div>"
    assert html_extract.extract(f"<main><article>{story}</article>{reader}</main>") == text
    assert html_extract.extract(f"<article>{story}</article>{reader}") == text
    assert html_extract.extract("<p class=x>See <a class=popular href=1>this</a> <span class=search>word</span>") == "See this word"


def test_page_inside_a_form():
    long = "A paragraph of real sentences about the river and the town. " * 4
    text = " ".join(f"{long} {long}".split())
    controls = "<label>Name <input></label><select><option>x</select><button>Go</button><textarea>y</textarea>"
    for body in (f"<article><p>{long}</p><p>{long}</p></article>", f"<p>{long}</p><p>{long}</p>"):
        assert html_extract.extract(f"<body><form id=aspnetForm>{controls}{body}</form></body>") == text
        assert html_extract.extract(f"<body><a href=#c>Skip</a><form id=search>{controls}<div>{body}</div></form></body>") == text
        assert html_extract.extract(f"<body><main>{body}<form>Write to us {controls}</form></main></body>") == text
    assert html_extract.extract(f"<form>{controls}A short page.</form>") == "A short page."


def test_odd_pages():
    assert [html_extract.extract(x) for x in (None, "", "   ", "<p>", "plain &lt; text &amp", "<article>&quot;x&quot; &am")] == ["", "", "", "", "plain < text &", '"x" &am']
    assert html_extract.extract("<div>" * 20_000 + "deep") == "deep"
    assert html_extract.extract("<head><title>t</title><meta x><p>no end of head<br/>here") == "no end of head here"
    assert html_extract.extract("<head><style>x</style><body>text") == "text"
    assert html_extract.extract("<p>a</div></p></b>" * 2_000).split() == ["a"] * 2_000


def test_page_table_edges(spark):
    rows = [(1, "u", None), (2, None, ""), (2, None, "<p>x</p>"), (None, "u", "<p>y " + "z " * 50_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"text": F.lit(1), "n_chars": F.lit(2)})
    got = {(r["page_id"], r["url"], r["n_chars"]) for r in html_extract.extracted(pages).collect()}
    assert got == {(1, "u", 0), (2, None, 0), (2, None, 1), (None, "u", 2 * 50_000 + 1)}
    assert html_extract.extracted(pages.limit(0)).count() == 0


def test_text_model_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    names, model = language.fit(docs.where("doc_id % 5 <> 0"))
    held = docs.where("doc_id % 5 = 0 and length(text) > 40").collect()
    best = language.log_likelihoods([r["text"] for r in held], model).argmax(axis=1)
    assert sum(names[b] == r["lang"] for b, r in zip(best, held)) / len(held) > 0.97


def test_fusion(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    rows = language.identified(pages, docs).collect()
    assert len(rows) == pages.count()
    assert sum(r["lang"] == r["declared"] for r in rows) / len(rows) > 0.97
    # a page without text follows its host, then its declaration
    hosted = [(i, "http://w.site.de/a", "<html lang=de><article>" + "der die und das nicht ist eine von zu mit " * 5) for i in range(30)]
    hosted += [(i, "http://w.other.fr/a", "<html lang=fr><article>" + "le la les des une est dans pour que qui " * 5) for i in range(40, 70)]
    asked = hosted + [(100, "http://w.site.de/b", "<p></p>"), (101, "http://new.org/", "<html lang='fr'><p>..</p>"), (102, None, None), (102, None, None)]
    frame = spark.createDataFrame(asked, "page_id long, url string, html string").withColumn("lang", F.lit(0))
    found = {r["row"]["page_id"]: r for r in language.identified(frame, docs).collect()}
    assert found[100]["lang"] == "de" and found[101]["lang"] == "fr"
    assert found[102]["declared"] == "" and 0 < found[102]["probability"] <= 1
    assert language.identified(frame, docs).count() == len(asked)


def test_language_edges(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    pages = spark.createDataFrame([(1, "http://a.b", "<p>x")], "page_id long, url string, html string")
    assert language.identified(pages.limit(0), docs).count() == 0
    unlabelled = language.identified(pages, docs.limit(0)).first()
    assert unlabelled["lang"] is None and unlabelled["row"]["page_id"] == 1


def test_query(spark):
    assert queries.op5(spark, SF).count() == spark.read.parquet(f"{SF}/pages.parquet").count()
