"""Main-text extraction by composite text density.

A page becomes a light DOM.  Every node gets its characters per tag, adjusted
by how much of them is link text, relative to the body's link share
(composite text density).  Each container is scored by the sum of its
children's densities.  Starting from the container with the largest sum, the
threshold is the least density on its path to the body.  The outermost article
or main element on that path bounds the selection: up to it all is taken but
blocks beside the path that miss the threshold and are mostly links (headings
stay), and by the same rule articles beside it are further parts of the text.
Without such an element the selection climbs the path while the parent's other
children reach the threshold.  Subtrees that markup itself names as menus,
headers, footers, sidebars, notices, adverts, form controls, comments, scripts
or styles are cut before anything is counted.

Elements name them for certain; a class, id or role only lowers a node's
standing.  It is believed if the node is mostly links, or if the whole name
says so and the node is short or a small share of the page, and never if the
node holds an article, a main element, an h1 or the container of the largest
density sum.  Paragraphs and names that only contain such a word
("has-sidebar", "related-work") have to be mostly links.  A form, without its
controls and labels, has the standing of a named node.  Adverts, comments
and the like beside an article or main element with text are cut at any size.
If all this leaves no text, neither names nor forms are cut.

Defined cases: a null or empty page and a page without text give the empty
string; unclosed and stray tags are repaired as browsers do in simple cases;
pages of any length are read whole, without recursion; repeated rows give the
same text; an empty table gives an empty result; only id, url and html are
read, whatever else the table holds.
"""

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import text_slices

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
#: Elements that hold no main text.
CUT = frozenset("head script style noscript template iframe object svg canvas nav aside footer button select option textarea input dialog menu audio video map".split())
#: Parts of a form that are cut besides its controls.
FORM_PARTS = frozenset("label legend datalist output meter progress".split())
#: Words of class, id and role that name such parts.
CUT_WORDS = frozenset("""
    ad ads advert adverts advertisement advertising adsense banner banners sponsor sponsored promo promotion promoted
    nav navbar navigation menu menubar topnav breadcrumb breadcrumbs toolbar header masthead topbar footer foot bottombar colophon copyright
    sidebar aside rail widget widgets related recommended recommendations trending popular outbrain taboola
    notice notices cookie cookies consent gdpr popup modal overlay alert newsletter subscribe subscription signup login paywall
    comment comments commentlist disqus replies respond share sharing social search pagination pager skip complementary contentinfo
""".split())
#: Those that also are topics of a text or parts of a layout.
TOPICS = frozenset("""
    promotion nav navigation menu header footer foot copyright aside rail related recommended recommendations trending popular
    notice notices alert subscription share sharing social search skip banner banners overlay replies respond
""".split())
#: Words that may stand beside them in a name.
NEUTRAL = frozenset("""
    area bar bars block body bottom box button buttons container content global group icons inner item items left link links list main module
    outer page panel post posts primary right row secondary section site slot stories top unit wrap wrapper
""".split())
#: Standing of a named node: cut if mostly links; also if short or a small share; also if a larger share.
LINKS, SMALL, LARGE = 1, 2, 3
SHORT, SHARE = 100, {LINKS: 0.0, SMALL: 0.05, LARGE: 0.25}
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre figcaption dt".split())
IN_HEAD = frozenset("base link meta noscript script style template title".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
#: An opening tag of the key closes an open element of the values, up to a container.
IMPLIED = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
           "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}}
SCOPES = frozenset("ul ol dl table select body article section div main td th".split())
WORD = re.compile(r"[a-z0-9]+")
HEADER_IN = frozenset(("article", "main", "section"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 header hgroup".split())


class Page(HTMLParser):
    """Flat DOM: tags, parents and children in page order; texts belong to nodes."""

    def __init__(self, by_name=True):
        super().__init__(convert_charrefs=True)
        self.by_name = by_name
        self.tag, self.parent, self.cut = ["body"], [-1], [False]
        self.named = {}         # node: standing, of those with a name
        self.texts = []         # (node, text) in page order; None marks a line break
        self.open = [0]

    def handle_starttag(self, tag, attrs):
        # anything that cannot stand in a head ends it
        if tag not in IN_HEAD and len(self.open) > 1 and self.tag[self.open[1]] == "head":
            del self.open[1:]
        if tag in ("html", "body"):
            return
        if tag in CLOSES_P:
            self.end_open({"p"})
        if tag in IMPLIED:
            self.end_open(IMPLIED[tag])
        node = len(self.tag)
        up = self.open[-1]
        self.tag.append(tag)
        self.parent.append(up)
        self.cut.append(self.cut[up] or self.marked_out(tag, attrs))
        if self.by_name and not self.cut[node]:
            # a form may hold the whole page
            standing = max(self.standing(tag, attrs), SMALL * (tag == "form"))
            if standing:
                self.named[node] = standing
        if tag not in INLINE:
            self.texts.append((node, None))
        if tag not in VOID:
            self.open.append(node)

    def handle_endtag(self, tag):
        for k in range(len(self.open) - 1, 0, -1):
            if self.tag[self.open[k]] == tag:
                if tag not in INLINE:
                    self.texts.append((self.parent[self.open[k]], None))
                del self.open[k:]
                return

    def handle_data(self, data):
        self.texts.append((self.open[-1], data))

    def end_open(self, tags):
        for k in range(len(self.open) - 1, 0, -1):
            tag = self.tag[self.open[k]]
            if tag in tags:
                self.texts.append((self.parent[self.open[k]], None))
                del self.open[k:]
                return
            if tag in SCOPES:
                return

    def marked_out(self, tag, attrs):
        if tag in CUT:
            return True
        if tag in FORM_PARTS and any(self.tag[n] == "form" for n in self.open):
            return True
        if tag == "header" and not any(self.tag[n] in HEADER_IN for n in self.open):
            return True
        return any(k == "hidden" or k == "aria-hidden" and v == "true" or k == "style" and v and "display:none" in v.replace(" ", "") for k, v in attrs)

    def standing(self, tag, attrs):
        # the outermost article, main and headings are never cut for a class name, nor are words of a sentence
        if tag in ("main", "h1", "h2", "h3") or tag == "article" and not any(self.tag[n] == "article" for n in self.open):
            return 0
        if tag in INLINE and self.tag[self.open[-1]] in PARAGRAPHS:
            return 0
        found = 0
        for k, v in attrs:
            if k in ("class", "id", "role") and v:
                for name in v.lower().split():
                    words = WORD.findall(name)
                    if not CUT_WORDS.isdisjoint(words):
                        found = max(found, self.of_name(tag, k, words))
        return found

    @staticmethod
    def of_name(tag, key, words):
        if tag in PARAGRAPHS or not all(w in CUT_WORDS or w in NEUTRAL or w.isdigit() for w in words):
            return LINKS
        sure = key == "role" or any(w in CUT_WORDS and w not in TOPICS for w in words)
        # the id of a section may be made from its heading
        return (LARGE if sure else SMALL) - (key == "id" and tag == "section")


def parsed(html, by_name=True):
    page = Page(by_name)
    page.feed(html)
    HTMLParser.close(page)
    if page.named:
        cut_named(page)
    return page


def densities(page):
    """(composite density, density sum, characters, characters in links) per node."""
    n = len(page.tag)
    chars, link_chars, tags, link_tags = ([0] * n for _ in range(4))
    in_link = [False] * n
    for i in range(n):
        up = page.parent[i]
        in_link[i] = page.tag[i] == "a" or up >= 0 and in_link[up]
    for node, text in page.texts:
        if text and not page.cut[node]:
            size = len("".join(text.split()))
            chars[node] += size
            link_chars[node] += size * in_link[node]
    for i in range(n - 1, 0, -1):
        up = page.parent[i]
        if not page.cut[i]:
            chars[up] += chars[i]
            link_chars[up] += link_chars[i]
            tags[up] += tags[i] + 1
            link_tags[up] += link_tags[i] + (page.tag[i] == "a")
    share = link_chars[0] / max(chars[0], 1)
    density, total = [0.0] * n, [0.0] * n
    for i in range(n - 1, -1, -1):
        c, lc = chars[i], link_chars[i]
        if c and not page.cut[i]:
            plain = max(c - lc, 1)
            base = math.log(c * lc / plain + share * c + math.e)
            quotient = (c / max(lc, 1)) * (max(tags[i], 1) / max(link_tags[i], 1))
            density[i] = c / max(tags[i], 1) * math.log(max(quotient, 1.0)) / base
        if i:
            total[page.parent[i]] += density[i]
    return density, total, chars, link_chars


def holders(page, nodes):
    """Per node: does one of the nodes lie in it."""
    holds = [False] * len(page.tag)
    for i in range(len(page.tag) - 1, 0, -1):
        if holds[i] or i in nodes:
            holds[page.parent[i]] = True
    return holds


def best_container(page, total):
    """The container of the largest density sum."""
    container = [False] * len(page.tag)
    for i in range(1, len(page.tag)):
        if page.tag[i] not in INLINE and page.tag[i] not in VOID and not page.cut[i]:
            container[page.parent[i]] = True
    return max((i for i in range(len(page.tag)) if container[i] and not page.cut[i]), key=lambda i: (total[i], -i), default=0)


def cut_named(page):
    """Cut the named nodes whose names are believed."""
    density, total, chars, link_chars = densities(page)
    n = len(page.tag)
    inside = {tag: [False] * n for tag in ("article", "main")}
    for tag, within in inside.items():
        for i in range(1, n):
            within[i] = page.tag[i] == tag or within[page.parent[i]]
    outer = {tag: [i for i in range(1, n) if page.tag[i] == tag and not page.cut[i] and not within[page.parent[i]]] for tag, within in inside.items()}
    holds = holders(page, {*outer["article"], *outer["main"], *(i for i in range(1, n) if page.tag[i] == "h1" and not page.cut[i])})
    best = best_container(page, total)
    around = holders(page, {best})
    around[best] = True
    text_in = next((inside[tag] for tag in ("article", "main") if sum(chars[i] for i in outer[tag]) > SHORT), None)
    for i, standing in page.named.items():
        if holds[i]:
            continue
        if standing == LARGE and text_in and not text_in[i]:
            page.cut[i] = True
        elif not around[i]:
            page.cut[i] = 2 * link_chars[i] > chars[i] or standing > LINKS and (chars[i] <= SHORT or chars[i] <= SHARE[standing] * chars[0])
    for i in range(1, n):
        page.cut[i] = page.cut[i] or page.cut[page.parent[i]]


def chosen(page):
    """Roots of the subtrees that hold the main text, and the nodes left out below them."""
    density, total, chars, link_chars = densities(page)
    best = best_container(page, total)
    path = [best]
    while page.parent[path[-1]] >= 0:
        path.append(page.parent[path[-1]])
    threshold = min(density[i] for i in path)
    children = {}
    for i in range(1, len(page.tag)):
        if not page.cut[i] and chars[i]:
            children.setdefault(page.parent[i], []).append(i)
    top = max((k for k, node in enumerate(path) if page.tag[node] in ("article", "main")), default=None)
    if top is None:
        for below, node in zip(path, path[1:]):
            beside = [i for i in children.get(node, []) if i != below]
            if not beside or min(density[i] for i in beside) >= threshold:
                best = node
            else:
                break
        return {best}, set()
    titled = holders(page, {i for i, tag in enumerate(page.tag) if tag == "h1" and not page.cut[i]})

    def menu_like(i):
        return page.tag[i] not in INLINE and page.tag[i] not in HEADINGS and not titled[i] and density[i] < threshold and 2 * link_chars[i] > chars[i]

    left_out = {i for below, node in zip(path[:top], path[1:top + 1]) for i in children.get(node, []) if i != below and menu_like(i)}
    parts = [i for i in children.get(page.parent[path[top]], []) if page.tag[i] == "article" and not menu_like(i)]
    return {path[top], *parts}, left_out


def extract(html):
    """Main text of one page: white space becomes one space, blocks are joined by one."""
    if not html:
        return ""
    return main_part(parsed(html)) or main_part(parsed(html, by_name=False))


def main_part(page):
    roots, left_out = chosen(page)
    inside = [False] * len(page.tag)
    for i in range(len(page.tag)):
        inside[i] = i in roots or i > 0 and inside[page.parent[i]] and i not in left_out
    parts = [" " if text is None else text for node, text in page.texts if inside[node] and not page.cut[node]]
    return " ".join("".join(parts).split())


def main_text() -> Column:
    """Column function html -> main text."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([extract(html) for part in text_slices(batch) for html in part.to_pylist()], pa.string())

    return F.arrow_udf(run, "string")


def extracted(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages``."""
    own = pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").alias("url"), main_text()(F.col(f"`{html}`")).alias("text"))
    return own.withColumn("n_chars", F.length("text").cast("long"))
