"""Main text of web pages: flat text blocks, kept or dropped by a decision tree over each block and its neighbours.

A page is cut into flat blocks of text at every block-level tag. A block is described by its number of words, its
share of words inside links, the same two of the block before and after it, and by where it stands: inside the main
part, outside of it, inside an edge part (menu, header, footer, sidebar, form, or a class or id that names one), or on
a page without a main part; and whether it is a heading. A heading in an article's own header stands in the main part. A small tree (Gini, whole table, no randomness)
is grown from ``EXAMPLES``, the short labelled pages below, each time it is needed; it has some ten leaves.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernels

# Element names of HTML by what they do to the text, and the words by which pages name their parts.
BREAKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset"
    " h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup p pre search section summary table tbody td tfoot th thead tr ul".split()
)
HIDDEN = frozenset("script style title textarea iframe noembed noframes noscript template svg math select button canvas audio video object datalist option".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
EDGE_TAGS = frozenset("nav aside footer header menu dialog search form".split())
MAIN_TAGS = frozenset("article main".split())
EDGE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent contentinfo cookie cookies copyright disclaimer discussion dialog disqus"
    " footer footnav form header login masthead menu modal nav navbar navigation newsletter notice popup promo promos promotion recommended related"
    " replies search share sharing sidebar signup social sponsor sponsored sponsors subscribe tags toolbar widget widgets".split()
)
MAIN_WORDS = frozenset("article articlebody content entry main post story".split())
UNLESS = frozenset("has no with without".split())

FEATURES = ("words", "density", "words_before", "density_before", "words_after", "density_after", "place", "heading")
PLAIN, MAIN, EDGE = 0, 1, 2
#: place of a block: in the main part, on a page without one, outside of the main part that its page has, in an edge part.
IN_MAIN, NO_MAIN, OUTSIDE, IN_EDGE = 0.0, 1.0, 2.0, 3.0
DEPTH, LEAF_ROWS = 7, 3

# Labelled pages, one a line. A text is ``+n`` (belongs to the article) or ``-n`` (does not): n words.
EXAMPLES = """
<header><a>-2</a></header><nav><ul><li><a>-1</a></li><li><a>-1</a></li><li><a>-2</a></li></ul></nav><div class="ad">-14</div><article><h1>+9</h1><p>+40</p><p>+3</p><p>+1</p><p>+25</p></article><footer>-12</footer>
<nav><ul><li><a>-1</a></li><li><a>-1</a></li></ul></nav><div class="ad">-5</div><article><h1>+4</h1><p>+1</p><p>+2</p></article><footer>-3</footer>
<nav><a>-1</a><a>-1</a></nav><main><h1>+6</h1><p>+60</p><ul><li>+5</li><li>+7</li><li>+2</li></ul><p>+18 <a>+3</a> +9</p><aside><h2>-2</h2><p>-20</p></aside><p>+33</p></main><footer><p>-25</p></footer>
<div>-30</div><article><h1>+8</h1><p>+50</p><p><a>+2</a> +30</p><section class="comments"><h2>-2</h2><p>-30</p><p>-12</p></section></article><div>-18</div>
<div>-22 <a>-1</a></div><main><p>+1</p><p>+80</p><h2>+3</h2><p>+44</p><h2>+2</h2><p>+2</p></main><div>-4</div><div>-45</div>
<article><header><h1>+7</h1><p>-4</p></header><p>+35</p><blockquote>+16</blockquote><p>+2</p><footer>-6</footer></article><aside class="sidebar"><h3>-2</h3><p>-28</p></aside>
<article><header><h1>+2</h1><p>-9</p><p>-30</p></header><p>+12</p><p>+1</p><p>+3</p></article><section id="comments"><article><p>-40</p></article><article><p>-3</p></article></section>
<div class="cookie-notice"><p>-32</p></div><div class="content"><h1>+5</h1><p>+48</p><p>+4</p><div class="promo">-15</div><p>+29</p></div><div class="related"><a>-6</a><a>-8</a></div>
<div class="top-menu"><a>-1</a><a>-1</a></div><div id="main-content"><p>+22</p><p>+31 <a>+4</a></p><p>+1</p></div><div class="newsletter"><p>-16</p><form>-4</form></div>
<article><h2>+6</h2><p>+26</p><ul><li><a>-5</a></li><li><a>-7</a></li><li><a>-6</a></li></ul></article><nav><a>-2</a></nav>
<article><p>+14</p><p>+2</p><ul><li><a>-4</a></li><li><a>-3</a></li><li><a>-9</a></li><li><a>-2</a></li></ul></article>
<div><a>-1</a> <a>-1</a> <a>-2</a></div><div><h1>+6</h1></div><div><p>+45</p><p>+38</p><p>+52</p></div><div><a>-3</a></div><div>-5</div>
<ul><li><a>-1</a></li><li><a>-2</a></li><li><a>-1</a></li></ul><h1>+5</h1><p>+30</p><p>+24 <a>+2</a> +10</p><p>+41</p><ul><li><a>-4</a></li><li><a>-5</a></li></ul><div>-6</div>
<div><a>-2</a></div><div><a>-1</a></div><p>+28</p><p>+19</p><p>+55</p><div><a>-3</a> <a>-3</a></div><div>-4</div>
<div><a>-1</a> <a>-1</a></div><div><p>+40</p><p>+41</p></div><div><a>-2</a></div>
<ul><li><a>-1</a></li><li><a>-1</a></li></ul><div><a>-3</a></div><p>+35</p><p>+3</p><p>+50</p><div><a>-2</a></div>
<div>-3</div><div>-2</div><div><a>-1</a></div><p>+30</p><p>+42</p><div>-4</div><div>-3</div><div>-2</div>
<div>-2</div><div>-1</div><h1>+6</h1><p>+70</p><p>+33</p><div>-3</div><div>-5</div><div><a>-45</a></div><div><a>-30</a> -2</div><div><a>-28</a></div>
<h1>+4</h1><p>+60</p><p>+33</p><div><a>-2</a></div>
<div><a>-2</a></div><h2>+5</h2><p>+47</p><p>+30</p>
<table><tr><td><a>-2</a></td><td><a>-2</a></td></tr></table><p>+36</p><p>+62</p><p>+27</p><p>-3</p>
<main><header><h1>+5</h1><p>-3</p></header><p>+1</p><p>+2</p><p>+70</p><p>+1</p><p>+90</p></main><div>-7</div>
<article><header><h2>+9</h2><p>-5</p></header><p>+120</p><p>+1</p><p>+4</p><p>+64</p><p>+2</p></article><div>-50</div><div>-2</div>
<nav><a>-1</a><a>-2</a></nav><article><h1>+3</h1><p>+20</p><p>+5</p></article>
<div class="banner">-9</div><main><p>+17</p><p>+1</p></main>
<article><h1>+1</h1><p>+4</p><p>+2</p></article>
<header><h2>-2</h2><p>-50</p></header><article><h1>+4</h1><p>+66</p></article><aside><h3>-2</h3><p>-55</p></aside><footer><h4>-1</h4><p>-60</p></footer>
<div><h2>-3</h2><p>-70</p></div><main><h2>+3</h2><p>+58</p></main><aside><h3>-1</h3><p>-80</p><h3>-2</h3><p>-49</p></aside>
<header>-3</header><article><p>+52</p><p>+38</p><p>+2</p></article>
<div id="content"><h1>+7</h1><p>+11</p></div>
<form><p>-10</p><article><h1>+5</h1><p>+39</p><p>+1</p></article><p>-12</p></form>
<div class="login"><p>-12</p></div><div class="masthead">-3</div><article><p>+7</p><div class="share"><a>-1</a><a>-1</a></div><p>+9</p></article><p>-60</p>
"""


class Block(NamedTuple):
    text: str
    words: int
    linked: int
    zone: int
    heading: int
    title: int


_NUMBER = re.compile(r"&#0*[1-9][0-9]{7,};?")
_TAG = re.compile(r"""(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)>""")
_NAMED = re.compile(r"""(?<![^\s"'/])(class|id|role|itemprop)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))""", re.I)
_WORD = re.compile(r"[a-z]+")
_ENDS = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in HIDDEN}
_HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")


def decoded(text: str) -> str:
    """``text`` with its character references replaced; numbers beyond all code points become U+FFFD."""
    if "&" not in text:
        return text
    return html.unescape(_NUMBER.sub("&#x110000;", text))


def _named_zone(attributes: str) -> int:
    """What class, id, role and itemprop say of an element: the part it is, or PLAIN."""
    found = PLAIN
    for _, *values in _NAMED.findall(attributes):
        for name in next((v for v in values if v), "").split():
            parts = _WORD.findall(_HUMP.sub(" ", name).lower())
            if not parts or not UNLESS.isdisjoint(parts):
                continue
            edge, main = not EDGE_WORDS.isdisjoint(parts), not MAIN_WORDS.isdisjoint(parts)
            if parts[-1] in EDGE_WORDS or (edge and not main):
                return EDGE
            if main and not edge:
                found = MAIN
    return found


class _Page:
    """Blocks of one page. ``open`` has the elements around the place: name, zone, whether a name or an aside makes it an edge for good, and whether it is an article's header."""

    def __init__(self):
        self.blocks: list[Block] = []
        self.parts: list[str] = []
        self.linked: list[str] = []
        self.in_link = False
        self.open: list[tuple[str, int, bool, int]] = [("", PLAIN, False, 0)]
        self.heading = 0

    def end_block(self) -> None:
        words = "".join(self.parts).split()
        if words:
            _, zone, _, title = self.open[-1]
            self.blocks.append(Block(" ".join(words), len(words), min(len(words), len("".join(self.linked).split())), zone, self.heading, title))
        self.parts, self.linked = [], []

    def add(self, text: str) -> None:
        self.parts.append(text)
        if self.in_link:
            self.linked.append(text)
        elif self.linked:
            self.linked.append(" ")

    def start(self, name: str, attributes: str) -> None:
        _, zone, firm, title = self.open[-1]
        if name == "p" and self.open[-1][0] == "p":
            self.open.pop()
            _, zone, firm, title = self.open[-1]
        elif name in ("li", "dd", "dt", "td", "th", "tr"):
            self._close_item(name)
            _, zone, firm, title = self.open[-1]
        named = _named_zone(attributes) if attributes and name not in ("html", "body") else PLAIN
        if named == EDGE and name not in MAIN_TAGS:
            zone, firm, title = EDGE, True, 0
        elif name in EDGE_TAGS:
            title = int(name == "header" and zone == MAIN)
            zone, firm = EDGE, firm or name == "aside"
        elif (name in MAIN_TAGS or (named == MAIN and zone == PLAIN)) and not firm:
            zone, title = MAIN, 0
        if name in HEADINGS:
            self.heading = 1
        if name not in VOID:
            self.open.append((name, zone, firm, title))

    def _close_item(self, name: str) -> None:
        """An item that is open ends before the next one of its list or row."""
        ends = {"li": ("li",), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th")}.get(name, ("dd", "dt"))
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k][0] in ends:
                del self.open[k:]
            if self.open[k - 1 if k >= len(self.open) else k][0] in ("ul", "ol", "dl", "table", "tbody", "menu", "tr", ""):
                break

    def end(self, name: str) -> None:
        if name in HEADINGS:
            self.heading = 0
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k][0] == name:
                del self.open[k:]
                break
            if name == "p" and self.open[k][0] != "p":
                break


def flat_blocks(source: str) -> list[Block]:
    """The blocks of a page in page order. Comments, declarations and hidden elements have no text; ``<`` before anything else is text."""
    page, at = _Page(), 0
    while True:
        mark = source.find("<", at)
        if mark < 0:
            page.add(decoded(source[at:]))
            break
        if mark > at:
            page.add(decoded(source[at:mark]))
        tag = _TAG.match(source, mark + 1)
        if tag:
            at = tag.end()
            name = tag[2].lower()
            if name in HIDDEN and not tag[1]:
                end = _ENDS[name].search(source, at)
                if end:
                    at = end.start()
                elif name in ("script", "style"):
                    at = len(source)
            elif name in BREAKS:
                page.end_block()
                (page.end if tag[1] else page.start)(*((name,) if tag[1] else (name, tag[3])))
            elif name == "a":
                page.in_link = not tag[1]
            elif name == "br":
                page.add(" ")
        elif source.startswith("<!--", mark):
            end = min((e for e in (source.find("-->", mark + 2), source.find("--!>", mark + 4)) if e >= 0), default=-1)
            at = len(source) if end < 0 else source.index(">", end) + 1
        elif source[mark + 1 : mark + 2] in ("!", "?", "/"):
            end = source.find(">", mark)
            at = len(source) if end < 0 else end + 1
        elif source[mark + 1 : mark + 2].isascii() and source[mark + 1 : mark + 2].isalpha():
            break  # a tag without an end: what follows is no text
        else:
            page.add("<")
            at = mark + 1
    page.end_block()
    return page.blocks


def features(blocks: list[Block]) -> list[tuple[float, ...]]:
    """A row of FEATURES for each block of a page."""
    sizes = [(0.0, 0.0), *((float(b.words), b.linked / b.words) for b in blocks), (0.0, 0.0)]
    outside = OUTSIDE if any(b.zone == MAIN and b.linked < b.words for b in blocks) else NO_MAIN
    place = (outside, IN_MAIN, IN_EDGE)
    return [(*sizes[k + 1], *sizes[k], *sizes[k + 2], IN_MAIN if b.title and b.heading else place[b.zone], float(b.heading)) for k, b in enumerate(blocks)]


# --- the tree ---------------------------------------------------------------------------------------------


def examples(table: str = EXAMPLES) -> tuple[list[tuple[float, ...]], list[bool]]:
    """Features and labels of the blocks of the labelled pages."""
    rows, labels = [], []
    for line in filter(str.strip, table.splitlines()):
        filled = re.sub(r"([+-])(\d+)", lambda m: " ".join([m[1]] * int(m[2])), line)
        blocks = flat_blocks(filled)
        rows += features(blocks)
        labels += [b.text[0] == "+" for b in blocks]
    return rows, labels


class Node(NamedTuple):
    """A split (rows whose feature is at most ``cut`` go to ``low``) or, where feature is -1, a leaf."""

    feature: int
    cut: float
    low: Node | None
    high: Node | None
    keep: bool


def _impurity(kept: int, n: int) -> float:
    return 2.0 * kept * (n - kept) / n if n else 0.0


def grow(rows: list[tuple[float, ...]], labels: list[bool], depth: int = DEPTH) -> Node:
    """The tree of least Gini impurity, split by split; ties go to the first feature and the lowest cut. Without rows it keeps nothing."""
    n, kept = len(rows), sum(labels)
    leaf = Node(-1, 0.0, None, None, 2 * kept > n)
    if depth == 0 or kept in (0, n):
        return leaf
    best = (_impurity(kept, n) - 1e-9, -1, 0.0)
    for f in range(len(rows[0])):
        order = sorted(range(n), key=lambda i: rows[i][f])
        below = 0
        for k in range(1, n - LEAF_ROWS + 1):
            below += labels[order[k - 1]]
            lo, hi = rows[order[k - 1]][f], rows[order[k]][f]
            if lo < hi and k >= LEAF_ROWS:
                cost = _impurity(below, k) + _impurity(kept - below, n - k)
                if cost < best[0]:
                    best = (cost, f, (lo + hi) / 2)
    if best[1] < 0:
        return leaf
    low = [r[best[1]] <= best[2] for r in rows]
    part = lambda side: ([r for r, x in zip(rows, low) if x is side], [y for y, x in zip(labels, low) if x is side])
    return Node(best[1], best[2], grow(*part(True), depth - 1), grow(*part(False), depth - 1), leaf.keep)


def keeps(tree: Node, row: tuple[float, ...]) -> bool:
    while tree.feature >= 0:
        tree = tree.low if row[tree.feature] <= tree.cut else tree.high
    return tree.keep


@lru_cache
def trained(table: str = EXAMPLES) -> Node:
    return grow(*examples(table))


# --- Spark ------------------------------------------------------------------------------------------------


def blocks(pages: DataFrame, table: str = EXAMPLES) -> DataFrame:
    """page_id, pos, text, words, linked (words inside links) and kept of each flat block of ``pages`` (page_id, html).

    A null or empty html has none. Rows with equal or null page_id stay apart only by their blocks; other columns are
    not looked at. A page is read as a whole by one task, however long; no row is moved.
    """
    kind = pages.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = trained(table)
        for b in batches:
            held: list[tuple] = []
            for k, source in enumerate(kernels.strings(b.column(1))):
                own = flat_blocks(source)
                held += [(k, i, x.text, x.words, x.linked, keeps(tree, row)) for i, (x, row) in enumerate(zip(own, features(own)))]
            at, *rest = zip(*held) if held else ((),) * 6
            arrays = [b.column(0).take(pa.array(at, pa.int64()))] + [pa.array(c, t) for c, t in zip(rest, (pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["page_id", "pos", "text", "words", "linked", "kept"])

    return pages.select("page_id", "html").mapInArrow(run, f"page_id {kind}, pos int, text string, words int, linked int, kept boolean")


def extract(pages: DataFrame, table: str = EXAMPLES) -> DataFrame:
    """page_id, url, text and n_chars of each row of ``pages`` (page_id, url, html): the kept blocks in page order, one a line.

    Every row gives one row, in whatever number it comes; a null or empty html, or one without a kept block, gives an
    empty text. Inside a block each run of white space (no-break spaces too) is one space. Null page_id and url stay
    null; other columns are not looked at, whatever their names. Nothing is cut; a page is one row of one task.
    """
    kinds = [pages.schema[c].dataType.simpleString() for c in ("page_id", "url")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = trained(table)
        for b in batches:
            texts = []
            for source in kernels.strings(b.column(2)):
                own = flat_blocks(source)
                texts.append("\n".join([x.text for x, row in zip(own, features(own)) if keeps(tree, row)]))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars long")


#: For pages whose article is one element of that name with nothing but headings and paragraphs, as the given ones are.
ORACLE = r"""
WITH a AS (SELECT page_id, url, regexp_split_to_array(regexp_replace(regexp_extract(html, '(?s)<article>(.*)</article>', 1), '<br>', ' ', 'g'), '</?(?:p|h1)>') AS blocks FROM pages),
t AS (SELECT page_id, url, list_transform(blocks, lambda b: regexp_replace(regexp_replace(regexp_replace(regexp_replace(b, '<[^>]*>', '', 'g'), '&quot;?', '"', 'g'), '&amp;?', '&', 'g'), '[\s]+', ' ', 'g')) AS lines FROM a),
j AS (SELECT page_id, url, array_to_string(list_filter(list_transform(lines, lambda l: trim(l)), lambda l: l <> ''), chr(10)) AS text FROM t)
SELECT page_id, url, coalesce(text, '') AS text, len(coalesce(text, ''))::BIGINT AS n_chars FROM j"""


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
