"""Main text of web pages by tree scoring.

A page becomes a tree of its block elements; inline markup only tells which text
lies in links. Elements that by their kind, role or name are no article (menus,
page headers, footers, sidebars, adverts, notices, forms, reader comments, hidden
parts, scripts, styles) are cut. Every run of text of some length gives points for
itself, its commas and its length to the element around it, fully to a paragraph's
parent and half to its grandparent; a container's score is its points, a bonus for
``article`` and ``main``, times the share of its text that lies outside links. The
best container gives way to the article or main around it, or else to its parents
below the body as long as most of their text is prose, so that a layout keeps the
same parts at any length. It is kept with those of its siblings that are headings,
score well or are paragraphs of prose, and outside articles with all whose text lies
mostly outside links. All text blocks in what is kept, short ones as well, make up
the result: character references decoded, white space inside a block as one space,
blocks joined in page order by one space.

Scale. One pass without a shuffle; a task holds one page at a time beside its batch;
the parser is linear in the page.

Defined results: a null or empty page gives an empty text; a page without markup
is one block; tags that are never closed end with their container; repeated rows
give equal rows; null ids stay; an empty table gives no row; other columns are
ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitals.llm.common import only, read

#: FIXED VALUES of HTML: elements that form blocks, that never have content, that close an open paragraph
_BLOCKS = frozenset("""address article aside blockquote body button caption center col colgroup dd details dialog dir div dl dt
fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup html iframe legend li main
menu nav noscript object ol optgroup option p pre search section select summary svg table tbody td template textarea tfoot th
thead title tr ul""".split())
_SPACES = frozenset("br hr img wbr input".split())
_CUT = frozenset("aside button dialog footer form head iframe menu nav noscript object search select svg template textarea title".split())
_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
         "option": {"option"}, "p": {"p"}, "body": {"head"}}
_SCOPE = frozenset("ul ol dl table body html article main section div td th select".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
_TEXT = frozenset("article main section div body td center".split())
#: FIXED VALUES: names of classes, ids and roles of what is no article
_NAMES = re.compile(r"""(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|banner|promo\w*|sidebar|comments?|respond|disqus|notices?|alert|
cookies?|consent|gdpr|menu|nav|navbar|navigation|breadcrumbs?|footer|masthead|header|contentinfo|complementary|search|
share|sharing|social|related|newsletter|subscribe|popup|modal|overlay|toolbar|pagination|pager|widget)(?:$|[\s_-])""", re.X)
_NAMED = re.compile(r"""\b(class|id|role|style|aria-hidden)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)
  | <(?P<raw>script|style)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)
  | <(?P<end>/?)(?P<tag>[a-z][^\s/>]*)(?P<attributes>(?:[^>"']++|"[^"]*"|'[^']*')*+)>
  | <(?P<end2>/?)(?P<tag2>[a-z][^\s/>]*)[^>]*>
  | <[!?/][^>]*>""", re.X | re.S | re.I)
LEAST_RUN = 25


def _unlike(attributes: str) -> bool:
    """Whether the attributes speak against an article."""
    for name, value in _NAMED.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                return True
        elif name == "aria-hidden":
            if value == "true":
                return True
        elif _NAMES.search(value):
            return True
    return bool(re.search(r"(?:^|\s)hidden(?:\s|=|$)", attributes, re.I))


class Page:
    """The block tree of a page; ``runs`` are (element, text) in page order."""

    def __init__(self, source: str):
        self.tag, self.parent, self.unlike = ["html"], [-1], [False]
        self.runs: list[tuple[int, str, int]] = []  # element, text, characters in links
        self._parse(source)

    def _parse(self, source: str) -> None:
        node, links, at = 0, 0, 0
        held: list[str] = []
        linked: list[str] = []

        def flush() -> None:
            text = " ".join(html.unescape("".join(held)).split())
            if text:
                inside = len(" ".join(html.unescape("".join(linked)).split())) if linked else 0
                self.runs.append((node, text, min(inside, len(text))))
            held.clear()
            linked.clear()

        for m in _TOKEN.finditer(source):
            if m.start() > at:
                held.append(source[at:m.start()])
                if links:
                    linked.append(source[at:m.start()])
            at = m.end()
            tag = (m["tag"] or m["tag2"] or "").lower()
            if not tag:
                continue
            end = m["end"] or m["end2"]
            if tag == "a":
                links = 0 if end else 1
            elif tag in _SPACES:
                held.append(" ")
            elif tag in _BLOCKS:
                flush()
                if end:
                    up = node
                    while up > 0 and self.tag[up] != tag:
                        up = self.parent[up]
                    if up > 0:
                        node, links = self.parent[up], 0
                elif tag != "html":
                    node = self._open(node, tag, m["attributes"] or "")
                    links = 0
        if at < len(source):
            held.append(source[at:])
        flush()

    def _open(self, node: int, tag: str, attributes: str) -> int:
        # any block ends an open paragraph; items end the item before them
        up = node
        while up > 0 and self.tag[up] not in _SCOPE:
            if self.tag[up] == "p" or self.tag[up] in _SAME.get(tag, ()):
                node = self.parent[up]
            up = self.parent[up]
        if tag in ("td", "th", "tr", "body") and up > 0 and self.tag[up] in _SAME[tag]:
            node = self.parent[up]
        self.tag.append(tag)
        self.parent.append(node)
        self.unlike.append(tag in _CUT or (bool(attributes) and tag not in ("body", "article", "main") and _unlike(attributes)))
        return len(self.tag) - 1


def _score(page: Page) -> tuple[list[float], list[bool], list[int], list[int]]:
    """Scores, what is cut, and lengths of the elements' text and links."""
    n = len(page.tag)
    holds = [t in ("article", "main") for t in page.tag]
    size, inside, raw = [0] * n, [0] * n, [0.0] * n
    within = [False] * n  # inside an article
    for k in range(1, n):
        within[k] = within[page.parent[k]] or page.tag[page.parent[k]] in ("article", "main")
    for k, text, links in page.runs:
        size[k] += len(text)
        inside[k] += links
    whole = size[:]
    for k in range(n - 1, 0, -1):
        whole[page.parent[k]] += whole[k]
        holds[page.parent[k]] = holds[page.parent[k]] or holds[k]
    cut = [False] * n
    for k in range(1, n):
        bad = page.unlike[k] or (page.tag[k] == "header" and not within[k])
        # a name is no proof against the element that holds most of the page, nor is a form
        # around the page (its controls are cut all the same)
        if bad and (page.tag[k] not in _CUT or page.tag[k] == "form") and (holds[k] or 2 * whole[k] > whole[0]):
            bad = False
        cut[k] = bad or cut[page.parent[k]]
    for k, text, _ in page.runs:
        if len(text) >= LEAST_RUN and not cut[k]:
            points = 1 + text.count(",") + min(len(text) // 100, 3)
            if page.tag[k] in _TEXT:
                raw[k] += points
            elif page.parent[k] >= 0:
                raw[page.parent[k]] += points
                if page.parent[page.parent[k]] >= 0:
                    raw[page.parent[page.parent[k]]] += points / 2
    kept, links = [0 if cut[k] else size[k] for k in range(n)], [0 if cut[k] else inside[k] for k in range(n)]
    for k in range(n - 1, 0, -1):
        kept[page.parent[k]] += kept[k]
        links[page.parent[k]] += links[k]
    score = [0.0] * n
    for k in range(n):
        if not cut[k] and kept[k]:
            bonus = 25 if page.tag[k] in ("article", "main") else 0
            score[k] = (raw[k] + bonus) * (1 - links[k] / kept[k])
    return score, cut, kept, links


def main_text(source: str | None) -> str:
    page = Page(source or "")
    score, cut, size, links = _score(page)
    top = max(range(len(score)), key=lambda k: (score[k], -k))
    if score[top] <= 0:
        top = 0
    chosen, dropped = [False] * len(score), [False] * len(score)
    if top > 0:
        bar = max(10.0, 0.2 * score[top])
        own = [0] * len(score), [0] * len(score)
        for k, text, in_links in page.runs:
            own[0][k] += len(text)
            own[1][k] += in_links
        around = top
        while around > 0 and page.tag[around] not in ("article", "main"):
            around = page.parent[around]
        if around > 0:
            top = around  # nothing around the best element is cut
        else:
            prose = [0] * len(score)
            for k, text, in_links in page.runs:
                if not cut[k] and len(text) >= LEAST_RUN and 4 * in_links < len(text):
                    prose[k] += len(text)
            for k in range(len(score) - 1, 0, -1):
                prose[page.parent[k]] += prose[k]
            while (up := page.parent[top]) > 0 and page.tag[up] != "body" and 2 * prose[up] > size[up]:
                for k in range(up + 1, len(score)):
                    if k != top and page.parent[k] == up and page.tag[k] not in _HEADINGS:
                        dropped[k] = 2 * links[k] > size[k]
                top = up
        for k in range(1, len(score)):
            if k != top and page.parent[k] == page.parent[top] and not cut[k]:
                some = page.tag[k] == "p" and own[0][k] > 80 and own[1][k] < 0.25 * own[0][k]
                plain = around == 0 and 4 * links[k] < size[k]
                chosen[k] = score[k] >= bar or some or plain or page.tag[k] in _HEADINGS
    chosen[top] = True
    for k in range(1, len(score)):
        chosen[k] = (chosen[k] or chosen[page.parent[k]]) and not dropped[k]
    return " ".join(text for k, text, _ in page.runs if chosen[k] and not cut[k])


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of ``pages`` (page_id, url, html)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(h.as_py()) for h in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])
    return only(pages, page_id="long", url="string", html="string").mapInArrow(run, "page_id long, url string, text string")


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))
