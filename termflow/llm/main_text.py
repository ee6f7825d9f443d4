"""Operator 9: main text of web pages by the distribution of line blocks.

Markup is stripped to one line per block element; elements that never hold the
article (scripts, menus, footers, forms, ...) and those with a class, id or role
that says so leave empty lines, as does text outside an article that is mostly
links. Over a sliding window of lines the text lengths are summed. Text starts
where the sum surges, on a page of little text at its greatest sum, and ends
where it dives to nothing; what lies between is kept whole, short lines included.
In a page that marks its article, lines outside count as empty and any text in it
is a surge. An element that holds the page's first article is never left out,
whatever its name; a left-out paragraph or item without an end tag ends where the
next block or item begins.

Defined cases: NULL and empty pages, and pages without such text, give an empty
string; rows are independent, so repeated rows and extra columns change nothing;
an empty table gives an empty one.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from termflow.llm.token_blocks import arrow_schema

WINDOW = 3
#: A sum over the window that begins text, where no article is marked; less if
#: the page has no such sum.
SURGE = 80
#: Empty lines that a removed element leaves, so that windows see the gap.
GAP = WINDOW + 1
#: Share of link text from which on a line outside an article counts as empty.
MOST_LINKED = 0.6

TOKENS = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)"
    r"(?P<attrs>(?:[^<>\"']|\"[^\"<]*\"|'[^'<]*'|[\"'])*+)>"
    r"|<[!?][^>]*>",
    re.S,
)
#: Their content is no markup: it ends only at their own end tag.
RAW = {"script", "style", "noscript", "template", "textarea", "iframe", "svg"}
NEVER_TEXT = RAW | {
    "head", "title", "nav", "header", "footer", "aside", "form", "menu",
    "button", "select", "dialog", "object", "canvas", "audio", "video",
}
VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta",
    "param", "source", "track", "wbr",
}
BLOCKS = {
    "address", "article", "blockquote", "body", "caption", "center", "dd",
    "details", "div", "dl", "dt", "fieldset", "figcaption", "figure", "h1", "h2",
    "h3", "h4", "h5", "h6", "hr", "html", "li", "main", "ol", "p", "pre", "section",
    "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
} | NEVER_TEXT
NAMES = re.compile(
    r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I
)
#: Whole names that mark what is not the article, with what may be added to them.
MARKED = re.compile(
    r"(?:(?:site|page|main|top|bottom|left|right|global|primary|secondary|user|"
    r"post|article|cookie|social|google|side)[-_])*"
    r"(?:ads?|advert\w*|banner|breadcrumbs?|comments?|commentlist|cookies?|"
    r"complementary|consent|contentinfo|footer|masthead|menu|navbar|nav|navigation|"
    r"newsletter|notice|popup|promo|promotion|related|replies|respond|search|share|"
    r"sharing|sidebar|social|sponsored|sponsor|subscribe|toolbar|widgets?)"
    r"(?:[-_](?:area|bar|banner|block|box|button|buttons|container|content|form|"
    r"inner|item|items|left|link|links|list|menu|notice|outer|posts|right|section|"
    r"slot|unit|widget|wrap|wrapper|\d+))*"
    r"|(?:site|page|global|top)[-_]header",
    re.I,
)
#: Elements whose end tag may be missing, and what begins in their place.
FOLLOWED = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}}
LISTS = {"ul", "ol", "menu", "dl"}
ARTICLE = {"article", "main"}


def is_marked(attrs: str) -> bool:
    """Whether a whole class, an id or a role names boilerplate."""
    return any(
        MARKED.fullmatch(name)
        for value in NAMES.findall(attrs)
        for name in "".join(value).split()
    )


OUT = "page_id bigint, url string, text string, n_chars bigint"


class Lines:
    """Text lines of a page: (text, length without links, in an article)."""

    def __init__(self):
        self.lines: list[tuple[str, int, bool]] = []
        self.parts: list[str] = []
        self.linked = 0
        self.article = False

    def add(self, text: str, in_link: bool) -> None:
        if text:
            self.parts.append(text)
            if in_link:
                self.linked += len("".join(text.split()))

    def end(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            bare = len(text.replace(" ", ""))
            mostly_links = not self.article and self.linked > MOST_LINKED * bare
            self.lines.append((text, 0 if mostly_links else len(text), self.article))
        self.parts, self.linked = [], 0

    def gap(self) -> None:
        self.end()
        self.lines += [("", 0, False)] * GAP


class LeftOut:
    """An element that is left out: knows at which tag it is over."""

    def __init__(self, tag: str):
        self.tag = tag
        self.depth = 1  # of elements of its kind
        self.lists = 0  # of lists within an item

    def ends_before(self, tag: str, ends: bool) -> bool:
        """Whether the element, unclosed, is over where this tag stands."""
        if self.tag == "p":
            return tag in BLOCKS and tag != "p" or tag == "p" and not ends
        if self.tag in FOLLOWED and not self.lists:
            return tag in LISTS if ends else tag in FOLLOWED[self.tag]
        return False

    def is_closed_by(self, tag: str, ends: bool) -> bool:
        if self.tag in FOLLOWED and tag in LISTS:
            self.lists += -1 if ends else 1
        if tag == self.tag:
            self.depth += -1 if ends else 1
        return self.depth == 0


def page_lines(page: str) -> list[tuple[str, int, bool]]:
    out, at, links = Lines(), 0, 0
    skipped: LeftOut | None = None
    articles, had_article = 0, False
    position = 0
    while True:
        token = TOKENS.search(page, position)
        stop = token.start() if token else len(page)
        if not skipped and stop > at:
            out.add(html.unescape(page[at:stop]), links > 0)
        if token is None:
            break
        at = position = token.end()
        if token["tag"] is None:
            continue
        tag, ends = token["tag"].lower(), bool(token["end"])
        closed = tag in VOID or token["attrs"].endswith("/")
        if tag in RAW and not ends and not closed:
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            at = position = end.end() if end else len(page)
            if not skipped:
                out.gap() if tag not in ("script", "style") else None
            continue
        if skipped:
            holds_article = tag in ARTICLE and not ends and not had_article
            if holds_article and not is_marked(token["attrs"]):
                skipped = None
            elif skipped.ends_before(tag, ends):
                skipped = None
            elif not closed and skipped.is_closed_by(tag, ends):
                skipped = None
                continue
            else:
                continue
        if tag == "br":
            out.add(" ", links > 0)
            continue
        if tag == "a":
            links = max(0, links + (-1 if ends else 1))
            continue
        can_be_marked = tag not in ("main", "body", "html")
        can_be_marked &= had_article or tag != "article"
        marked = can_be_marked and not ends and is_marked(token["attrs"])
        if tag not in BLOCKS and not marked:
            continue
        out.end()
        links = 0
        leave_out = tag in NEVER_TEXT and not (tag == "header" and articles)
        if not ends and not closed and (leave_out or marked):
            out.gap()
            skipped = LeftOut(tag)
            continue
        if tag in ARTICLE:
            articles = max(0, articles + (-1 if ends else 1))
            out.article = articles > 0
            had_article = True
    out.end()
    return out.lines


def main_text(page: str | None) -> str:
    lines = page_lines(page or "")
    marked = any(inside and length for _, length, inside in lines)
    lengths = [
        length if inside or not marked else 0 for _, length, inside in lines
    ]
    sums = [sum(lengths[k : k + WINDOW]) for k in range(len(lengths))]
    surge = 1 if marked else min(SURGE, max(sums, default=0))
    kept, inside = [], False
    for k, (text, _, in_article) in enumerate(lines):
        if not inside and sums[k] >= surge and lengths[k]:
            inside = True
        elif inside and not sums[k]:
            inside = False
        if inside and text and (in_article or not marked):
            kept.append(text)
    return "\n\n".join(kept)


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text and its length of every row."""
    schema = arrow_schema(OUT)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(value.as_py()) for value in batch["html"]]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["page_id"].cast(pa.int64()),
                    batch["url"].cast(pa.string()),
                    pa.array(texts, pa.string()),
                    pa.array(map(len, texts), pa.int64()),
                ],
                schema=schema,
            )

    return pages.select("page_id", "url", "html").mapInArrow(extract, OUT)


def main_text_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9: main text of all pages."""
    return extract_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))
