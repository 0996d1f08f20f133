"""Main text of web pages by their line-block distribution.

Markup is stripped into lines: one for each stretch of text between block-level tags, with character references decoded and
white space collapsed. A line weighs as many characters as it has outside links; lines in menus, headers, footers, asides,
forms, notices, adverts, comments or hidden elements are left out first. The weights of the others are summed over a window that
slides over the lines, and fall to zero between runs of text (where a page has text in links alone, links count). A run is dense if its largest sum has at least ``DENSE`` of the
page's largest. The text surges where the first dense run begins and dives where the last one ends; what lies between is the
main text, lists of links too. If the page marks an article (``article`` or ``main``) that the stretch touches, the ends move out to
its borders, so short first and last paragraphs stay. Articles in one ``main`` or article, and articles side by side in one
element, are one. Marks never take lines away.

An element's class or id sets it apart if it is a block and one of its names is made of ``NAMES`` alone, or of them and ``COMPANIONS`` (``cookie-notice``,
``site-header``); ``article`` and ``main`` are never set apart by a name, nor are the header and the title parts of an article. Fallback text, formulas and
drawings (``FALLBACKS``) count inside an article.

Damaged markup: unclosed and stray tags, comments or scripts that never end, quotes that never close, and "<" in text are accepted, in time linear in
the page. A script, style,
textarea or comment that never ends takes the rest of the page; any other element without text of its own ends at the next block. An article that begins
inside an unclosed block is read as an article. Null and empty pages, and pages without text, give empty text. Rows are
independent: ties, repeated rows and null ids need no rule. Input columns that clash with ``text`` are replaced.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WINDOW = 3
DENSE = 0.25

# Element names of HTML, by what they mean for the text.
RAW = {"script", "style", "textarea"}
SKIPPED = {"template", "iframe", "title", "select", "option", "datalist"}
FALLBACKS = {"noscript", "svg", "math", "object", "canvas", "audio", "video"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption",
    "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p",
    "pre", "search", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
APART = {"nav", "header", "footer", "aside", "form", "dialog", "menu", "button", "fieldset", "search"}
AROUND_ARTICLES = ("nav", "aside", "footer")
SIBLINGS = {"p", "li", "dt", "dd", "tr", "td", "th"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu", "menubar", "toolbar"}
NAMES = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion", "banner", "cookie", "cookies", "consent",
    "gdpr", "notice", "popup", "modal", "overlay", "sidebar", "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "header", "masthead",
    "footer", "comment", "comments", "respond", "disqus", "share", "sharing", "social", "related", "recommended", "newsletter", "subscribe", "subscription",
    "login", "signup", "pagination", "pager", "toolbar", "widget", "skip", "reply", "replies", "discussion",
}
COMPANIONS = {"site", "page", "global", "top", "bottom", "left", "right", "main", "primary", "secondary", "bar", "box", "list", "area", "section", "wrapper", "container", "block", "links", "buttons", "form", "thread", "user", "reader", "to", "content"}
TITLE_PARTS = {"header", "masthead", "banner"}

_OPEN = re.compile(r"<(?:(?P<comment>!--)|[!?]|(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+))")
_EDGE = re.compile(r"""[>"']""")
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
_NEXT_BLOCK = rf"</?(?:head|{'|'.join(sorted(BLOCKS))})(?=[\s/>])"


class Finder:
    """Next match of a pattern from a place on, for places that rise: a page is searched once."""

    def __init__(self, page: str, pattern: str):
        self.page, self.search, self.found, self.over = page, re.compile(pattern, re.IGNORECASE).search, None, False

    def next(self, at: int) -> re.Match[str] | None:
        if not self.over and (self.found is None or self.found.start() < at):
            self.found = self.search(self.page, at)
            self.over = self.found is None
        return self.found


@dataclass(frozen=True)
class Tag:
    start: int
    stop: int
    name: str  # empty for comments, declarations and skipped elements
    end: bool = False
    rest: str = ""


def tags_of(page: str) -> Iterator[Tag]:
    """The markup of a page in order."""
    finders: dict[str, Finder] = {}

    def find(pattern: str, at: int) -> re.Match[str] | None:
        return finders.setdefault(pattern, Finder(page, pattern)).next(at)

    def tag_end(at: int) -> int:
        """Behind the ">" of a tag; -1 without any. Quotes hide a ">" unless they are never closed or hide all that follow."""
        nonlocal quoted
        place = at
        while quoted and (edge := _EDGE.search(page, place)):
            if edge[0] == ">":
                return edge.end()
            close = page.find(edge[0], edge.end()) if edge[0] not in unpaired else -1
            if close < 0:
                unpaired.add(edge[0])
            place = edge.end() if close < 0 else close + 1
        quoted = False
        return page.find(">", at) + 1 or -1

    quoted, unpaired, at = True, set(), 0
    last = page.rfind(">")
    while opened := _OPEN.search(page, at):
        start = opened.start()
        if opened["comment"]:
            stop = page.find("-->", opened.end())
            at = len(page) if stop < 0 else stop + 3
            yield Tag(start, at, "")
            continue
        if opened["name"] is None:
            stop = page.find(">", opened.end())
            at = len(page) if stop < 0 else stop + 1
            yield Tag(start, at, "")
            continue
        stop = tag_end(opened.end()) if opened.end() <= last else -1
        if stop < 0:
            return
        name, end, at = opened["name"].lower(), bool(opened["end"]), stop
        if not end and name in RAW:
            close = find(rf"</{name}\s*+[^>]*+>", stop)
            at = close.end() if close else len(page)
            yield Tag(start, at, "")
        elif not end and name in SKIPPED:
            close, again, block = find(rf"</{name}\s*+[^>]*+>", stop), find(rf"<{name}(?=[\s/>])", stop), find(_NEXT_BLOCK, stop)
            if close and not (again and again.start() < close.start()):
                at = close.end()
            else:
                at = block.start() if block else len(page)
            yield Tag(start, at, "")
        else:
            yield Tag(start, stop, name, end, page[opened.end() : stop - 1])


def named_apart(value: str, inside_article: bool) -> bool:
    """Whether one of the names in a class or id is that of a part beside the text."""
    for name in value.split():
        words = [w for w in re.split(r"[^a-z]+", name) if w]
        if any(w in NAMES for w in words) and all(w in NAMES or w in COMPANIONS for w in words):
            if not (inside_article and all(w in TITLE_PARTS or w in COMPANIONS for w in words)):
                return True
    return False


def set_apart(name: str, rest: str, inside_article: bool) -> bool:
    """Whether an element holds none of the main text."""
    if name in APART and not (name == "header" and inside_article):
        return True
    for key, double, single, plain in _ATTRIBUTE.findall(rest) if rest else ():
        key, value = key.lower(), (double or single or plain).lower()
        if key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and _HIDDEN.search(value)):
            return True
        if key == "role" and value in ROLES and not (value == "banner" and inside_article):
            return True
        if key in ("class", "id") and name in BLOCKS and name not in ("article", "main", "body", "html") and named_apart(value, inside_article):
            return True
    return False


def unclosed(tags: list[Tag]) -> set[int]:
    """Places in the page of block elements that are never ended."""
    open_at: list[tuple[str, int]] = []
    times: Counter[str] = Counter()
    loose: set[int] = set()
    for tag in tags:
        if tag.name not in BLOCKS or tag.name in VOID:
            continue
        if not tag.end:
            if tag.name in SIBLINGS and open_at and open_at[-1][0] == tag.name:
                open_at.pop()
                times[tag.name] -= 1
            open_at.append((tag.name, tag.start))
            times[tag.name] += 1
        elif times[tag.name]:
            while (last := open_at.pop())[0] != tag.name:
                loose.add(last[1])
                times[last[0]] -= 1
            times[tag.name] -= 1
    return loose | {place for _, place in open_at}


class OpenElements:
    """The elements around a place: (name, set apart by itself or by one around it, article, place in the page)."""

    def __init__(self):
        self.stack: list[tuple[str, bool, int, int]] = []
        self.depths: dict[str, list[int]] = {}

    def push(self, name: str, apart: bool, article: int, place: int) -> None:
        self.depths.setdefault(name, []).append(len(self.stack))
        self.stack.append((name, apart, article, place))

    def pop(self) -> None:
        self.depths[self.stack.pop()[0]].pop()

    def close(self, name: str) -> bool:
        """Ends the innermost element of the name with all inside it."""
        if not self.depths.get(name):
            return False
        for _ in range(len(self.stack) - self.depths[name][-1]):
            self.pop()
        return True

    def has(self, *names: str) -> bool:
        return any(self.depths.get(name) for name in names)

    def state(self) -> tuple[bool, int]:
        return self.stack[-1][1:3] if self.stack else (False, 0)


def page_lines(page: str) -> list[tuple[str, int, int]]:
    """(text, weight, article) of every line in page order; lines set apart have weight -1, article 0 is none. Nested and sibling articles are one."""
    lines: list[tuple[str, int, int]] = []
    parts: list[str] = []
    linked = 0
    around = OpenElements()
    apart, article, link, muted = False, 0, 0, ""
    articles: dict[int, int] = {}  # by the place of the element around them

    def end_line() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            lines.append((text, -1 if apart else max(0, len(text) - text.count(" ") - linked), article))
        parts.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if muted:
            return
        parts.append(text)
        if link:
            linked += len("".join(html.unescape(text).split()))

    at = 0
    tags = list(tags_of(page))
    loose = unclosed(tags)
    ends_soon = False  # an element set apart but never ended holds no more than the text up to the next block
    for tag in tags:
        if tag.start > at:
            add(page[at : tag.start])
        at = tag.stop
        name = tag.name
        if not name:
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name in BLOCKS:
            muted = ""
            if name in ("td", "th"):
                parts.append(" ")
            else:
                end_line()
            if ends_soon and around.stack:
                around.pop()
                apart, article = around.state()
            ends_soon = False
            if not tag.end and name in SIBLINGS and around.stack and around.stack[-1][0] == name:
                around.pop()
                apart, article = around.state()
        if name in FALLBACKS:
            muted = name if not (tag.end or article) else "" if name == muted else muted
            continue
        if tag.end:
            if name == "a":
                link = max(0, link - 1)
            if around.close(name):
                apart, article = around.state()
            continue
        if name in VOID:
            continue
        if name == "a":
            link = 1
        own = set_apart(name, tag.rest, article > 0)
        if name in ("article", "main") and not own:
            # Unclosed blocks before an article do not take it along; a menu or an aside around it does.
            apart = around.has(*AROUND_ARTICLES)
            link = 0
            if not article:
                outer = next((x[3] for x in reversed(around.stack) if x[0] != "p"), -1)
                article = articles.setdefault(outer, len(articles) + 1)
        if name in BLOCKS or own:
            apart = apart or own
            around.push(name, apart, article, tag.start)
            ends_soon = own and name in BLOCKS and tag.start in loose
    if at < len(page):
        add(page[at:])
    end_line()
    return lines


def main_text(page: str | None) -> str:
    """The lines of the main text, joined by line feeds."""
    lines = [x for x in page_lines(page or "") if x[1] >= 0]
    if not lines:
        return ""
    weights = [w for _, w, _ in lines]
    if not any(weights):
        weights = [len(text) for text, _, _ in lines]
    half = WINDOW // 2
    sums = [sum(weights[max(0, i - half) : i + half + 1]) for i in range(len(weights))]
    dense = [i for i, x in enumerate(sums) if x >= DENSE * max(sums)]
    surge, dive = dense[0], dense[-1]
    while surge > 0 and sums[surge - 1]:
        surge -= 1
    while dive < len(sums) - 1 and sums[dive + 1]:
        dive += 1
    while not weights[surge]:
        surge += 1
    while not weights[dive]:
        dive -= 1
    touched = {own for _, _, own in lines[surge : dive + 1]} - {0}
    inside = [i for i, x in enumerate(lines) if x[2] in touched]
    surge, dive = min([surge, *inside]), max([dive, *inside])
    return "\n".join(text for text, _, _ in lines[surge : dive + 1])


def extract_text(pages: DataFrame, html_column: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The ``keep`` columns of every page, and the main ``text`` of its whole html."""
    keep = tuple(c for c in keep if c != "text")
    schema = T.StructType([pages.schema[c] for c in keep] + [T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x) for x in batch.column(len(keep)).to_pylist()]
            yield pa.record_batch([*batch.columns[: len(keep)], pa.array(texts, pa.string())], [*keep, "text"])

    return pages.select(*keep, F.col(html_column).cast("string").alias("__html")).mapInArrow(run, schema)
