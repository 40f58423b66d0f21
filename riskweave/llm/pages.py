"""Main text of web pages from flat text blocks.

A page becomes a list of blocks between block-level tags, each with its words, the share of them in links, the same of its
neighbours, and the elements around it. A decision tree, grown from a small labelled table, tells content from the rest.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm.common import bounded, table, text_or_empty

# Names of elements, and words in class, id and role that mark what isn't the article.
SKIPPED = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "select", "object", "canvas",
           "option", "math", "audio", "video", "datalist"}
#: Of these, those whose content is raw text up to their own closing tag, and those that stand in others of their name.
RAW, NESTED = {"script", "style", "textarea", "title"}, {"template", "svg", "object", "canvas", "math", "audio", "video"}
BLOCKS = {"address", "article", "aside", "blockquote", "body", "button", "caption", "center", "dd", "details", "dialog", "dir",
          "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
          "head", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "section",
          "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
EMPTY = {"hr", "br", "img", "input", "meta", "link", "wbr", "area", "base", "col", "embed", "source", "track"}
AROUND = {"nav", "footer", "aside", "menu", "button", "dialog", "head"}
FORMS = {"form", "fieldset"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
MARKS = {"ad", "ads", "advert", "advertisement", "advertising", "adverts", "banner", "breadcrumb", "breadcrumbs", "comment",
         "comments", "consent", "contentinfo", "cookie", "cookies", "copyright", "discussion", "disqus", "footer", "form",
         "gdpr", "header", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice",
         "pagination", "popup", "promo", "promoted", "promotion", "related", "replies", "reply", "responses", "search",
         "share", "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "subscription", "toolbar",
         "topbar", "widget", "complementary"}
#: Words behind these in a class name what is somewhere in the element, or isn't ("has-sidebar", "no-ads").
STATES = {"has", "have", "with", "without", "no", "not", "non"}
CLOSES_P = BLOCKS - {"button", "body", "html", "head", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"}

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)"
                  r"((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)", re.DOTALL)
_MARKED = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.IGNORECASE)
_NAME = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")


@dataclass(slots=True)
class Block:
    text: str
    words: int
    linked: int
    main: bool
    around: bool
    heading: bool


@dataclass(slots=True, eq=False)
class Element:
    name: str
    parent: Element | None
    main: bool
    beside: bool = False  # by its name, or hidden: holds for all that it contains
    marked: bool = False  # by class, id or role: holds unless the article is in it
    holds: bool = False
    around: bool = False
    words: int = 0  # outside links
    first_heading: bool = False


def _marks(attributes: str, own_header: bool) -> tuple[bool, bool]:
    """Whether the element is hidden, and whether class, id or role name something beside the article.

    With ``own_header`` a header is that of the article.
    """
    hidden = marked = False
    for name, value in _MARKED.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" and value != "until-found" or name == "aria-hidden" and value == "true":
            hidden = True
        elif name == "style":
            hidden = hidden or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value) is not None
        elif name in ("class", "id", "role"):
            for token in value.split():
                for word in _NAME.findall(token):
                    if word in STATES:
                        break
                    marked = marked or word in MARKS and not (own_header and word == "header")
    return hidden, marked


def _skip(page: str, at: int, name: str, parent: str, last: dict[str, int]) -> int:
    """Where a skipped element ends that was opened before ``at``: behind its own closing tag, else at that of its parent.

    With neither in the page only the tag is skipped. ``last`` keeps where the page closes an element for the last time.
    """
    if name in RAW:
        end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
        return end.end() if end else len(page)
    if name == "option":  # holds text alone, and needn't be closed
        end = re.compile(r"<[/a-zA-Z]").search(page, at)
        return end.start() if end else len(page)
    for n in {name, parent} - last.keys() - {""}:
        last[n] = max((m.start() for m in re.finditer(rf"</{n}\b", page, re.IGNORECASE)), default=-1)
    if last[name] < at and last.get(parent, -1) < at:
        return at
    depth, outer = 1, 0
    names = name if not parent else f"{name}|{parent}"
    for m in re.compile(rf"<(/?)({names})(?![\w:-])([^>]*)(?:>|\Z)", re.IGNORECASE).finditer(page, at):
        if m[2].lower() == name:
            if m[1]:
                depth -= 1
                if not depth:
                    return m.end()
            elif name in NESTED and not m[3].endswith("/"):
                depth += 1
        elif not m[1]:
            outer += 1
        elif not outer:
            return m.start()
        else:
            outer -= 1
    return at


def _settle(elements: list[Element]) -> None:
    """Decide which elements stand around the article."""

    def hold(e: Element | None) -> None:
        while e is not None and not e.holds:
            e.holds = True
            e = e.parent

    def judge() -> None:
        for e in elements:  # parents come first
            e.around = e.beside or e.marked and not e.holds or e.parent is not None and e.parent.around

    own = [e.words for e in elements]
    for e in reversed(elements):
        if e.parent is not None:
            e.parent.words += e.words
            e.parent.first_heading = e.parent.first_heading or e.first_heading
    total = sum(e.words for e in elements if e.parent is None)
    for e in elements:
        if e.name == "main":
            hold(e)
        elif e.name in FORMS:  # one around the whole page says nothing
            e.beside = e.beside or not (e.first_heading or 2 * e.words > total)
    judge()
    if any(e.main and not e.around for e in elements):
        return
    # no article is left: the one under the fewest marks, of these the longest, if more is in it than in all that is left
    best = None
    for e in elements:
        if e.name == "article" and (e.parent is None or not e.parent.main):
            marks, up, beside = 0, e, False
            while up is not None and not beside:
                marks, beside, up = marks + up.marked, up.beside, up.parent
            if not beside and (best is None or (marks, -e.words) < best[0]):
                best = (marks, -e.words), e
    if best is not None and best[1].words > sum(n for e, n in zip(elements, own) if not e.around):
        hold(best[1])
        judge()


def blocks(page: str) -> list[Block]:
    """The blocks of a page in order; markup that is cut off or unbalanced is read as far as it goes."""
    found: list[Block] = []
    inside: list[Element | None] = []  # the element of each block
    elements: list[Element] = []
    open_tags: list[Element] = []
    last_closed: dict[str, int] = {}
    parts: list[str] = []
    linked: list[str] = []
    in_link = heading = False

    def close_block() -> None:
        if parts:
            text = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
            if text:
                links = _SPACE.sub(" ", html.unescape("".join(linked))).strip()
                e = open_tags[-1] if open_tags else None
                b = Block(text, text.count(" ") + 1, links.count(" ") + 1 if links else 0, e is not None and e.main, False, heading)
                found.append(b)
                inside.append(e)
                if e is not None:
                    e.words += max(0, b.words - b.linked)
        parts.clear()
        linked.clear()

    at = 0
    while at < len(page):
        m = _TAG.search(page, at)
        if m is None or m.start() > at:
            part = page[at:m.start() if m else len(page)]
            parts.append(part)
            if in_link:
                linked.append(part)
        if m is None:
            break
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if name in SKIPPED:
            parts.append(" ")
            if not m[1] and not m[3].endswith("/"):
                at = _skip(page, at, name, open_tags[-1].name if open_tags else "", last_closed)
            continue
        if name == "a":
            in_link = not m[1]
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name not in BLOCKS:
            continue
        close_block()
        in_link = False
        heading = False
        if m[1]:
            if any(e.name == name for e in open_tags):
                while open_tags.pop().name != name:
                    pass
            continue
        if name in CLOSES_P and open_tags and open_tags[-1].name == "p":
            open_tags.pop()
        heading = name in HEADINGS
        if name in EMPTY:
            continue
        e = Element(name, open_tags[-1] if open_tags else None, bool(open_tags) and open_tags[-1].main)
        if name != "body":
            e.beside, e.marked = _marks(m[3], e.main or heading)
        e.beside = e.beside or name in AROUND or (name == "header" and not e.main)
        e.main = e.main or name in ("article", "main")
        e.first_heading = name == "h1"
        elements.append(e)
        open_tags.append(e)
    close_block()
    _settle(elements)
    for b, e in zip(found, inside):
        b.around = e is not None and e.around
    return found


FEATURES = ("words", "density", "words_before", "density_before", "words_after", "density_after", "main", "around", "heading",
            "page_has_main")


def features(found: list[Block]) -> list[tuple[float, ...]]:
    sized = [(0.0, 0.0), *((float(b.words), min(1.0, b.linked / b.words)) for b in found), (0.0, 0.0)]
    has_main = float(any(b.main and not b.around for b in found))
    return [(*sized[i + 1], *sized[i], *sized[i + 2], float(b.main), float(b.around), float(b.heading), has_main)
            for i, b in enumerate(found)]


#: The labelled table, features in the order above, then 1 for content: blocks of pages without an article element ...
LABELLED = [
    (1, 1.0, 0, 0.0, 1, 1.0, 0, 1, 0, 1, 0), (2, 1.0, 1, 1.0, 1, 1.0, 0, 1, 0, 1, 0), (3, 1.0, 2, 1.0, 9, 0.0, 0, 1, 0, 1, 0),
    (9, 0.0, 1, 1.0, 8, 0.0, 0, 1, 0, 1, 0), (24, 0.0, 3, 1.0, 10, 0.0, 0, 1, 0, 1, 0), (60, 0.0, 9, 0.0, 0, 0.0, 0, 1, 0, 1, 0),
    (12, 0.1, 80, 0.0, 0, 0.0, 0, 1, 0, 1, 0), (18, 0.0, 140, 0.0, 4, 0.5, 1, 1, 0, 1, 0), (45, 0.0, 60, 0.0, 30, 0.0, 1, 1, 0, 1, 0),
    (6, 0.0, 45, 0.0, 20, 0.0, 1, 1, 1, 1, 0), (5, 0.6, 30, 0.0, 3, 1.0, 1, 1, 0, 1, 0), (120, 0.0, 4, 0.0, 90, 0.0, 0, 1, 0, 0, 0),
    (7, 0.0, 12, 0.0, 110, 0.0, 1, 0, 1, 1, 1), (110, 0.0, 7, 0.0, 3, 0.0, 1, 0, 0, 1, 1), (3, 0.0, 110, 0.0, 75, 0.05, 1, 0, 0, 1, 1),
    (75, 0.05, 3, 0.0, 1, 0.0, 1, 0, 0, 1, 1), (1, 0.0, 75, 0.05, 18, 0.0, 1, 0, 0, 1, 1), (18, 0.4, 1, 0.0, 5, 1.0, 1, 0, 0, 1, 1),
    (5, 1.0, 18, 0.4, 60, 0.0, 1, 0, 0, 1, 1), (2, 0.0, 60, 0.0, 0, 0.0, 1, 0, 0, 1, 1), (250, 0.02, 8, 0.0, 14, 0.1, 1, 0, 0, 1, 1),
    (4, 0.0, 0, 0.0, 30, 0.0, 1, 0, 1, 1, 1), (30, 0.0, 4, 0.0, 11, 1.0, 1, 0, 0, 1, 1), (11, 1.0, 30, 0.0, 11, 0.9, 1, 0, 0, 1, 1),
    (10, 0.0, 3, 1.0, 7, 0.0, 0, 0, 0, 1, 0), (40, 0.0, 6, 0.0, 3, 0.0, 0, 0, 0, 1, 0), (95, 0.0, 40, 0.0, 70, 0.0, 0, 0, 0, 1, 0),
    (5, 0.0, 0, 0.0, 12, 0.0, 0, 0, 1, 1, 0), (4, 1.0, 95, 0.0, 4, 1.0, 0, 0, 0, 1, 0), (9, 0.0, 120, 0.0, 0, 0.0, 0, 0, 0, 1, 0),
    (8, 0.0, 2, 1.0, 90, 0.0, 0, 0, 1, 0, 1), (90, 0.0, 8, 0.0, 35, 0.03, 0, 0, 0, 0, 1), (35, 0.03, 90, 0.0, 6, 0.0, 0, 0, 0, 0, 1),
    (6, 0.0, 35, 0.03, 50, 0.0, 0, 0, 0, 0, 1), (50, 0.0, 6, 0.0, 28, 0.1, 0, 0, 0, 0, 1), (28, 0.1, 50, 0.0, 2, 1.0, 0, 0, 0, 0, 1),
    (17, 0.0, 28, 0.1, 44, 0.0, 0, 0, 0, 0, 1), (130, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 0, 1), (22, 0.0, 0, 0.0, 41, 0.0, 0, 0, 0, 0, 1),
    (5, 0.0, 1, 1.0, 64, 0.0, 0, 0, 1, 0, 1), (3, 0.0, 70, 0.0, 88, 0.0, 0, 0, 1, 0, 1), (2, 0.0, 44, 0.0, 51, 0.0, 0, 0, 0, 0, 1),
    (1, 1.0, 0, 0.0, 2, 1.0, 0, 0, 0, 0, 0), (2, 1.0, 1, 1.0, 2, 1.0, 0, 0, 0, 0, 0), (3, 1.0, 2, 1.0, 8, 0.0, 0, 0, 0, 0, 0),
    (6, 0.5, 28, 0.1, 3, 1.0, 0, 0, 0, 0, 0), (14, 0.8, 4, 1.0, 60, 0.0, 0, 0, 0, 0, 0), (25, 0.9, 70, 0.0, 45, 0.0, 0, 0, 0, 0, 0),
    (4, 0.0, 3, 1.0, 4, 0.0, 0, 0, 0, 0, 0), (4, 0.0, 4, 0.0, 2, 1.0, 0, 0, 0, 0, 0), (7, 0.0, 90, 0.0, 0, 0.0, 0, 0, 0, 0, 0),
    (3, 0.0, 0, 0.0, 1, 1.0, 0, 0, 1, 0, 0), (5, 0.0, 5, 1.0, 6, 0.7, 0, 0, 1, 0, 0), (8, 0.0, 6, 0.0, 7, 0.0, 0, 0, 0, 0, 0),
    (150, 0.01, 20, 0.0, 100, 0.0, 0, 0, 0, 0, 1), (95, 0.0, 3, 1.0, 2, 1.0, 0, 0, 0, 0, 1), (55, 0.0, 0, 0.0, 7, 0.0, 0, 0, 0, 0, 1),
    (200, 0.05, 50, 0.0, 0, 0.0, 0, 0, 0, 0, 1), (70, 0.1, 1, 1.0, 10, 0.0, 0, 0, 0, 0, 1), (10, 0.0, 40, 0.0, 35, 0.0, 0, 0, 0, 0, 1),
    (13, 0.0, 60, 0.0, 44, 0.0, 0, 0, 0, 0, 1), (45, 0.02, 0, 0.0, 12, 0.0, 0, 0, 0, 0, 1), (33, 0.0, 5, 0.0, 6, 1.0, 0, 0, 0, 0, 1),
    (28, 0.0, 9, 0.0, 14, 0.0, 0, 0, 0, 0, 1), (85, 0.0, 45, 0.0, 3, 0.0, 0, 0, 0, 0, 1), (41, 0.0, 30, 0.0, 25, 0.0, 0, 0, 0, 0, 1),
    (12, 0.0, 3, 1.0, 5, 0.0, 0, 0, 0, 0, 0), (15, 0.2, 0, 0.0, 8, 0.5, 0, 0, 0, 0, 0), (30, 0.5, 6, 1.0, 40, 0.0, 0, 0, 0, 0, 0),
    (100, 0.7, 5, 1.0, 30, 1.0, 0, 0, 0, 0, 0), (90, 0.6, 80, 0.0, 60, 0.0, 0, 0, 0, 0, 0), (35, 0.9, 90, 0.0, 0, 0.0, 0, 0, 0, 0, 0),
    (40, 0.6, 3, 1.0, 20, 0.7, 0, 0, 0, 0, 0), (60, 0.7, 12, 0.8, 30, 0.9, 0, 0, 0, 0, 0),
]

#: ... and what holds for blocks of all sizes: the article counts, all that stands around it doesn't.
_SIZES = (1, 2, 4, 9, 20, 50, 120, 300)
_NEAR = ((0, 0.0, 5, 0.0), (6, 1.0, 40, 0.0), (90, 0.0, 2, 0.5), (150, 0.1, 80, 0.0))
LABELLED += [(w, d, *near, 1, 0, h, 1, 1) for w in _SIZES for d, h in ((0.0, 0), (0.0, 1), (0.3, 0), (1.0, 0)) for near in _NEAR]
LABELLED += [(w, d, *near, m, 1, 0, p, 0) for w in _SIZES for d in (0.0, 0.3, 1.0) for m, p in ((0, 0), (0, 1), (1, 1))
             for near in _NEAR]
LABELLED += [(w, d, *near, 0, 0, 0, 1, 0) for w in _SIZES for d in (0.0, 0.3, 1.0) for near in _NEAR]


def grow(rows: list[tuple[float, ...]]) -> tuple | float:
    """A decision tree: (feature, limit, tree for values up to it, tree for those above), or a leaf's share of content.

    Each split takes the feature and limit with the least Gini impurity, the first of equal ones, until leaves are pure.
    """
    share = sum(r[-1] for r in rows) / len(rows)
    if share in (0.0, 1.0):
        return share

    def impurity(part: list[tuple[float, ...]]) -> float:
        p = sum(r[-1] for r in part) / len(part)
        return 2 * p * (1 - p) * len(part)

    best = None
    for f in range(len(rows[0]) - 1):
        values = sorted({r[f] for r in rows})
        for low, high in zip(values, values[1:]):
            limit = (low + high) / 2
            cost = impurity([r for r in rows if r[f] <= limit]) + impurity([r for r in rows if r[f] > limit])
            if best is None or cost < best[0] - 1e-9:
                best = (cost, f, limit)
    if best is None:
        return share
    _, f, limit = best
    return f, limit, grow([r for r in rows if r[f] <= limit]), grow([r for r in rows if r[f] > limit])


def is_content(tree: tuple | float, row: tuple[float, ...]) -> bool:
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree > 0.5


def main_text(page: str, tree: tuple | float) -> str:
    found = blocks(page)
    return "\n\n".join(b.text for b, row in zip(found, features(found)) if is_content(tree, row))


def extract(df: DataFrame, labelled: list[tuple[float, ...]] = LABELLED, key: str = "page_id", url: str = "url",
            page: str = "html") -> DataFrame:
    """One row per row: page_id, url, text, n_chars. A null or empty page, or one without content, has the empty text."""
    rows = [tuple(map(float, r)) for r in labelled]
    tree = grow(rows) if rows else 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(v.as_py(), tree) for v in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    taken = bounded(df).select(F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
                      text_or_empty(page).alias("html"))
    return taken.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
