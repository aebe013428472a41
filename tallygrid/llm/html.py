"""Main text of web pages: flat text blocks, classified by a decision tree.

A page is cut into blocks at the tags that start a new line. Each block is described by its
number of words and its link density (words inside links over words), the same of the blocks
before and after it, its place (inside the article, outside it, or neither if the page marks none)
and whether one of the elements around it is named like a menu, advert, form, notice or comment. A
decision tree, grown from the small labelled table ``LABELLED``, says which blocks are text of
the article: place and name shift the decision, words and links make it. An article that is named
like chrome marks no place. The name of a layout wrapper ("has-sidebar") does not reach an article
inside it, unless the page has another one outside such wrappers. Scripts, styles and comments of the markup never become blocks.

Defined results for odd input: a null or empty page has an empty text; unclosed tags end with
the element around them; a "<" that starts no tag is text; null ids, repeated rows and pages
without any block keep their row; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
    r"|<(/?)([A-Za-z][A-Za-z0-9:-]*)([^>]*)(?:>|\Z)",
    re.DOTALL,
)
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none", re.IGNORECASE)
PART = re.compile(r"[a-z]+")

RAW = {"script", "style", "textarea", "title", "xmp"}
#: elements that hold blocks and are closed by their own end tag
HOLDERS = {
    "html", "body", "main", "article", "section", "div", "nav", "header", "footer", "aside", "form",
    "ul", "ol", "dl", "table", "blockquote", "figure", "details", "fieldset", "menu", "dialog",
    "noscript", "template", "select", "button", "svg", "iframe", "object", "head", "address",
}
#: elements that start a block and end with the next one
STARTS = {
    "p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "tr", "td", "th", "thead", "tbody",
    "caption", "pre", "hr", "figcaption", "summary", "legend", "option", "center",
}
AROUND = {
    "nav", "footer", "aside", "form", "fieldset", "menu", "dialog", "noscript", "template", "select",
    "button", "svg", "iframe", "object", "head",
}
NAMED = {
    "ad", "ads", "advert", "advertisement", "adverts", "sponsor", "sponsored", "promo", "promotion",
    "banner", "cookie", "cookies", "consent", "notice", "notices", "alert", "sidebar", "menu", "nav",
    "navbar", "navigation", "breadcrumb", "breadcrumbs", "footer", "masthead", "comment", "comments",
    "reply", "replies", "disqus", "share", "sharing", "social", "related", "newsletter", "subscribe",
    "subscription", "popup", "modal", "overlay", "widget", "login", "signup", "pagination", "pager",
    "toolbar", "skip", "copyright", "search", "complementary", "contentinfo", "dialog",
}
#: names that a wrapper of the whole page may have as well
LAYOUT = {
    "sidebar", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "footer", "masthead",
    "banner", "toolbar", "widget", "search", "skip", "notice", "notices", "alert",
}
ARTICLE = {"article", "main"}

#: words, link density, words and link density before, words and link density after, place
#: (1 inside the article, 0 outside it, 0.5 no article is marked), named like chrome; label
LABELLED = np.array(
    [
        [12, 0.0, 0, 0.0, 90, 0.0, 1, 0, 1],
        [90, 0.0, 12, 0.0, 45, 0.0, 1, 0, 1],
        [45, 0.1, 90, 0.0, 3, 0.0, 1, 0, 1],
        [3, 0.0, 45, 0.1, 60, 0.0, 1, 0, 1],
        [1, 0.0, 60, 0.0, 0, 0.0, 1, 0, 1],
        [25, 0.6, 30, 0.0, 1, 1.0, 1, 0, 1],
        [4, 1.0, 70, 0.0, 80, 0.0, 1, 0, 1],
        [2, 0.0, 1, 1.0, 9, 0.0, 1, 0, 1],
        [200, 0.0, 5, 1.0, 8, 0.5, 1, 0, 1],
        [3, 1.0, 60, 0.0, 4, 1.0, 1, 0, 0],
        [4, 1.0, 3, 1.0, 5, 1.0, 1, 0, 0],
        [1, 1.0, 1, 1.0, 1, 1.0, 1, 0, 0],
        [5, 1.0, 4, 1.0, 60, 0.0, 1, 0, 0],
        [9, 0.9, 8, 1.0, 0, 0.0, 1, 0, 0],
        [15, 0.0, 80, 0.0, 12, 0.1, 1, 1, 0],
        [40, 0.0, 60, 0.0, 30, 0.0, 1, 1, 0],
        [3, 1.0, 20, 0.0, 5, 0.0, 1, 1, 0],
        [120, 0.0, 90, 0.0, 45, 0.0, 1, 1, 0],
        [1, 1.0, 0, 0.0, 1, 1.0, 0, 1, 0],
        [1, 1.0, 1, 1.0, 9, 0.0, 0, 1, 0],
        [9, 0.0, 1, 1.0, 12, 0.0, 0, 1, 0],
        [10, 0.0, 200, 0.0, 0, 0.0, 0, 1, 0],
        [80, 0.0, 200, 0.0, 40, 0.0, 0, 1, 0],
        [12, 0.0, 0, 0.0, 40, 0.0, 0, 0, 0],
        [60, 0.0, 90, 0.0, 30, 0.0, 0, 0, 1],
        [2, 1.0, 3, 1.0, 80, 0.0, 0, 0, 0],
        [150, 0.1, 4, 0.0, 100, 0.0, 0, 0, 1],
        [60, 0.0, 50, 0.0, 70, 0.0, 0.5, 0, 1],
        [110, 0.1, 3, 1.0, 60, 0.0, 0.5, 0, 1],
        [30, 0.2, 80, 0.0, 5, 1.0, 0.5, 0, 1],
        [18, 0.0, 40, 0.0, 60, 0.0, 0.5, 0, 1],
        [6, 0.0, 2, 1.0, 70, 0.0, 0.5, 0, 1],
        [8, 0.0, 60, 0.0, 50, 0.0, 0.5, 0, 1],
        [16, 0.0, 0, 0.0, 0, 0.0, 0.5, 0, 1],
        [20, 0.0, 50, 0.1, 2, 1.0, 0.5, 0, 1],
        [4, 1.0, 3, 1.0, 5, 1.0, 0.5, 0, 0],
        [20, 0.8, 30, 0.0, 10, 0.9, 0.5, 0, 0],
        [2, 1.0, 0, 0.0, 90, 0.0, 0.5, 0, 0],
        [5, 0.0, 3, 1.0, 4, 1.0, 0.5, 0, 0],
        [7, 0.0, 90, 0.0, 0, 0.0, 0.5, 0, 0],
        [50, 0.9, 3, 1.0, 60, 0.9, 0.5, 0, 0],
        [70, 0.0, 50, 0.0, 30, 0.0, 0.5, 1, 0],
        [8, 0.0, 1, 1.0, 60, 0.0, 0.5, 1, 0],
        [14, 0.0, 200, 0.0, 0, 0.0, 0.5, 1, 0],
    ]
)


# --- the tree


def grow(table: np.ndarray, depth: int = 8) -> tuple:
    """A tree (feature, cut, at or below, above) or (label,) from rows with their label last."""
    labels = table[:, -1]
    share = labels.mean()
    if depth == 0 or share in (0.0, 1.0):
        return (bool(share >= 0.5),)
    best = None
    for feature in range(table.shape[1] - 2, -1, -1):
        values = np.unique(table[:, feature])
        for cut in (values[1:] + values[:-1]) / 2:
            low = table[:, feature] <= cut
            impurity = sum(
                len(y) * y.mean() * (1 - y.mean()) for y in (labels[low], labels[~low])
            )
            if best is None or impurity < best[0] - 1e-12:
                best = impurity, feature, float(cut)
    if best is None:
        return (bool(share >= 0.5),)
    _, feature, cut = best
    low = table[:, feature] <= cut
    return feature, cut, grow(table[low], depth - 1), grow(table[~low], depth - 1)


@cache
def article_tree() -> tuple:
    return grow(LABELLED)


def decide(tree: tuple, row: tuple) -> bool:
    while len(tree) > 1:
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree[0]


# --- blocks


@dataclass(slots=True)
class Block:
    text: str
    words: int
    linked: int
    inside: bool
    named: bool
    wrapped: bool = False  # in an article inside a layout wrapper

    @property
    def density(self) -> float:
        return self.linked / self.words if self.words else 0.0


def _named(tag: str, attributes: str, inside: bool) -> int:
    """0: not named like chrome, 1: like a layout wrapper, 2: like chrome of its own."""
    if tag in AROUND or (tag == "header" and not inside):
        return 2
    if not attributes or tag in ("html", "body", "main"):
        return 0
    if HIDDEN.search(attributes):
        return 2
    level = 0
    for found in NAMES.findall(attributes):
        names = "".join(found).lower()
        # An article may be named for what stands beside it, so only whole names count there.
        found = NAMED.intersection(names.split() if tag == "article" else PART.findall(names))
        if found:
            level = max(level, 1 if found <= LAYOUT and tag in ("div", "section") else 2)
    return level


def blocks(page: str) -> list[Block]:
    out: list[Block] = []
    holders: list[tuple[str, bool, int, bool]] = []  # tag, inside the article, name, wrapped
    own = 0  # whether the element that started the block is named like chrome
    parts: list[tuple[str, bool]] = []
    link = False

    def close() -> None:
        nonlocal own
        if parts:
            text = " ".join("".join(t for t, _ in parts).split())
            if text:
                linked = sum(len(t.split()) for t, in_link in parts if in_link)
                words = len(text.split())
                inside, named, wrapped = holders[-1][1:] if holders else (False, 0, False)
                out.append(Block(text, words, min(linked, words), inside, bool(named or own), wrapped))
            parts.clear()
        own = 0

    at, end = 0, len(page)
    while at < end:
        start = page.find("<", at)
        if start < 0:
            start = end
        if start > at:
            parts.append((unescape(page[at:start]), link))
        if start == end:
            break
        m = MARKUP.match(page, start)
        if m is None:
            parts.append(("<", link))
            at = start + 1
            continue
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        ends, attributes = bool(m[1] or m[4]), m[3] or m[6] or ""
        if tag == "a":
            link = not ends
        elif tag == "br":
            parts.append((" ", link))
        elif tag in RAW:
            if not ends and not attributes.endswith("/"):
                stop = re.compile(rf"</{tag}(?:[\s/][^>]*)?>", re.IGNORECASE).search(page, at)
                at = stop.end() if stop else end
        elif tag in STARTS:
            close()
            own = 0 if ends else _named(tag, attributes, bool(holders) and holders[-1][1])
        elif tag in HOLDERS:
            close()
            link = False
            if ends:
                for i in range(len(holders) - 1, -1, -1):
                    if holders[i][0] == tag:
                        del holders[i:]
                        break
            elif not attributes.endswith("/"):
                inside, named, wrapped = holders[-1][1:] if holders else (False, 0, False)
                mine = _named(tag, attributes, inside)
                if tag in ARTICLE and not inside and named == 1 and not mine:
                    named, wrapped = 0, True
                holders.append((tag, inside or tag in ARTICLE, max(named, mine), wrapped))
    close()
    return out


def main_text(page: str | None) -> str:
    found = blocks(page or "")
    if any(b.inside and not b.named and not b.wrapped for b in found):
        for b in found:
            b.named = b.named or b.wrapped
    marked = any(b.inside and not b.named for b in found)
    tree, none = article_tree(), Block("", 0, 0, False, False)
    kept = []
    for i, b in enumerate(found):
        before = found[i - 1] if i else none
        after = found[i + 1] if i + 1 < len(found) else none
        place = 1.0 if b.inside else 0.0 if marked else 0.5
        row = (
            b.words, b.density, before.words, before.density, after.words, after.density,
            place, float(b.named),
        )
        if decide(tree, row):
            kept.append(b.text)
    return "\n".join(kept)


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(2)]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), sizes],
                names=["page_id", "url", "text", "n_chars"],
            )

    return pages.select(
        pages["page_id"].cast("long"), pages["url"].cast("string"), pages["html"].cast("string")
    ).mapInArrow(run, "page_id long, url string, text string, n_chars long")
