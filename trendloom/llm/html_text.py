"""Main text of web pages by the distribution of text over line blocks.

Markup is stripped page by page with the standard library's tokenizer: every block element ends a line, and the
contents of elements that are never article text (scripts, styles, menus, headers, footers, sidebars, forms,
adverts, notices, reader comments, hidden parts) are dropped and leave ``WINDOW`` empty lines behind. Each line
counts its characters, or none when most of them are link text. Sums over sliding windows of ``WINDOW`` lines
give the distribution: a window sum of zero is a dive point that ends a block, and a block whose largest window
sum reaches ``SURGE`` holds a surge point, so its lines from the first to the last non-empty one are kept. A page
without any surge keeps its densest block. Character references are decoded, white space inside a line becomes
one space, and kept lines are joined by one line feed in page order.

Pages are independent: each is handled inside one task; pages are dealt round-robin over all tasks first (one
shuffle of the input), so that a file of a single row group does not become a single task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendloom.llm.shared import cores

#: Lines per window, and the window sum (characters) that marks a surge.
WINDOW, SURGE = 3, 80
#: A line counts as empty when more than this share of its characters is link text.
LINK_SHARE = 0.5

# Elements whose content is never main text, and the class, id or role words of such containers.
SKIPPED_TAGS = {
    "script", "style", "noscript", "template", "head", "title", "nav", "header", "footer", "aside", "form", "iframe",
    "svg", "math", "button", "select", "textarea", "object", "embed", "canvas", "menu", "dialog", "label", "option",
}
BOILERPLATE_WORDS = {
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo",
    "banner", "cookie", "cookies", "consent", "notice", "notices", "alert", "newsletter", "subscribe", "signup",
    "comment", "comments", "reply", "replies", "disqus", "sidebar", "menu", "nav", "navbar", "navigation",
    "footer", "header", "masthead", "breadcrumb", "breadcrumbs", "share", "sharing", "social", "related",
    "popup", "modal", "widget", "toolbar", "login", "pagination", "complementary", "contentinfo", "search",
}
BLOCK_TAGS = {
    "p", "div", "h1", "h2", "h3", "h4", "h5", "h6", "li", "ul", "ol", "dl", "dt", "dd", "table", "tr", "td", "th",
    "article", "section", "main", "blockquote", "pre", "figure", "figcaption", "br", "hr", "address", "center",
    "details", "summary", "caption", "body", "html", "tbody", "thead", "tfoot",
}
VOID_TAGS = {"br", "hr", "img", "meta", "link", "input", "area", "base", "col", "embed", "source", "track", "wbr", "param"}

_SPACE = re.compile(r"\s+")
_WORDS = re.compile(r"[a-z0-9]+")


def _boilerplate(tag: str, attrs: list[tuple[str, str | None]]) -> bool:
    if tag in SKIPPED_TAGS:
        return True
    named = dict(attrs)
    if "hidden" in named or (named.get("aria-hidden") or "").lower() == "true":
        return True
    if re.search(r"display\s*:\s*none", (named.get("style") or "").lower()):
        return True
    words = " ".join(named.get(a) or "" for a in ("class", "id", "role")).lower().replace("_", " ")
    return bool(BOILERPLATE_WORDS.intersection(_WORDS.findall(words)))


class _Lines(HTMLParser):
    """Lines of text with the characters inside links; dropped elements leave empty lines."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int]] = []
        self.parts: list[str] = []
        self.linked = 0
        self.anchors = 0
        self.skip: list[str] = []  # open tags of the dropped element, innermost last

    def flush(self):
        text = _SPACE.sub(" ", "".join(self.parts)).strip()
        if text:
            self.lines.append((text, self.linked))
        self.parts, self.linked = [], 0

    def gap(self):
        self.flush()
        self.lines.extend([("", 0)] * WINDOW)

    def handle_starttag(self, tag, attrs):
        if self.skip:
            if tag not in VOID_TAGS:
                self.skip.append(tag)
            return
        if tag not in VOID_TAGS and _boilerplate(tag, attrs):
            self.gap()
            self.skip.append(tag)
            return
        if tag in BLOCK_TAGS:
            self.flush()
            self.anchors = 0  # a link does not run on into the next block
        elif tag == "a":
            self.anchors += 1

    def handle_startendtag(self, tag, attrs):
        if not self.skip and tag in BLOCK_TAGS:
            self.flush()

    def handle_endtag(self, tag):
        if self.skip:
            if tag in self.skip:  # close up to the matching open tag; unclosed inner tags end with it
                while self.skip and self.skip.pop() != tag:
                    pass
                if not self.skip:
                    self.gap()
            return
        if tag in BLOCK_TAGS:
            self.flush()
        elif tag == "a" and self.anchors:
            self.anchors -= 1

    def handle_data(self, data):
        if not self.skip:
            self.parts.append(data)
            if self.anchors:
                self.linked += len(data)


def page_lines(html: str | None) -> list[tuple[str, int]]:
    """Lines of a page after markup is stripped: (text, characters inside links); empty lines where content was dropped."""
    parser = _Lines()
    parser.feed(html or "")
    parser.close()
    parser.flush()
    return parser.lines


def main_text(html: str | None, window: int = WINDOW, surge: int = SURGE) -> str:
    """The main text of one page: lines of the blocks that hold a surge point, joined by line feeds."""
    lines = page_lines(html)
    if not lines:
        return ""
    sizes = np.array([0 if linked > LINK_SHARE * len(text) else len(text) for text, linked in lines], dtype=np.int64)
    sums = np.convolve(sizes, np.ones(window, dtype=np.int64))[window - 1 :]  # sum of lines i .. i+window-1
    full = np.flatnonzero(sizes > 0)
    if not full.size:
        return ""
    # a dive point: window lines without text between two lines with text; a block runs between dive points
    block = np.cumsum(np.concatenate([[True], np.diff(full) - 1 >= window]))
    peaks = np.zeros(block[-1] + 1, dtype=np.int64)
    np.maximum.at(peaks, block, sums[full])
    chosen = np.flatnonzero(peaks >= surge)
    if not chosen.size:
        chosen = np.array([int(np.argmax(peaks))])
    keep = np.zeros(len(lines), dtype=bool)
    keep[full[np.isin(block, chosen)]] = True
    return "\n".join(text for (text, _), k in zip(lines, keep.tolist()) if k)


def extract_main_text(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url"),
                      window: int = WINDOW, surge: int = SURGE) -> DataFrame:
    """Main text of every page.

    Returns the columns ``keep`` as they are, ``text`` (empty for null, empty or markup-only html) and ``n_chars``
    (its code points), one row per input row, repeated rows included. Other columns are not carried, so names that
    clash with these do no harm. Html of any length is read whole; broken markup (unclosed tags, stray end tags)
    is read as browsers' tokenizers do, without failing.
    """
    rows = pages.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(html).cast("string").alias("h"))
    # parsing is the heavy part: deal the pages evenly over all tasks, whatever the files' row groups are
    rows = rows.repartition(max(int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")), cores(pages)))
    fields = ", ".join(f"k{i} {pages.schema[c].dataType.simpleString()}" for i, c in enumerate(keep))
    schema = f"{fields}, text string" if fields else "text string"

    def per_batch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = batch.drop(columns=["h"])
            out["text"] = [main_text(h, window, surge) for h in batch["h"].tolist()]
            yield out

    found = rows.mapInPandas(per_batch, schema)
    return found.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "text",
                        F.length("text").cast("long").alias("n_chars"))
