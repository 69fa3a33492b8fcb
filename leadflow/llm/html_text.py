"""Main text of web pages by the distribution of line blocks.

1. Strip markup: a page becomes lines, one per block element.  Scripts, styles, comments and the like are cut out; lines in
   menus, headers, footers, sidebars, notices, adverts, forms and reader comments (by element, role, class or id) have
   no length.  Where a page names its content (article, main), lines outside have no length either.
2. The length of a line block is the sum of the text lengths of ``WINDOW`` lines from a line on.
3. A surge point is where it rises from nothing; the dive point after it is where it falls back to nothing.  The text
   between is kept if some block in it has ``ISLAND`` characters, or a fifth (``SURGE``) of the page's longest on pages of
   short lines: on a page that does not name its content, smaller islands between menus are not the article.  However
   long the longest block is, it asks no more than that of the others.  In a named content all that has a length is
   kept, so there the elements, classes and ids decide, and the blocks do not.

Lines of links alone count as empty outside a named content.  A null or empty page has an empty text.  Pages cut off in the
middle of a tag, unclosed and wrongly nested elements are read as far as they go.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3
SURGE = 0.2
ISLAND = 86  # characters in a block, about one sentence

# fixed values: elements of the HTML standard
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre
    section summary table tbody tfoot thead title tr ul""".split())
CUT = ("script", "style", "noscript", "template", "svg", "math", "iframe", "object", "canvas", "audio", "video",
       "textarea", "select", "button")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ASIDE = frozenset("nav footer aside form menu dialog head".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form".split())
# words in a class or id that name something beside the article
ASIDE_WORDS = frozenset("""ad ads adv advert adverts advertisement advertising adslot adbox banner breadcrumb breadcrumbs comment
    comments consent cookie cookies copyright disclaimer disqus footer gdpr login masthead menu modal nav navbar navigation
    newsletter notice notices notification overlay pager pagination popup promo promoted promotion recommended recommendations
    related reply replies respond search share sharing sidebar sidenav signup skip social sponsor sponsored subscribe subscription
    toolbar topbar widget""".split())
HEADER_WORDS = frozenset(("header", "head"))

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    rf"|<({'|'.join(CUT)})\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*+(?:/>|>.*?(?:</\1\s*[^>]*(?:>|\Z)|\Z)|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<[a-zA-Z/!?][^>]*(?:>|\Z)|<\Z", re.S | re.I)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_PIECES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def _named_aside(tag: str, attributes: str, inside: bool) -> bool:
    """Whether an element is something beside the article."""
    if tag in ASIDE or (tag == "header" and not inside):
        return True
    if not attributes or tag in ("html", "body", "main"):
        return False
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), (a or b or c)
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True
        if name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return True
        if name == "role" and value.lower() in ASIDE_ROLES:
            return True
        if name in ("class", "id"):
            words = {w.lower() for w in _PIECES.findall(value)}
            if words & ASIDE_WORDS or (not inside and words & HEADER_WORDS):
                return True
    return False


def lines_of(page: str) -> list[tuple[str, bool, bool, bool]]:
    """Lines of a page: text, beside the article or not, in named content or not, links alone or not."""
    lines: list[tuple[str, bool, bool, bool]] = []
    piece: list[str] = []
    linked = plain = 0
    beside, beside_depth, content, link = "", 0, 0, 0

    def close() -> None:
        nonlocal linked, plain
        if piece:
            text = " ".join(html.unescape("".join(piece)).split())
            if text:
                lines.append((text, bool(beside), content > 0, linked > 0 and not plain))
            piece.clear()
        linked = plain = 0

    def text(part: str) -> None:
        nonlocal linked, plain
        if part:
            piece.append(part)
            if part.strip():
                if link:
                    linked += 1
                else:
                    plain += 1

    at = 0
    for m in _TOKEN.finditer(page):
        text(page[at:m.start()])
        at = m.end()
        tag = (m[3] or "").lower()
        if not tag:
            if m[1]:
                piece.append(" ")
            continue
        ending = m[2] == "/"
        if tag in BLOCKS:
            close()
        elif tag in ("br", "td", "th", "img", "input"):
            piece.append(" ")
        if tag == "a":
            link = 0 if ending else 1
        if tag in ("article", "main"):
            if beside and (ending or beside not in ("article", "main")) and not (ending and beside == tag):
                beside, beside_depth = "", 0  # an element left open does not outlive the content's own bounds
        if tag == "body" and beside == "head":
            beside, beside_depth = "", 0
        if beside:
            if tag == beside and not m[4].rstrip().endswith("/"):
                beside_depth += -1 if ending else 1
                if not beside_depth:
                    beside = ""
            continue
        if tag in ("article", "main"):
            if ending:
                content = max(0, content - 1)
            elif _named_aside(tag, m[4], content > 0):
                beside, beside_depth = tag, 1
            else:
                content += 1
        elif not ending and tag not in VOID and not m[4].rstrip().endswith("/") and _named_aside(tag, m[4], content > 0):
            close()
            beside, beside_depth = tag, 1
    text(page[at:])
    close()
    return lines


def main_text(page: str | None) -> str:
    lines = lines_of(page or "")
    named = any(inside and not beside for _, beside, inside, _ in lines)
    if named:  # what lies beside the content inside its bounds is no gap in it
        lines = [x for x in lines if not (x[1] and x[2])]
    lengths = np.array([
        0 if beside or (named and not inside) or (not named and only_links) else len(text)
        for text, beside, inside, only_links in lines], np.int64)
    if not lengths.any():
        return ""
    sums = np.concatenate([[0], np.cumsum(np.pad(lengths, (0, WINDOW)))])
    blocks = sums[WINDOW:WINDOW + len(lengths)] - sums[:len(lengths)]
    enough = 0 if named else min(ISLAND, SURGE * blocks.max())
    kept, at = [], 0
    while at < len(lengths):
        if not lengths[at]:
            at += 1
            continue
        dive = at
        while dive < len(lengths) and blocks[dive]:
            dive += 1
        if blocks[at:dive].max() >= enough:
            kept += [lines[i][0] for i in range(at, dive) if lengths[i]]
        at = dive
    return "\n".join(kept)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(x.as_py()) for x in batch.column("html")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract_main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(_extract, "page_id bigint, url string, text string, n_chars bigint")
