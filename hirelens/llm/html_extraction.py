"""Main text of web pages from flat text blocks.

A page is cut into blocks at block-level tags. Each block is described by its own word count and
link density and those of its neighbours, by the nearest element around it that says what it holds
(article or navigation), and by its form. A decision tree, trained on the labelled rows below, keeps
or drops it.

What a class name says holds for the element that bears it, unless that element is the page itself, an
article, or also named as content: the last word of a whole name tells ("article-comments" holds
comments), and a name that describes a state ("has-sidebar") tells nothing.

Defined results: null, empty or tagless html is treated like any other; a page without text gives
''. Unclosed tags end with what encloses them, a link too; an unclosed comment, script or style ends the
page, an unclosed button, select or drawing is only a tag. Time is linear in the page.
Repeated pages give equal results; nothing depends on other rows.
"""

from __future__ import annotations

import html as references
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names by what they mean.
RAW = {"script", "style", "title", "textarea", "noscript", "iframe", "xmp", "noembed", "noframes"}
#: Skipped as well, but may hold one another.
NESTED = {"svg", "math", "template", "object", "select", "button", "canvas", "audio", "video"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img", "input", "picture", "source", "link", "meta", "nobr"}
CONTENT = {"article", "main"}
#: No class name speaks against these.
ROOTS = {"html", "body", *CONTENT}
CHROME = {"nav", "aside", "footer", "form", "header", "menu", "dialog", "fieldset", "head"}
GROUPING = {"div", "section", "ul", "ol", "dl", "table", "tbody", "tr", "td", "blockquote", "figure", "body", "details", "li", "p"}
CHROME_WORD = re.compile(r"ads?|adv|advert\w*|sponsor\w*|promo\w*|banner|sidebar|side|menu|nav|navbar|navigation|footer|masthead|topbar|cookies?|consent|gdpr|notice|alert|popup|modal|overlay|comments?|commentlist|disqus|reply|replies|respond|related|recommend\w*|share|sharing|social|breadcrumbs?|newsletter|subscribe|signup|login|search|widgets?|pagination|pager|toolbar|copyright|legal|disclaimer|skip|toc", re.I)
#: Words that say how something is laid out, not what it is.
LAYOUT = re.compile(r"area|bar|block|bottom|box|buttons?|container|form|group|holder|icons?|inner|items?|left|links?|list|outer|panel|region|right|row|section|text|title|top|wrap|wrapper|\d+", re.I)
STATE = re.compile(r"has|with|without|no|not|is|show|hide|js|can|allow|enable|enabled|disable", re.I)
HINTS_FOR = re.compile(r"(?:^|[\s_-])(?:article|content|post|entry|story|main|body|text)(?:$|[\s_-]|body|text|content)", re.I)
VOID = {"br", "hr", "img", "input", "meta", "link", "wbr", "source", "area", "base", "col", "embed", "param", "track"}

_ATTRIBUTES = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_OPENED = re.compile(r"""=\s*(["'])""")
_NAME = re.compile(r"/?([a-zA-Z][a-zA-Z0-9:-]*)")


@dataclass
class Block:
    text: str
    words: int
    linked: int
    place: int  # -1 chrome, 0 unknown, 1 content
    heading: bool


def tag_end(page: str, low: int) -> int:
    """Where the tag at ``low`` ends: the first '>' outside of quoted values, or the first one if a quote stays open."""
    first = high = page.find(">", low)
    at = low
    while high >= 0 and (opened := _OPENED.search(page, at, high)):
        at = page.find(opened[1], opened.end()) + 1
        if not at:
            return first
        if at > high:
            high = page.find(">", at)
    return first if high < 0 else high


def closings(page: str, tag: str) -> dict[int, int]:
    """Where each element of this name ends that has an end, by where its tag ends; they may be nested."""
    ends, opened = {}, []
    for found in re.finditer(rf"<(/?){tag}\b[^>]*>", page, re.I):
        if not found[1]:
            if not found[0].endswith("/>"):
                opened.append(found.end())
        elif opened:
            ends[opened.pop()] = found.end()
    return ends


def tokens(page: str):
    """(text, '', '') for text and ('', name, tag source) for tags; a closing tag's source starts with '/'."""
    at, n = 0, len(page)
    known: dict[str, dict[int, int]] = {}
    while at < n:
        low = page.find("<", at)
        if low < 0:
            yield page[at:], "", ""
            return
        if low > at:
            yield page[at:low], "", ""
        if page.startswith("<!--", low):
            high = page.find("-->", low + 4)
            at = n if high < 0 else high + 3
            continue
        name = _NAME.match(page, low + 1)
        if not name and page[low + 1 : low + 2] not in ("!", "?", "/"):
            yield "<", "", ""
            at = low + 1
            continue
        high = tag_end(page, low)
        if high < 0:
            return
        at = high + 1
        if not name:
            continue
        source, tag = page[low + 1 : high], name[1].lower()
        yield "", tag, source
        if tag in RAW and source[0] != "/" and not source.endswith("/"):
            end = re.compile(f"</{tag}\\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else n
        elif tag in NESTED and source[0] != "/" and not source.endswith("/"):
            if tag not in known:
                known[tag] = closings(page, tag)
            at = known[tag].get(at, at)


def is_chrome(name: str) -> bool:
    """Whether a class name, id or role names something other than main text."""
    words = [w for w in re.split(r"[_-]+", name) if w]
    while len(words) > 1 and LAYOUT.fullmatch(words[-1]):
        words.pop()
    return bool(words) and bool(CHROME_WORD.fullmatch(words[-1])) and not STATE.fullmatch(words[0])


def place_of(tag: str, source: str, inside: int) -> int:
    """What an element says about the text in it, given what is said around it."""
    names = " ".join(m.strip("\"'") for m in _ATTRIBUTES.findall(source)).split()
    hints = " ".join(n for n in names if not is_chrome(n))
    if tag not in ROOTS and len(names) > 0 and any(map(is_chrome, names)) and not HINTS_FOR.search(hints):
        return -1
    if tag in CONTENT:
        return 1
    if tag in CHROME:
        return inside if tag == "header" and inside == 1 else -1
    if inside == 0 and hints and HINTS_FOR.search(hints):
        return 1
    return inside


def blocks(page: str) -> list[Block]:
    found: list[Block] = []
    stack: list[tuple[str, int]] = []
    parts: list[str] = []
    linked: list[str] = []
    place, in_link, heading = 0, False, False
    link_depth = 0  # elements around the link; it ends with the innermost of them
    open_names: Counter[str] = Counter()

    def push(tag: str) -> None:
        stack.append((tag, place))
        open_names[tag] += 1

    def pop() -> tuple[str, int]:
        name, before = stack.pop()
        open_names[name] -= 1
        return name, before

    def flush():
        text = " ".join(references.unescape("".join(parts)).split())
        if text:
            found.append(Block(text, len(text.split()), len(references.unescape(" ".join(linked)).split()), place, heading))
        parts.clear()
        linked.clear()

    for text, tag, source in tokens(page):
        if not tag:
            parts.append(text)
            if in_link:
                linked.append(text)
            continue
        closing = source[0] == "/"
        if tag == "a":
            in_link, link_depth = not closing, len(stack)
        if tag in INLINE:
            if not closing and tag not in VOID and _ATTRIBUTES.search(source) and place_of(tag, source, place) != place:
                flush()
                push(tag)
                place = place_of(tag, source, place)
                link_depth += tag == "a"
            elif closing and stack and stack[-1][0] == tag:
                flush()
                place = pop()[1]
            continue
        flush()
        if tag[0] == "h" and tag[1:] in "123456" and tag != "h":
            heading = not closing
        elif tag in VOID:
            continue
        elif not closing:
            heading = False
            if tag in ("p", "li") and stack and stack[-1][0] == tag:
                place = pop()[1]
                in_link = in_link and len(stack) >= link_depth
            if not source.endswith("/"):
                push(tag)
                place = place_of(tag, source, place)
        elif open_names[tag]:
            while True:
                name, place = pop()
                if name == tag:
                    break
            in_link = in_link and len(stack) >= link_depth
    flush()
    return found


FEATURES = ("words", "link_density", "words_before", "density_before", "words_after", "density_after", "place", "heading", "sentence")


def features(found: list[Block]) -> np.ndarray:
    words = np.array([0, *(b.words for b in found), 0], float)
    density = np.array([0, *(min(1.0, b.linked / b.words) for b in found), 0])
    own = [[b.place, b.heading, b.text[-1] in ".!?…。\"'”»)"] for b in found]
    return np.column_stack([words[1:-1], density[1:-1], words[:-2], density[:-2], words[2:], density[2:], np.array(own, float).reshape(-1, 3)])


#: The labelled table: features in the order of FEATURES, then whether the block is main text.
LABELLED = [
    # inside an article
    (6, 0, 0, 0, 30, 0, 1, 1, 0, 1), (12, 0, 3, 1, 8, 0, 1, 1, 1, 1), (3, 0, 40, 0, 60, 0, 1, 1, 0, 1), (80, 0, 12, 0, 45, 0, 1, 0, 1, 1), (45, 0.1, 80, 0, 5, 0, 1, 0, 1, 1),
    (5, 0, 45, 0.1, 90, 0, 1, 0, 1, 1), (1, 0, 20, 0, 70, 0, 1, 0, 1, 1), (2, 0, 1, 0, 3, 0, 1, 0, 1, 1), (9, 0, 70, 0, 8, 0, 1, 0, 1, 1), (150, 0.02, 9, 0, 12, 0.2, 1, 0, 1, 1),
    (4, 0, 30, 0, 25, 0, 1, 0, 0, 1), (25, 0, 4, 0, 0, 0, 1, 0, 0, 1), (30, 0.3, 60, 0, 40, 0, 1, 0, 1, 1), (14, 0.4, 50, 0, 30, 0, 1, 0, 1, 1), (8, 0, 6, 1, 7, 1, 1, 0, 1, 1),
    (3, 1, 3, 1, 3, 1, 1, 0, 0, 0), (4, 1, 40, 0, 3, 1, 1, 0, 0, 0), (6, 0.9, 3, 1, 12, 0, 1, 0, 0, 0), (2, 1, 50, 0, 2, 1, 1, 0, 0, 0), (10, 0.95, 20, 0, 9, 1, 1, 0, 0, 0),
    (8, 0, 0, 0, 6, 0, 1, 1, 0, 1), (3, 0, 10, 0, 4, 0, 1, 0, 0, 1), (12, 0, 3, 1, 12, 0, 1, 1, 0, 1), (2, 0, 2, 0, 1, 0, 1, 0, 0, 1), (10, 0, 30, 0, 0, 0, 1, 0, 0, 1), (7, 0, 5, 1, 3, 1, 1, 0, 0, 1),
    (1, 0, 8, 0, 9, 0, 1, 0, 0, 1), (17, 0.2, 12, 0, 15, 0.1, 1, 0, 0, 1),
    # inside navigation, adverts, notices, comments and the like
    (1, 1, 0, 0, 1, 1, -1, 0, 0, 0), (2, 1, 1, 1, 2, 1, -1, 0, 0, 0), (12, 0, 2, 1, 8, 0, -1, 0, 1, 0), (9, 0, 1, 1, 60, 0, -1, 0, 1, 0), (40, 0, 50, 0, 30, 0, -1, 0, 1, 0),
    (70, 0.1, 80, 0, 10, 0.5, -1, 0, 1, 0), (5, 0, 90, 0, 0, 0, -1, 0, 0, 0), (3, 0, 30, 0, 45, 0, -1, 1, 0, 0), (120, 0, 70, 0, 0, 0, -1, 0, 1, 0), (18, 0.2, 60, 0, 2, 1, -1, 0, 1, 0),
    # nothing is said around it
    (1, 1, 0, 0, 1, 1, 0, 0, 0, 0), (3, 1, 2, 1, 4, 1, 0, 0, 0, 0), (4, 0.8, 3, 1, 60, 0, 0, 0, 0, 0), (6, 0, 2, 1, 3, 1, 0, 0, 0, 0), (5, 0, 80, 0, 2, 1, 0, 0, 0, 0),
    (3, 0, 0, 0, 2, 1, 0, 0, 0, 0), (7, 0.5, 90, 0, 0, 0, 0, 0, 0, 0), (4, 0, 4, 0, 3, 0, 0, 0, 0, 0), (12, 0.7, 40, 0, 9, 1, 0, 0, 0, 0), (25, 0.8, 10, 1, 12, 1, 0, 0, 0, 0),
    (60, 0, 6, 0, 45, 0, 0, 0, 1, 1), (35, 0.1, 60, 0, 50, 0, 0, 0, 1, 1), (90, 0.05, 3, 1, 20, 0, 0, 0, 1, 1), (18, 0, 70, 0, 55, 0, 0, 0, 1, 1), (22, 0, 9, 0, 2, 1, 0, 0, 1, 1),
    (8, 0, 60, 0, 70, 0, 0, 0, 1, 1), (5, 0, 45, 0, 38, 0, 0, 0, 1, 1), (7, 0, 2, 1, 60, 0, 0, 1, 0, 1), (4, 0, 50, 0, 75, 0, 0, 1, 0, 1), (16, 0.25, 40, 0, 35, 0, 0, 0, 1, 1),
    (3, 0, 3, 1, 2, 1, 0, 1, 0, 0), (5, 0, 4, 0, 4, 1, 0, 1, 0, 0), (40, 0, 45, 0, 1, 0, 0, 0, 1, 1), (30, 0, 60, 0, 3, 1, 0, 0, 1, 1), (19, 0.1, 33, 0, 2, 1, 0, 0, 1, 1),
    # ... and the neighbours tell: as much text on either side, of links or of sentences
    (6, 0, 60, 1, 50, 1, 0, 0, 1, 0), (8, 0, 45, 0.9, 70, 1, 0, 0, 1, 0), (5, 0, 70, 1, 38, 0.95, 0, 0, 1, 0), (7, 0, 40, 1, 60, 0.9, 0, 1, 0, 0), (4, 0, 55, 0.95, 75, 1, 0, 1, 0, 0),
    (18, 0, 70, 1, 55, 1, 0, 0, 1, 0), (22, 0.1, 40, 0.9, 45, 1, 0, 0, 1, 0), (14, 0.2, 35, 1, 30, 0.9, 0, 0, 1, 0), (25, 0, 60, 1, 52, 1, 0, 0, 1, 0), (16, 0.1, 50, 0.95, 42, 0.9, 0, 0, 1, 0),
    (6, 0, 60, 0, 50, 0, 0, 0, 1, 1), (7, 0, 40, 0.1, 60, 0, 0, 1, 0, 1), (18, 0, 40, 0.1, 45, 0, 0, 0, 1, 1), (14, 0.1, 35, 0, 30, 0.1, 0, 0, 1, 1), (25, 0, 60, 0.05, 52, 0, 0, 0, 1, 1),
    # the last paragraph of a page
    (17, 0, 19, 0, 0, 0, 0, 0, 1, 1), (16, 0, 30, 0, 0, 0, 0, 0, 1, 1), (20, 0.05, 18, 0, 0, 0, 0, 0, 1, 1), (14, 0, 25, 0, 0, 0, 0, 0, 1, 1), (28, 0, 40, 0.1, 0, 0, 0, 0, 1, 1),
    (55, 0, 0, 0, 1, 1, 0, 0, 1, 1), (24, 0, 25, 0, 4, 0, 0, 0, 1, 1), (1, 0, 40, 0, 2, 1, 0, 0, 0, 0), (3, 0, 52, 0, 0, 0, 0, 0, 0, 0), (4, 1, 1, 0, 0, 0, 0, 0, 0, 0),
]


def grow(rows: np.ndarray, labels: np.ndarray, depth: int = 6):
    """A classification tree by Gini impurity: (feature, threshold, low side, high side) or a label."""
    if depth == 0 or len(set(labels)) < 2:
        return bool(labels.mean() > 0.5)
    best = None
    for feature in range(rows.shape[1]):
        levels = np.unique(rows[:, feature])
        for threshold in (levels[1:] + levels[:-1]) / 2:
            low = rows[:, feature] <= threshold
            impurity = sum(len(y) * y.mean() * (1 - y.mean()) for y in (labels[low], labels[~low]))
            if best is None or impurity < best[0] - 1e-12:
                best = impurity, feature, threshold, low
    if best is None:
        return bool(labels.mean() > 0.5)
    _, feature, threshold, low = best
    return feature, threshold, grow(rows[low], labels[low], depth - 1), grow(rows[~low], labels[~low], depth - 1)


def trained(labelled=LABELLED):
    table = np.array(labelled, float)
    return grow(table[:, :-1], table[:, -1])


def decide(tree, row: np.ndarray) -> bool:
    while not isinstance(tree, bool):
        feature, threshold, low, high = tree
        tree = low if row[feature] <= threshold else high
    return tree


def main_text(page: str | None, tree) -> str:
    found = blocks(page or "")
    return " ".join(b.text for b, row in zip(found, features(found), strict=True) if decide(tree, row)) if found else ""


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of pages."""
    tree = trained()

    def run(batches):
        for batch in batches:
            texts = [main_text(page, tree) for page in batch["html"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["page_id"], batch["url"], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
