"""Main text of HTML pages.

The page is cut into flat text blocks. Each block is described by its number of
words and share of words in links, the same of its two neighbours, and whether
it lies inside an article or inside page furniture. A decision tree trained on the
small table below decides which blocks are main text.

Defined results: a null or empty page has an empty text; markup that is not
closed or cut off is read as far as it goes; script, style, title and textarea without
an end tag run to the end of the page, other hidden elements end with their parent, or at once if
written as self-closing; repeated rows give equal rows; existing columns
named like the results are replaced.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tuneweave.llm.common import with_result

# Names of HTML elements.
HIDDEN = frozenset("script style noscript template title textarea select option svg math iframe object canvas audio video".split())
# Hidden elements whose content is no markup; those of RUNS_ON end with the page if they are not closed.
RAW = frozenset("script style title textarea iframe".split())
RUNS_ON = RAW - {"iframe"}
# Hidden elements that take the place of a phrase and end with the paragraph around them.
PHRASES = frozenset("audio video canvas noscript".split())
# Elements that end an open paragraph.
ENDS_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav "
    "ol p pre section table ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup "
    "time tt u var wbr".split()
)
FURNITURE = frozenset("nav header footer aside form menu dialog button fieldset".split())
MAIN = frozenset("article main".split())
# Whole classes, ids and roles that mark page furniture.
MARKS = frozenset(
    "ad ads adbox adsense advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies disclaimer "
    "disqus footer header login masthead menu modal nav navbar navigation newsletter notice notification pagination "
    "popup promo related respond search share sharing sidebar signup social sponsor sponsored subscribe toolbar widget "
    "ad-banner ad-box ad-container ad-slot ad-unit ad-wrapper comment-form comment-list comments-area comments-section cookie-banner "
    "cookie-bar cookie-consent cookie-notice footer-widgets main-menu main-nav main-navigation nav-bar newsletter-signup page-footer "
    "page-header post-navigation promo-box related-articles related-posts search-form share-buttons sharing-buttons sidebar-widget "
    "site-footer site-header site-nav site-navigation social-links social-media social-share top-nav widget-area".split()
)
# Marks of places that hold articles of their own, which are not the page's.
SIDE = frozenset("comment comments comment-list comments-area comments-section disqus related related-articles related-posts respond".split())

_token = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)"
    r"|<(?P<late_end>/?)(?P<late>[A-Za-z][^\s/>]*)(?P<late_attrs>[^>]*)(?:>|\Z)",
    re.S,
)
_marks = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_hidden = re.compile(r"""\bhidden\b(?!\s*=\s*["']?false)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)


@dataclass
class Block:
    text: str
    words: int
    linked: int
    main: bool
    furniture: bool


@dataclass(eq=False)
class Mark:
    """That an open element is furniture by its class, id or role, or a form; `off` once it is known to hold the main text."""

    side: bool
    off: bool = False


def mark_of(attrs: str) -> Mark | None:
    """The mark by a class, id or role that is in MARKS."""
    if "=" not in attrs:
        return None
    tokens = {t for groups in _marks.findall(attrs) for t in "".join(groups).lower().split()}
    return Mark(not SIDE.isdisjoint(tokens)) if not MARKS.isdisjoint(tokens) else None


def not_shown(attrs: str) -> bool:
    """Whether the element is hidden."""
    if not attrs or "=" not in attrs and "hidden" not in attrs:
        return False
    return bool(_hidden.search(re.sub(r"""=\s*("[^"]*"|'[^']*')""", lambda m: m[0] if "none" in m[0] or "true" in m[0] else "=", attrs)))


def blocks(page: str) -> list[Block]:
    """Flat text blocks in page order.

    Marks of article, main and what is around them do not count. An article in a place of SIDE, as
    comments are, leaves the mark of that place and its own unless it is the longest of the page.
    """
    found: list[Block] = []
    marks_of: list[tuple[Mark, ...]] = []  # of each block
    marks: list[tuple[int, Mark]] = []  # of open elements, with their places in open_
    articles: list[list] = []  # words and marks of each article
    inside: list[tuple[int, list]] = []  # open articles, with their places in open_
    parts: list[str] = []
    linked = 0
    open_: list[tuple[str, bool, bool]] = []  # name, main, furniture
    main = furniture = link = 0
    hide = -1  # place in open_ of the outermost hidden element

    def close() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                words = text.count(" ") + 1
                found.append(Block(text, words, min(words, linked), main > 0, furniture > 0))
                marks_of.append(tuple(m for _, m in marks))
                for _, article in inside:
                    article[0] += words
            parts.clear()
        linked = 0

    def pop(depth: int) -> None:
        nonlocal main, furniture, link, hide
        while len(open_) > depth:
            n, a, b = open_.pop()
            main, furniture, link = main - a, furniture - b, link - (n == "a")
        while marks and marks[-1][0] >= depth:
            marks.pop()
        while inside and inside[-1][0] >= depth:
            inside.pop()
        if hide >= depth:
            hide = -1

    def say(raw: str) -> None:
        nonlocal linked
        if raw and hide < 0:
            text = html.unescape(raw) if "&" in raw else raw
            parts.append(text)
            if link:
                linked += len(text.split())

    at, end = 0, len(page)
    while at < end:
        m = _token.search(page, at)
        if m is None:
            say(page[at:])
            break
        say(page[at : m.start()])
        at = m.end()
        if m["cdata"] is not None:
            say(m["cdata"])
            continue
        name, ends, attrs = (m["name"], m["end"], m["attrs"]) if m["name"] else (m["late"], m["late_end"], m["late_attrs"])
        if not name:
            continue
        name = name.lower()
        if ends:
            for depth in range(len(open_) - 1, -1, -1):
                if open_[depth][0] == name:
                    break
            else:
                if name == "p" and hide < 0:
                    close()
                continue
            if any(n not in INLINE for n, _, _ in (open_[depth:hide] if hide >= 0 else open_[depth:])):
                close()
            pop(depth)
            continue
        if name in RAW:
            over = re.compile(rf"</{name}\s*(?:>|\Z)", re.I).search(page, at)
            at = over.end() if over else (end if name in RUNS_ON else at)
            if hide < 0:
                close()
            continue
        if hide >= 0 and name == "body":
            pop(hide)
        if hide >= 0 and name in ENDS_P:
            for depth in range(len(open_) - 1, -1, -1):
                n = open_[depth][0]
                if n == "p":
                    if depth < hide:
                        close()
                    pop(depth)
                    break
                if n not in INLINE and n not in PHRASES:
                    break
        if hide < 0 and name in HIDDEN:
            if name not in {"svg", "math"}:
                close()
            if not attrs.rstrip().endswith("/"):
                if name == "option" and open_ and open_[-1][0] == "option":
                    pop(len(open_) - 1)
                hide = len(open_)
                open_.append((name, False, False))
            continue
        if hide < 0 and (name not in INLINE or name == "img"):
            if name == "br" or name not in INLINE:
                close() if name != "br" else parts.append(" ")
        if name in VOID:
            continue
        if name in {"p", "li", "dt", "dd", "option", "tr", "td", "th"}:
            # Such an element ends at the next of its kind, unless a list or table has been opened inside it.
            for depth in range(len(open_) - 1, -1, -1):
                n = open_[depth][0]
                if n == name:
                    if depth < hide:
                        close()
                    pop(depth)
                    break
                if n not in INLINE and n not in PHRASES:
                    break
        if attrs.endswith("/") and (hide >= 0 or name not in FURNITURE | MAIN and name not in INLINE):
            continue
        a, shown = name in MAIN, name in {"body", "html"}
        b = name in FURNITURE and name != "form" or not shown and not_shown(attrs)
        mark = None if shown else mark_of(attrs)
        if name == "form":
            mark = Mark(mark is not None and mark.side)
        if mark:
            marks.append((len(open_), mark))
        if a and hide < 0:
            for _, m in marks:
                m.off = m.off or name == "main" or not m.side
            if name == "article":
                articles.append([0, [m for _, m in marks]])
                inside.append((len(open_), articles[-1]))
        open_.append((name, a, b))
        main, furniture, link = main + a, furniture + b, link + (name == "a")
    close()
    for m in max(articles, key=lambda x: x[0], default=(0, ()))[1]:
        m.off = True
    for block, own in zip(found, marks_of):
        block.furniture = block.furniture or not all(m.off for m in own)
    return found


FEATURES = ["words", "density", "words_before", "density_before", "words_after", "density_after", "in_main", "in_furniture"]
# Labelled blocks: the features in the order above, then 1 for main text.
TABLE = """
1 0 0 0 40 0 1 0 1
2 0 0 0 3 0 1 0 1
8 0 0 0 25 0 1 0 1
12 0 6 1 60 0 1 0 1
60 0 12 0 45 0 1 0 1
45 0 60 0 3 0 1 0 1
3 0 45 0 70 0 1 0 1
70 0.1 3 0 30 0 1 0 1
30 0.6 70 0 20 0 1 0 1
5 1 20 0 40 0 1 0 1
2 1 40 0 9 0 1 0 1
150 0 2 0 1 0 1 0 1
1 0 150 0 6 0.1 1 0 1
1 0 1 0 1 0 1 0 1
25 0 1 1 1 1 1 0 1
400 0.02 25 0 200 0 1 0 1
1 1 1 1 1 1 0 1 0
2 1 1 1 2 1 1 1 0
6 1 0 0 1 1 0 1 0
9 0 6 1 12 0 0 1 0
14 0 1 1 8 0 1 1 0
40 0 12 0 60 0 0 1 0
80 0 40 0 35 0 1 1 0
35 0.2 80 0 3 0 0 1 0
120 0 35 0 0 0 1 1 0
7 0.1 150 0 0 0 0 1 0
3 0 7 0 0 0 0 1 0
22 0 9 1 22 0 1 1 0
240 0 180 0 210 0 1 1 1
60 0 1 1 60 0 0 0 1
1 0 30 0 0 0 0 1 0
60 0.7 4 1 5 1 0 1 0
35 0 10 0 50 0 0 0 1
50 0 35 0 28 0 0 0 1
28 0.1 50 0 40 0 0 0 1
90 0.05 28 0 2 0 0 0 1
18 0 40 0 60 0 0 0 1
24 0.1 55 0 0 0 0 0 1
16 0 22 0.1 19 0 0 0 1
7 0 80 0 65 0 0 0 1
4 0 50 0 45 0 0 0 1
6 0 0 0 48 0 0 0 1
9 0 30 0 33 0 0 0 1
1 1 1 1 1 1 0 0 0
2 1 0 0 1 1 0 0 0
3 1 2 1 4 1 0 0 0
1 1 0 0 35 0 0 0 0
4 1 3 1 80 0 0 0 0
2 1 12 0 20 0 0 0 0
6 0.9 40 0 25 0 0 0 0
10 0.6 0 0 60 0 0 0 0
15 0.8 60 0 15 0.8 0 0 0
5 0.8 3 1 6 1 0 0 0
20 0.9 2 1 3 1 0 0 0
40 0.8 20 0.9 2 1 0 0 0
3 0 2 1 2 1 0 0 0
4 0 0 0 2 1 0 0 0
5 0 3 1 4 0 0 0 0
8 0 4 0 3 0 0 0 0
6 0.5 9 0 3 0 0 0 0
2 0 5 0 0 0 0 0 0
7 0 2 0 0 0 0 0 0
"""


@dataclass
class Node:
    label: bool
    feature: int = -1
    at: float = 0.0
    low: Node | None = None
    high: Node | None = None


def grow(x: np.ndarray, y: np.ndarray, depth: int = 6) -> Node:
    """Decision tree by Gini impurity; among equal cuts the first feature and smallest value win."""
    node = Node(bool(2 * y.sum() >= len(y)))
    if depth == 0 or y.all() or not y.any():
        return node
    best = None
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for cut in (values[:-1] + values[1:]) / 2:
            low = x[:, f] <= cut
            cost = sum(len(p) * p.mean() * (1 - p.mean()) for p in (y[low], y[~low]))
            if best is None or cost < best[0] - 1e-12:
                best = (cost, f, float(cut), low)
    if best is None:
        return node
    _, node.feature, node.at, low = best
    node.low, node.high = grow(x[low], y[low], depth - 1), grow(x[~low], y[~low], depth - 1)
    return node


@lru_cache(maxsize=1)
def trained() -> Node:
    rows = np.array([[float(v) for v in line.split()] for line in TABLE.strip().splitlines()])
    return grow(rows[:, :-1], rows[:, -1].astype(bool))


def chosen(tree: Node, row: list[float]) -> bool:
    while tree.low is not None:
        tree = tree.low if row[tree.feature] <= tree.at else tree.high
    return tree.label


def main_text(page: str | None) -> str:
    if not page:
        return ""
    found, tree = blocks(page), trained()
    pairs = [(0, 0.0), *[(b.words, b.linked / b.words) for b in found], (0, 0.0)]
    kept = []
    for i, b in enumerate(found):
        if chosen(tree, [*pairs[i + 1], *pairs[i], *pairs[i + 2], float(b.main), float(b.furniture)]):
            kept.append(b.text)
    return " ".join(kept)


def extract(pages: DataFrame) -> DataFrame:
    """`pages` with text and n_chars of the main text of `html`."""

    @F.pandas_udf("text string, n_chars long")
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [main_text(p) for p in batch]
            yield pd.DataFrame({"text": found, "n_chars": [len(t) for t in found]})

    return with_result(pages, texts("html"), {"text": "text", "n_chars": "n_chars"})
