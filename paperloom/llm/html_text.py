"""Main text of web pages: flat text blocks, classified by a small decision tree.

A page becomes a flat list of text blocks (what stands between block-level tags). Each block is described by its word count and link
density, those of the blocks before and after it, and where its markup puts it. A decision tree trained on a small labelled table
of such descriptions says which blocks belong to the article.
"""

from __future__ import annotations

import html as html_entities
import re
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from paperloom.llm.common import append_by_batch

_TAG = re.compile(
    r"""<(?:!--.*?(?:--!?>|\Z)|!\[CDATA\[.*?(?:\]\]>|\Z)|[!?][^>]*>?|(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*'|["'])*+)>?)""", re.DOTALL
)
# Elements whose content never is page text, up to their end tag.
_OPAQUE = frozenset("script style noscript title textarea iframe template svg math select button object".split())
# Those whose content is no markup; an unclosed one lasts to the end of the page.
_RAW = frozenset("script style title textarea iframe".split())
_END_TAGS = re.compile(r"</([a-z][^\s/>]*)", re.IGNORECASE | re.ASCII)
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)", re.IGNORECASE | re.ASCII) for name in _RAW}
_UNQUOTED_SLASH = re.compile(r"""=\s*[^\s"'=]+/\Z""")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head "
    "header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
_AROUND = frozenset("nav header footer aside form menu dialog fieldset search head".split())
_ARTICLE = frozenset("article main".split())
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu", "menubar", "toolbar", "alertdialog"}
# Parts of class and id names that mark what is around an article.
_HINTS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion promoted banner cookie cookies consent gdpr notice notices "
    "alert popup modal overlay comment comments commentlist discussion disqus reply replies respond sidebar side menu nav navbar navigation navigator "
    "breadcrumb breadcrumbs header masthead footer copyright legal share sharing social related recommended recommendations subscribe subscription "
    "newsletter signup login search widget widgets toolbar pagination pager tags hidden".split()
)
_COMMENT = frozenset("comment comments reply replies".split())
_WHOLE = frozenset("html body article main".split())
_NAME_PARTS = re.compile(r"[a-z]+")
# Before or after a part, they say that the page has or lacks such a thing and not that the element is one.
_SAYS_HAS = frozenset("has no not with without".split())
_SAYS_OFF = frozenset("closed disabled off".split())
_ATTRIBUTE = re.compile(r"""([a-zA-Z][\w:-]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""")

NAMES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "place", "around")


@dataclass
class Block:
    text: str
    words: int
    links: float
    """Share of the words that stand in links."""
    in_article: bool
    around: bool
    hints: tuple[int, ...] = ()
    """Numbers of the elements around it whose names mark them as something around an article; negative for comments inside one."""


def _named_parts(value: str) -> set[str]:
    """The parts of class or id names that say what the element is."""
    out = set()
    for token in value.split():
        parts = _NAME_PARTS.findall(token)
        out.update(p for k, p in enumerate(parts) if not (k and parts[k - 1] in _SAYS_HAS) and not (k + 1 < len(parts) and parts[k + 1] in _SAYS_OFF))
    return out


def _settle_hints(found: list[Block]) -> None:
    """A hint says nothing if its element holds most of the page's words, in more than one block, or most of the words in articles and
    at least a quarter of the page's: such an element is the page's frame."""
    total, in_articles = sum(b.words for b in found), sum(b.words for b in found if b.in_article)
    held: dict[int, list[int]] = {}
    for b in found:
        for h in b.hints:
            n = held.setdefault(h, [0, 0, 0])
            n[0], n[1], n[2] = n[0] + b.words, n[1] + 1, n[2] + b.words * b.in_article
    frames = {h for h, (words, n, own) in held.items() if h > 0 and ((2 * words > total and n > 1) or (2 * own > in_articles and 4 * own >= total))}
    for b in found:
        b.around = b.around or any(h not in frames for h in b.hints)


def _marks(name: str, attributes: str) -> tuple[bool, bool, bool]:
    """(is an article's element, is marked as something around an article, is named as comments) by class, id, role and hidden."""
    article, hinted, comment = name in _ARTICLE, False, False
    if attributes and not attributes.isspace():
        for key, a, b, c in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), (a or b or c).lower()
            if key in ("class", "id"):
                parts = _named_parts(value)
                comment = comment or not _COMMENT.isdisjoint(parts)
                if name in _WHOLE:  # says something about the page or the article, unless it is a reader's comment
                    hinted = hinted or (name != "body" and name != "html" and not _COMMENT.isdisjoint(parts))
                else:
                    hinted = hinted or not _HINTS.isdisjoint(parts)
            elif key == "role":
                article = article or value in ("main", "article")
                hinted = hinted or value in _ROLES
            elif key == "itemprop":
                article = article or value == "articlebody"
            elif key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and re.search(r"display\s*:\s*none", value)):
                hinted = True
    return article, hinted, comment


def _self_closed(name: str, attributes: str) -> bool:
    return name in ("svg", "math") and attributes.endswith("/") and not _UNQUOTED_SLASH.search(attributes)


def _raw_end(page: str, name: str, pos: int) -> int:
    end = _RAW_END[name].search(page, pos)
    return end.start() if end else len(page)


def _opaque_end(page: str, name: str, pos: int, opened: set[str], last_end: dict[str, int]) -> int:
    """Where the content of an opaque element that begins at `pos` ends. If its own end tag does not stand before that of an element around
    it (`opened`), nothing is taken as its content, so that no text is lost. `last_end`: where each name's last end tag stands."""
    if name in _RAW:
        return _raw_end(page, name, pos)
    begin = pos
    if last_end.get(name, -1) < pos:
        return begin
    depth: dict[str, int] = {}
    while match := _TAG.search(page, pos):
        pos = match.end()
        inner, closing = (match[2] or "").lower(), bool(match[1])
        if inner in _RAW and not closing:
            pos = _raw_end(page, inner, pos)
        elif inner == name or inner in opened:
            if not closing:
                if inner == name and name in ("button", "select"):  # does not nest: the one before was never closed
                    return begin
                depth[inner] = depth.get(inner, 0) + (not _self_closed(inner, match[3]))
            elif depth.get(inner, 0):
                depth[inner] -= 1
            else:
                return match.start() if inner == name else begin
    return begin


def blocks(page: str) -> list[Block]:
    """The text blocks of a page in order. Unclosed and wrongly nested tags are taken as browsers do for the usual cases: a block-level
    tag ends an open paragraph, an end tag closes all that was opened inside its element, one without a start is ignored."""
    out: list[Block] = []
    stack: list[tuple[str, bool, bool, tuple[int, ...]]] = []  # name, in article, around by element, hinted elements around
    in_article = by_element = False
    by_hint: tuple[int, ...] = ()
    n_hints = 0
    pieces: list[str] = []
    links: list[str] = []
    in_link = 0
    pos, last_end = 0, None

    def finish() -> None:
        nonlocal pieces, links
        if pieces:
            text = " ".join(html_entities.unescape("".join(pieces)).split())
            if text:
                words = text.count(" ") + 1
                linked = len(html_entities.unescape("".join(links)).split()) if links else 0
                out.append(Block(text, words, min(1.0, linked / words), in_article, by_element, by_hint))
        pieces, links = [], []

    def restore() -> None:
        nonlocal in_article, by_element, by_hint
        _, in_article, by_element, by_hint = stack[-1] if stack else ("", False, False, ())

    for match in iter(lambda: _TAG.search(page, pos), None):
        if match.start() > pos:
            text = page[pos : match.start()]
            pieces.append(text)
            if in_link:
                links.append(text)
        pos = match.end()
        name = match[2]
        if name is None:
            continue
        name, closing = name.lower(), bool(match[1])
        if name in _OPAQUE:
            if not closing and not _self_closed(name, match[3]):
                if last_end is None and name not in _RAW:
                    last_end = {m[1].lower(): m.start() for m in _END_TAGS.finditer(page)}
                pos = _opaque_end(page, name, pos, {s[0] for s in stack}, last_end)
            pieces.append(" ")
            continue
        if name == "a":
            in_link = max(0, in_link - 1) if closing else 1
            if in_link:
                links.append(" ")
            continue
        if name == "br":
            pieces.append(" ")
            continue
        if name not in _BLOCK:
            continue
        finish()
        if name == "hr":
            continue
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    break
            restore()
            continue
        if stack and stack[-1][0] == "p":
            stack.pop()
            restore()
        article, hinted, comment = _marks(name, match[3])
        firm = comment and in_article  # readers' comments on an article, however long
        if article:
            in_article, by_element = True, False  # an article in a menu that was never closed
        elif name == "header" and in_article:
            hinted = False  # an article's own header holds its title
        around = name in _AROUND and not (name == "header" and in_article)
        by_element = by_element or around
        if hinted:
            n_hints += 1
            by_hint = (*by_hint, -n_hints if firm else n_hints)
        stack.append((name, in_article, by_element, by_hint))
    if pos < len(page):
        pieces.append(page[pos:])
    finish()
    _settle_hints(out)
    return out


def descriptions(found: Sequence[Block]) -> np.ndarray:
    """One row of NAMES for each block. A neighbour counts only if it is on the same side of the article's and the frame's edges: a
    footer's link says nothing about the last paragraph. `place`: 2 in an article's element, 1 on a page without one, 0 outside it; `around`: 1 in a
    menu, header, footer, sidebar, form, notice, advert or comment. Articles that hold less than a quarter of the words outside links
    are teasers: such a page counts as one without."""
    n = len(found)
    x = np.zeros((n, len(NAMES)))
    if not n:
        return x
    x[:, 0] = [b.words for b in found]
    x[:, 1] = [b.links for b in found]
    same = np.array([a.in_article == b.in_article and a.around == b.around for a, b in zip(found, found[1:])], bool)[:, None]
    x[1:, 2:4] = np.where(same, x[:-1, 0:2], 0)
    x[:-1, 4:6] = np.where(same, x[1:, 0:2], 0)
    plain = [b for b in found if not b.around and b.links < 0.5]
    own = sum(b.words for b in plain if b.in_article)
    marked = any(b.in_article and not b.around for b in found) and 4 * own >= sum(b.words for b in plain)
    x[:, 6] = [(2 if b.in_article else 0) if marked else 1 for b in found]
    x[:, 7] = [b.around for b in found]
    return x


# A small labelled table: descriptions of blocks as they stand on pages, and whether they are main text.
LABELLED = """
words links words_before links_before words_after links_after place around main
  60 0.00   40 0.00   80 0.00 2 0 1
 200 0.00   60 0.00   15 0.00 2 0 1
  12 0.00   90 0.05   70 0.00 2 0 1
   1 0.00   40 0.00   60 0.00 2 0 1
   1 0.00    6 1.00   25 0.00 2 0 1
   8 0.00    9 0.00   40 0.00 2 0 1
   7 0.00   50 0.00    8 0.10 2 0 1
   3 0.00   20 0.00    0 0.00 2 0 1
   2 0.00    3 0.00    2 0.00 2 0 1
  30 0.40   60 0.00   50 0.10 2 0 1
  15 0.60   45 0.00   30 0.00 2 0 1
   4 1.00   60 0.00   80 0.00 2 0 1
   6 0.90   40 0.10   35 0.00 2 0 1
   3 1.00    4 1.00    3 1.00 2 0 0
   2 1.00    3 1.00    5 1.00 2 0 0
   5 1.00    6 0.95    4 1.00 2 0 0
  60 0.00    2 0.00    4 1.00 2 0 1
 200 0.00   60 0.00    2 1.00 2 0 1
  35 0.00    3 1.00    3 1.00 2 0 1
  20 0.00    0 0.00    5 1.00 2 0 1
 150 0.00    4 1.00    0 0.00 2 0 1
  25 0.05    5 1.00    2 1.00 2 0 1
  10 0.00   40 0.00    5 1.00 2 0 1
   3 0.00   60 0.00    3 1.00 2 0 1
   2 0.00    0 0.00    4 1.00 2 0 1
   4 1.00    0 0.00   60 0.00 2 0 1
   5 1.00    0 0.00   90 0.00 2 0 1
   3 1.00    0 0.00   45 0.00 2 0 1
  40 0.00   30 0.00   50 0.00 2 1 0
  12 0.00   20 0.00    9 0.00 2 1 0
   5 0.00   60 0.00   10 0.00 2 1 0
   3 1.00    3 1.00    2 1.00 2 1 0
  90 0.02   70 0.00   60 0.00 2 1 0
  50 0.00    3 1.00   60 0.00 1 0 1
  70 0.00   65 0.00   90 0.10 1 0 1
  25 0.05   50 0.00   30 0.00 1 0 1
  14 0.00   40 0.00   60 0.00 1 0 1
   8 0.00    2 1.00   55 0.00 1 0 1
   5 0.00   45 0.00   70 0.00 1 0 1
   1 0.00   60 0.00   40 0.00 1 0 1
  35 0.20   50 0.00   45 0.00 1 0 1
  30 0.00    0 0.00    0 0.00 1 0 1
   9 0.00    0 0.00    0 0.00 1 0 1
   4 0.00    0 0.00   20 0.00 1 0 1
   3 0.00    3 0.00    4 0.00 1 0 1
 120 0.02   80 0.00    1 1.00 1 0 1
  45 0.00    2 1.00    2 1.00 1 0 1
  25 0.00   70 0.00    3 1.00 1 0 1
  18 0.00   30 0.00    2 1.00 1 0 1
  30 0.00    0 0.00    4 1.00 1 0 1
   3 1.00    2 1.00    3 1.00 1 0 0
   2 1.00    0 0.00    2 1.00 1 0 0
   4 0.90    3 1.00   40 0.00 1 0 0
   3 1.00   60 0.00    2 1.00 1 0 0
  12 0.80    5 0.90    9 0.90 1 0 0
   2 0.50    3 1.00    4 1.00 1 0 0
  60 0.00   40 0.00   50 0.00 1 1 0
   9 0.00    3 1.00   12 0.00 1 1 0
  20 0.10   80 0.00    0 0.00 1 1 0
   2 1.00    2 1.00    3 1.00 1 1 0
   4 0.00   30 0.00    5 0.20 1 1 0
  40 0.00   60 0.00   20 0.00 0 0 0
  10 0.00    3 1.00   50 0.00 0 0 0
   5 0.00   70 0.00    0 0.00 0 0 0
   3 1.00    2 1.00    8 0.00 0 0 0
  85 0.05   20 0.20   10 0.00 0 0 0
   1 0.00   90 0.00    4 0.00 0 0 0
  12 0.00    2 1.00   60 0.00 0 1 0
  30 0.00   50 0.00    6 0.10 0 1 0
   2 1.00    0 0.00    2 1.00 0 1 0
   8 0.10   65 0.00    0 0.00 0 1 0
 120 0.00   10 0.00   30 0.00 0 1 0
"""


def labelled_table(text: str = LABELLED) -> tuple[np.ndarray, np.ndarray]:
    rows = np.array([[float(v) for v in line.split()] for line in text.strip().splitlines()[1:]])
    return rows[:, :-1], rows[:, -1].astype(int)


@dataclass(frozen=True)
class Tree:
    """Nodes in one array: column, threshold, left and right child (values up to the threshold go left); a leaf has column -1."""

    column: tuple[int, ...]
    threshold: tuple[float, ...]
    left: tuple[int, ...]
    right: tuple[int, ...]
    answer: tuple[int, ...]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        column, threshold, left, right = (np.array(v) for v in (self.column, self.threshold, self.left, self.right))
        at = np.zeros(len(x), int)
        while (column[at] >= 0).any():
            inner = column[at] >= 0
            goes_left = x[np.arange(len(x)), np.maximum(column[at], 0)] <= threshold[at]
            at = np.where(inner, np.where(goes_left, left[at], right[at]), at)
        return np.array(self.answer)[at]


def fit_tree(x: np.ndarray, y: np.ndarray, depth: int = 6, smallest: int = 1) -> Tree:
    """Splits by Gini impurity; ties go to the earlier column and the lower threshold, an even leaf to 0."""
    nodes: list[list] = []

    def grow(rows: np.ndarray, left_depth: int) -> int:
        number = len(nodes)
        own = y[rows]
        nodes.append([-1, 0.0, 0, 0, int(2 * own.sum() > len(own))])
        if left_depth == 0 or own.min() == own.max():
            return number
        best = (len(own) * own.mean() * (1 - own.mean()) - 1e-12, None)
        for c in range(x.shape[1]):
            values = np.unique(x[rows, c])
            for cut in (values[1:] + values[:-1]) / 2:
                side = x[rows, c] <= cut
                if min(side.sum(), (~side).sum()) < smallest:
                    continue
                impurity = sum(len(p) * p.mean() * (1 - p.mean()) for p in (own[side], own[~side]))
                if impurity < best[0] - 1e-12:
                    best = (impurity, (c, float(cut), side))
        if best[1]:
            c, cut, side = best[1]
            nodes[number][:2] = [c, cut]
            nodes[number][2] = grow(rows[side], left_depth - 1)
            nodes[number][3] = grow(rows[~side], left_depth - 1)
        return number

    grow(np.arange(len(y)), depth)
    return Tree(*(tuple(v) for v in zip(*nodes)))


def main_text(page: str | None, tree: Tree) -> str:
    """The page's main blocks joined by line ends; empty for null, empty and textless pages."""
    found = blocks(page or "")
    if not found:
        return ""
    return "\n".join(b.text for b, main in zip(found, tree(descriptions(found))) if main)


def extract_text(pages: DataFrame, html_col: str = "html", tree: Tree | None = None, carry: Sequence[str] | None = None) -> DataFrame:
    """`pages` (columns `carry`, all by default) with `text` and `n_chars` (code points). Nothing is cut; no shuffle; rows are
    independent of each other, whatever their ids."""
    shared = pages.sparkSession.sparkContext.broadcast(tree or fit_tree(*labelled_table()))

    def make():
        tree = shared.value

        def work(batch: pa.RecordBatch) -> list:
            texts = [main_text(p.as_py(), tree) for p in batch.column(0)]
            return [pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]

        return work

    return append_by_batch(pages, make, [html_col], [("text", "string"), ("n_chars", "long")], carry)
