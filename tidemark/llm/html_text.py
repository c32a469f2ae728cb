"""HTML extraction: flat text blocks, classified by a decision tree over shallow features.

A page is cut into blocks at block-level tags.  Each block has its word count and link density, those of
its neighbours, and marks of the elements around it (article, page furniture by tag or by class, heading).
Names that say how the page is laid out (``has-sidebar``, ``no-comments``) mark nothing.  If all articles of
the page are in elements marked by name or in a form, these are wrappers: their article or main elements
without a mark of their own are not furniture.
The tree is trained with Gini splits on the small labelled table below (or on one passed in), and the
blocks it calls content, in page order, are the main text.

Defined results: null, empty or markup-free html gives its own text or none; unclosed and unknown tags do
not raise; scripts, styles, comments and the head never give text; extra columns are ignored.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# FIXED VALUES: HTML element classes.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre section select "
    "summary table tbody td tfoot th thead title tr ul".split())
SILENT_TAGS = frozenset("script style noscript template textarea svg object iframe canvas audio video head select".split())
RAW_TAGS = frozenset("script style textarea title iframe noscript".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
FURNITURE_TAGS = frozenset("nav footer aside form menu dialog".split())
ARTICLE_TAGS = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar".split())
FURNITURE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies disclaimer disqus footer gdpr header hidden login masthead menu modal nav navbar navigation newsletter notice "
    "overlay pagination popup promo promoted promotion related replies reply respond search share sharing sidebar signup "
    "skip social sponsor sponsored subscribe teaser toolbar widget".split())
LAYOUT_WORDS = frozenset("has no not with without layout".split())
BREAKING_TAGS = BLOCK_TAGS - SILENT_TAGS | {"head"}
UNMARKED, BY_NAME, MARKED = 0, 1, 2

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:\s*[^\s\"'>=]++(?:\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'>]*))?|[\s\"'=])*)\s*(?:>|\Z)",
    re.S)
_ATTRIBUTE = re.compile(r"([^\s\"'>=/]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_NAME = re.compile(r"[a-z]+")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I) for t in RAW_TAGS}


@dataclass
class Block:
    text: str
    words: int
    link_words: int
    article: bool
    furniture: bool
    heading: bool

    @property
    def link_density(self) -> float:
        return self.link_words / self.words if self.words else 0.0


def _names(value: str) -> set[str]:
    """The words of the class or id names, without names that describe the layout."""
    words = [set(_NAME.findall(name)) for name in value.split()]
    return set().union(*(w for w in words if not w & LAYOUT_WORDS))


def _furniture_name(value: str, in_article: bool) -> bool:
    """Whether a class or id value names furniture: inside an article only by a whole name made of such words."""
    if not in_article:
        return bool(_names(value) & FURNITURE_NAMES)
    known = FURNITURE_NAMES - {"header"}
    return any((own := set(_NAME.findall(name))) and own <= known for name in value.split())


def _furniture(tag: str, rest: str, in_article: bool) -> int:
    """``MARKED`` by tag, role or hiding, ``BY_NAME`` by class or id or as a form, which may wrap the page."""
    if tag in FURNITURE_TAGS - {"form"} or (tag == "header" and not in_article):
        return MARKED
    mark = BY_NAME if tag == "form" else UNMARKED
    if not rest or rest.isspace():
        return mark
    for key, *values in _ATTRIBUTE.findall(rest):
        key, value = key.lower(), next((v for v in values if v), "").lower()
        if key in ("class", "id"):
            if tag not in ("body", "html", "article", "main") and _furniture_name(value, in_article):
                mark = BY_NAME
        elif key == "role" and value in FURNITURE_ROLES:
            return MARKED
        elif key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return MARKED
        elif key == "aria-hidden" and value == "true":
            return MARKED
    return MARKED if re.search(r"(?:^|\s)hidden(?=[\s/]|$)", rest, re.I) else mark


def page_blocks(page: str) -> list[Block]:
    """The non-empty text blocks of a page in order."""
    blocks: list[Block] = []
    parts: list[str] = []  # of the open block
    link_parts: list[str] = []
    stack: list[tuple[str, bool, int, bool, bool]] = []  # tag, article, furniture, heading, wrapped article
    wrapped: list[Block] = []
    top_level = ("", False, UNMARKED, False, False)
    links = silent = 0

    def flush():
        nonlocal parts, link_parts
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                linked = len(html.unescape(" ".join(link_parts)).split())
                n = len(text.split())
                _, article, furniture, heading, inside = stack[-1] if stack else top_level
                blocks.append(Block(text, n, min(linked, n), article, furniture > UNMARKED, heading))
                if inside and furniture == UNMARKED:
                    wrapped.append(blocks[-1])
        parts, link_parts = [], []

    at, size = 0, len(page)
    while at < size:
        lt = page.find("<", at)
        if lt != at:
            data = page[at:lt] if lt >= 0 else page[at:]
            if not silent:
                parts.append(data)
                if links:
                    link_parts.append(data)
            if lt < 0:
                break
        found = _TOKEN.match(page, lt)
        if not found:  # a stray "<" is text
            if not silent:
                parts.append("<")
            at = lt + 1
            continue
        at = found.end()
        tag = (found["tag"] or "").lower()
        if not tag:
            continue
        closing, rest = bool(found["close"]), found["rest"]
        if tag == "a":
            links = 0 if closing else 1
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag not in BLOCK_TAGS and tag not in SILENT_TAGS:
            top = stack[-1] if stack else top_level
            if not closing and tag not in VOID_TAGS and (own := _furniture(tag, rest, top[1])):
                flush()
                stack.append((tag, top[1], max(own, top[2]), top[3], top[4]))
            elif closing and stack and stack[-1][0] == tag:
                flush()
                stack.pop()
            continue
        # silent elements, and what is in them, leave the block around them whole
        breaks = tag in BREAKING_TAGS and not silent
        if breaks:
            flush()
        if closing:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    left = silent - sum(name in SILENT_TAGS for name, *_ in stack[i:])
                    if silent and not left and tag in BREAKING_TAGS:
                        flush()  # the block ends with a silent element still open
                    silent = left
                    del stack[i:]
                    break
            links = 0 if breaks else links
            continue
        if tag in ("p", "li", "tr", "td", "th", "dt", "dd", "option", *HEADINGS) and stack and stack[-1][0] == tag:
            stack.pop()  # its end tag may be left out
        elif breaks and stack and stack[-1][0] == "p":
            stack.pop()  # a block ends a paragraph
        elif tag == "body":
            while stack and stack[-1][0] == "head":  # the head may be left open
                silent -= 1
                stack.pop()
        if tag in RAW_TAGS:
            end = _RAW_END[tag].search(page, at)
            at = end.end() if end else size
            continue
        if tag in VOID_TAGS or rest.endswith("/"):
            continue
        _, article, furniture, _, inside = stack[-1] if stack else top_level
        if tag in ARTICLE_TAGS and not article and furniture == BY_NAME and not _furniture("div", rest, True):
            furniture, inside = UNMARKED, True
        stack.append((tag, article or tag in ARTICLE_TAGS, max(furniture, _furniture(tag, rest, article)),
                      tag in HEADINGS, inside))
        silent += tag in SILENT_TAGS
    flush()
    own = {id(b) for b in wrapped}
    if any(b.article and not b.furniture and id(b) not in own for b in blocks):
        for b in wrapped:  # the page has its article elsewhere: these are cards in its furniture
            b.furniture = True
    return blocks


def features(blocks: list[Block], page_has_article: bool) -> np.ndarray:
    """One row per block: words, link density of the block and its neighbours, and the element marks."""
    own = np.array([[b.words, b.link_density] for b in blocks], dtype=float).reshape(-1, 2)
    before = np.vstack((np.zeros((1, 2)), own[:-1]))
    after = np.vstack((own[1:], np.zeros((1, 2))))
    marks = np.array([[b.article, b.furniture, b.heading, page_has_article] for b in blocks], dtype=float).reshape(-1, 4)
    return np.hstack((own, before, after, marks))


# The small labelled table: words, link density (own, previous, next), in article, in furniture, heading,
# page has an article element, label (1: main text).
LABELLED_BLOCKS: list[tuple[float, ...]] = [
    # pages with an article element: its blocks, short or long
    (12, 0.0, 8, 0.0, 60, 0.0, 1, 0, 1, 1, 1), (3, 0.0, 9, 0.0, 2, 0.0, 1, 0, 1, 1, 1), (80, 0.0, 12, 0.0, 45, 0.0, 1, 0, 0, 1, 1),
    (45, 0.05, 80, 0.0, 1, 0.0, 1, 0, 0, 1, 1), (1, 0.0, 45, 0.0, 2, 0.0, 1, 0, 0, 1, 1), (2, 0.0, 1, 0.0, 150, 0.0, 1, 0, 0, 1, 1),
    (150, 0.1, 2, 0.0, 30, 0.0, 1, 0, 0, 1, 1), (30, 0.0, 150, 0.1, 9, 0.2, 1, 0, 0, 1, 1), (6, 1.0, 40, 0.0, 50, 0.0, 1, 0, 0, 1, 1),
    (25, 0.3, 30, 0.0, 30, 0.0, 1, 0, 0, 1, 1), (400, 0.0, 3, 0.0, 0, 0.0, 1, 0, 0, 1, 1), (9, 0.0, 6, 1.0, 0, 0.0, 1, 0, 0, 1, 1),
    (9, 0.1, 2, 1.0, 2, 0.0, 1, 0, 0, 1, 1), (2, 0.0, 3, 1.0, 4, 1.0, 1, 0, 0, 1, 1), (40, 0.0, 1, 1.0, 1, 1.0, 1, 0, 0, 1, 1),
    (5, 0.0, 0, 0.0, 0, 0.0, 1, 0, 1, 1, 1), (3, 1.0, 3, 1.0, 3, 1.0, 1, 0, 0, 1, 1), (20, 0.5, 1, 1.0, 30, 0.9, 1, 0, 0, 1, 1),
    (1, 0.0, 2, 1.0, 100, 0.0, 1, 0, 0, 1, 1), (70, 0.6, 60, 0.0, 2, 1.0, 1, 0, 0, 1, 1), (4, 0.5, 9, 0.0, 9, 0.0, 1, 0, 1, 1, 1),
    (8, 0.0, 4, 1.0, 25, 0.7, 1, 0, 0, 1, 1), (35, 0.45, 5, 0.6, 5, 0.0, 1, 0, 0, 1, 1), (2, 1.0, 80, 0.0, 6, 0.0, 1, 0, 0, 1, 1),
    # the same pages outside the article
    (1, 1.0, 0, 0.0, 1, 1.0, 0, 1, 0, 1, 0), (1, 1.0, 1, 1.0, 8, 0.0, 0, 1, 0, 1, 0), (8, 0.0, 1, 1.0, 12, 0.0, 0, 1, 0, 1, 0),
    (9, 0.1, 40, 0.0, 0, 0.0, 0, 1, 0, 1, 0), (35, 0.0, 1, 1.0, 10, 0.0, 0, 1, 0, 1, 0), (60, 0.0, 60, 0.0, 20, 0.5, 0, 1, 0, 1, 0),
    (14, 0.0, 5, 1.0, 90, 0.0, 0, 0, 0, 1, 0), (40, 0.0, 90, 0.0, 4, 1.0, 0, 0, 0, 1, 0), (6, 0.0, 2, 1.0, 3, 0.0, 0, 0, 1, 1, 0),
    (5, 1.0, 8, 0.5, 5, 1.0, 0, 0, 0, 1, 0), (3, 0.0, 30, 0.0, 12, 0.0, 0, 0, 0, 1, 0),
    # furniture inside the article element
    (20, 0.0, 90, 0.0, 60, 0.0, 1, 1, 0, 1, 0), (4, 1.0, 60, 0.0, 4, 1.0, 1, 1, 0, 1, 0), (90, 0.0, 4, 1.0, 30, 0.0, 1, 1, 0, 1, 0),
    (7, 0.0, 30, 0.0, 50, 0.0, 1, 1, 1, 1, 0), (55, 0.1, 7, 0.0, 40, 0.0, 1, 1, 0, 1, 0),
    # pages without an article element: text blocks
    (90, 0.0, 10, 0.0, 70, 0.0, 0, 0, 0, 0, 1), (70, 0.05, 90, 0.0, 20, 0.0, 0, 0, 0, 0, 1), (20, 0.0, 70, 0.05, 40, 0.0, 0, 0, 0, 0, 1),
    (40, 0.1, 20, 0.0, 5, 0.0, 0, 0, 0, 0, 1), (10, 0.0, 3, 1.0, 90, 0.0, 0, 0, 1, 0, 1), (6, 0.0, 2, 1.0, 60, 0.0, 0, 0, 1, 0, 1),
    (5, 0.0, 40, 0.1, 80, 0.0, 0, 0, 0, 0, 1), (4, 0.0, 50, 0.0, 35, 0.0, 0, 0, 1, 0, 1), (15, 0.0, 40, 0.0, 3, 1.0, 0, 0, 0, 0, 1),
    (12, 0.2, 60, 0.0, 45, 0.0, 0, 0, 0, 0, 1), (200, 0.2, 1, 1.0, 2, 1.0, 0, 0, 0, 0, 1), (1, 0.0, 50, 0.0, 44, 0.0, 0, 0, 0, 0, 1),
    (18, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 0, 1), (3, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 0, 1), (8, 0.0, 0, 0.0, 25, 0.0, 0, 0, 0, 0, 1),
    # pages without an article element: the rest
    (1, 1.0, 0, 0.0, 2, 1.0, 0, 0, 0, 0, 0), (2, 1.0, 1, 1.0, 3, 1.0, 0, 0, 0, 0, 0), (3, 1.0, 2, 1.0, 10, 0.0, 0, 0, 0, 0, 0),
    (4, 0.75, 60, 0.0, 3, 1.0, 0, 0, 0, 0, 0), (30, 0.9, 2, 1.0, 20, 0.95, 0, 0, 0, 0, 0), (10, 0.6, 5, 1.0, 8, 0.8, 0, 0, 0, 0, 0),
    (6, 0.5, 40, 0.0, 0, 0.0, 0, 0, 0, 0, 0), (2, 0.0, 3, 1.0, 2, 1.0, 0, 0, 0, 0, 0), (5, 0.0, 4, 1.0, 6, 1.0, 0, 0, 0, 0, 0),
    (8, 0.0, 1, 1.0, 1, 1.0, 0, 1, 0, 0, 0), (40, 0.0, 60, 0.0, 2, 1.0, 0, 1, 0, 0, 0), (9, 0.0, 70, 0.0, 0, 0.0, 0, 1, 0, 0, 0),
    (120, 0.0, 20, 0.0, 30, 0.0, 0, 1, 0, 0, 0), (3, 0.0, 40, 0.0, 20, 0.0, 0, 1, 1, 0, 0), (15, 0.0, 0, 0.0, 90, 0.0, 0, 1, 0, 0, 0),
]


@dataclass
class Tree:
    """Binary decision tree as arrays; ``feature`` -1 marks a leaf."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    label: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), dtype=np.int64)
        rows = np.arange(len(x))
        while (inner := self.feature[node] >= 0).any():
            at, r = node[inner], rows[inner]
            node[inner] = np.where(x[r, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        return self.label[node]


def train_tree(labelled=None, max_depth: int = 6) -> Tree:
    """CART with Gini splits; ties go to the first feature and the lowest threshold."""
    table = np.array(LABELLED_BLOCKS if labelled is None else labelled, dtype=float)
    nodes: list[list] = []

    def grow(rows: np.ndarray, depth: int) -> int:
        number, y = len(nodes), table[rows, -1]
        nodes.append([-1, 0.0, -1, -1, int(y.mean() >= 0.5)])
        if depth == max_depth or y.min() == y.max():
            return number
        best = None
        for f in range(table.shape[1] - 1):
            order = rows[np.argsort(table[rows, f], kind="stable")]
            value, ones = table[order, f], np.cumsum(table[order, -1])
            cut = np.flatnonzero(value[1:] > value[:-1])
            if not len(cut):
                continue
            n, k = cut + 1, len(rows)
            left, right = ones[cut] / n, (ones[-1] - ones[cut]) / (k - n)
            gini = n * left * (1 - left) + (k - n) * right * (1 - right)
            i = int(gini.argmin())
            if best is None or gini[i] < best[0] - 1e-9:
                best = (gini[i], f, (value[cut[i]] + value[cut[i] + 1]) / 2)
        if best is None:
            return number
        _, f, t = best
        low = table[rows, f] <= t
        nodes[number][:4] = [f, t, grow(rows[low], depth + 1), grow(rows[~low], depth + 1)]
        return number

    grow(np.arange(len(table)), 0)
    return Tree(*(np.array(c) for c in zip(*nodes, strict=True)))


def main_text(page: str | None, tree: Tree) -> str:
    blocks = page_blocks(page or "")
    if not blocks:
        return ""
    kept = tree.predict(features(blocks, any(b.article for b in blocks)))
    return "\n\n".join(b.text for b, k in zip(blocks, kept.tolist(), strict=True) if k)


def extract(pages: DataFrame, labelled=None) -> DataFrame:
    """Per page row: page_id, url, text, n_chars."""
    tree = train_tree(labelled)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                texts = [main_text(x, tree) for x in batch.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())],
                                                 names=["page_id", "url", "text"])

    out = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(
        run, "page_id long, url string, text string")
    return out.withColumn("n_chars", F.length("text").cast("long"))
