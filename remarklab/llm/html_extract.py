"""Main text of web pages: flat text blocks, classified by shallow features with a decision tree.

A page is cut into blocks of text at block-level tags. A block is described by its number of words and
its link density (the share of its words inside links), by those of the blocks before and after it, and by
where the markup says that it stands. A decision tree, trained on the labelled blocks below, tells the
article from the rest; the blocks of the article, in page order, are the text.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache
from html import unescape

import numpy as np
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession

from remarklab.llm.common import append_columns

FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "article", "aside", "heading")

# Labelled blocks: words and link density of the block, of the one before and of the one after; in the
# page's article element (1), outside of it (0) or on a page without one (0.5); in an element for
# menus, adverts, notices, forms or comments; a heading; and whether the block belongs to the article.
LABELLED = """
words links  words links  words links  article aside heading  main
# a page with an article element
    1  1.00      0  0.00      1  1.00      0      1      0       0
    1  1.00      1  1.00      1  1.00      0      1      0       0
    2  1.00      2  1.00      7  0.00      0      1      0       0
    7  0.00      1  1.00      9  0.00      0      1      0       0
   30  0.00      2  1.00      8  0.00      0      1      0       0
   12  0.00     20  0.00     15  0.00      0      0      0       0
    9  0.30      4  0.00      0  0.00      0      0      0       0
   25  0.00      6  1.00     12  0.00      0      0      0       0
   60  0.00     40  0.00      5  0.50      0      0      0       0
    3  0.00     55  0.00      0  0.00      0      0      0       0
    4  0.00      7  0.00     60  0.00      0      0      1       0
    6  1.00     90  0.00      6  1.00      0      0      0       0
    9  0.00      7  0.00     12  0.00      1      0      1       1
    4  0.00      1  1.00      3  0.00      1      0      1       1
   10  0.00      9  0.00     48  0.00      1      0      0       1
   48  0.00     10  0.00     95  0.00      1      0      0       1
   95  0.05     48  0.00      1  0.00      1      0      0       1
    1  0.00     95  0.00      1  0.00      1      0      0       1
    1  0.00      1  0.00      2  0.00      1      0      0       1
    2  0.00      1  0.00     64  0.00      1      0      0       1
   64  0.00      2  0.00      8  0.40      1      0      0       1
    1  0.00     64  0.00     11  0.00      1      0      0       1
  150  0.10      3  0.00      4  1.00      1      0      0       1
    5  1.00    150  0.10     70  0.00      1      0      0       1
   20  0.60     70  0.00     40  0.00      1      0      0       1
    4  1.00     80  0.00      4  1.00      1      0      0       1
    3  0.00      9  0.00      3  0.00      1      0      0       1
    1  0.00      0  0.00      0  0.00      1      0      0       1
    1  0.00      0  0.00      3  1.00      1      0      0       1
    2  0.00      2  1.00      0  0.00      1      0      0       1
    3  0.00      1  1.00      1  0.00      1      0      0       1
   12  0.30      1  1.00      5  1.00      1      0      0       1
    1  0.00      6  1.00      6  1.00      1      0      0       1
    7  0.00      2  1.00      5  0.00      1      0      1       1
    5  0.00     14  0.00      4  1.00      1      0      1       1
    8  0.60      3  1.00      3  1.00      1      0      0       1
   20  0.80      1  1.00      1  1.00      1      0      0       1
    2  1.00      1  0.00      1  0.00      1      0      0       1
    3  0.50      0  0.00      9  0.00      1      0      0       1
    6  0.00      5  0.50      9  0.00      1      0      0       1
   26  0.00      8  0.90      8  0.00      1      0      0       1
   12  0.00     60  0.00     11  0.00      1      1      0       0
   40  0.00     12  0.00     20  0.00      1      1      0       0
    3  1.00     60  0.00      3  1.00      1      1      0       0
    3  0.00     30  0.00     50  0.00      1      1      1       0
   90  0.00      5  0.00     60  0.00      1      1      0       0
    1  0.00     80  0.00     30  0.00      1      1      0       0
# a page without one
    1  1.00      0  0.00      1  1.00    0.5      1      0       0
    2  1.00      1  1.00      1  1.00    0.5      0      0       0
    1  1.00      1  1.00      6  0.00    0.5      0      0       0
    6  0.00      1  1.00      3  1.00    0.5      0      0       0
    3  0.00      2  1.00      2  1.00    0.5      0      0       0
    8  0.25      3  1.00      0  0.00    0.5      0      0       0
    7  0.50     30  0.00      4  1.00    0.5      0      0       0
   25  0.80     20  0.90     22  0.90    0.5      0      0       0
   18  1.00     50  0.00     18  1.00    0.5      0      0       0
   15  0.00     40  0.00      0  0.00    0.5      1      0       0
   60  0.00     40  0.00     30  0.00    0.5      1      0       0
    4  0.00      4  1.00     70  0.00    0.5      1      1       0
    7  0.00      2  1.00     45  0.00    0.5      0      1       1
    4  0.00     60  0.00     80  0.00    0.5      0      1       1
   10  0.00      7  0.00     70  0.00    0.5      0      0       1
   45  0.00      7  0.00     80  0.00    0.5      0      0       1
   80  0.05     45  0.00      2  0.00    0.5      0      0       1
    2  0.00     80  0.00     33  0.00    0.5      0      0       1
    1  0.00     70  0.00     70  0.00    0.5      0      0       1
   33  0.10      2  0.00      5  1.00    0.5      0      0       1
   28  0.00      3  1.00      9  0.30    0.5      0      0       1
    3  0.00      2  1.00     22  0.00    0.5      0      1       1
    5  0.00     14  0.00     16  0.00    0.5      0      1       1
   22  0.00      3  0.00      1  0.00    0.5      0      0       1
    1  0.00     22  0.00     19  0.00    0.5      0      0       1
   19  0.00      1  0.00      3  1.00    0.5      0      0       1
   15  0.00     20  0.00     18  0.00    0.5      0      0       1
   18  0.10     15  0.00     25  0.00    0.5      0      0       1
   14  0.00      4  1.00     16  0.00    0.5      0      0       1
   16  0.00     14  0.00      4  1.00    0.5      0      0       1
   30  0.00      0  0.00      0  0.00    0.5      0      0       1
    9  0.00     18  0.00      0  0.00    0.5      0      0       0
    5  0.00      3  1.00      0  0.00    0.5      0      0       0
    4  0.00      6  1.00      8  1.00    0.5      0      1       0
  120  0.20      6  1.00      4  1.00    0.5      0      0       1
"""

# elements that end a block where they start and end; all others leave the text in one piece
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section select "
    "summary table tbody td tfoot th thead tr ul".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# their content is no text of the page
RAW_TAGS = frozenset("iframe noembed noframes noscript script style template textarea title xmp".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# elements that a start tag of the same kind ends
SIBLINGS = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th"),
            "option": ("option",), "a": ("a",)}
ASIDE_TAGS = frozenset("nav aside form footer dialog menu search button select head svg object canvas audio video".split())
# names that pages give to elements around the article
ASIDE_NAMES = frozenset(
    "ad ads adsense advert adverts advertisement advertising alert aside banner breadcrumb breadcrumbs comment comments complementary "
    "consent contentinfo cookie cookies disqus footer form login masthead menu menubar modal nav navbar navigation newsletter notice "
    "notices pager pagination paywall popup promo promotion recommended related replies reply respond search share sharing sidebar signup "
    "social sponsor sponsored subscribe toolbar widget widgets".split())
PLACES = frozenset("bottom global left main page primary reader right secondary site top user".split())
LANDMARKS = frozenset("article main".split())
ROOTS = frozenset("html body article main".split())

NAME = re.compile(r"[a-zA-Z][^\s/>]*")
STOP = re.compile(r">|=\s*([\"'])")
NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.IGNORECASE)
RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE) for name in RAW_TAGS}
COMMENT_END = re.compile(r"--!?>")


@dataclass
class Block:
    text: str
    words: int
    links: float
    article: bool
    aside: bool
    heading: bool


def named_aside(attributes: str, whole: bool) -> bool:
    """Whether a class, id or role names something around the article; ``whole`` asks for exactly such a name."""
    for found in NAMED.findall(attributes):
        for name in "".join(found).lower().split():
            parts = re.split(r"[-_]+", name)
            if name in ASIDE_NAMES or not whole and (
                    parts[0] in ASIDE_NAMES or len(parts) == 2 and parts[0] in PLACES and parts[1] in {*ASIDE_NAMES, "header"}):
                return True
    return False


def tag_end(html: str, at: int) -> int:
    """Place of the ``>`` that ends a tag, past quoted values; the length of the page if there is none."""
    while found := STOP.search(html, at):
        if not found.group(1):
            return found.start()
        at = html.find(found.group(1), found.end()) + 1
        if not at:
            # a value that is never closed ends with the tag
            return html.find(">", found.end()) % (len(html) + 1)
    return len(html)


class Page:
    """Reads a page once, keeping the open elements and the text of the current block."""

    def __init__(self):
        self.blocks: list[Block] = []
        # open elements: name, and what they add: in the article, aside, link, heading
        self.open: list[tuple[str, bool, bool, bool, bool]] = []
        self.counts: dict[str, int] = {}
        self.article = self.aside = self.link = self.heading = 0
        self.parts: list[str] = []
        self.linked = 0
        self.landmark = False
        self.state = (False, False, False)

    def text(self, raw: str) -> None:
        if not raw:
            return
        text = unescape(raw) if "&" in raw else raw
        if not text.isspace():
            self.state = (self.article > 0, self.aside > 0, self.heading > 0)
            if self.link:
                self.linked += len(text.split())
        self.parts.append(text)

    def close_block(self) -> None:
        if not self.parts:
            return
        words = "".join(self.parts).split()
        if words:
            self.blocks.append(Block(" ".join(words), len(words), min(1.0, self.linked / len(words)), *self.state))
        self.parts, self.linked = [], 0

    def _count(self, element, step: int) -> None:
        name, article, aside, link, heading = element
        self.counts[name] = self.counts.get(name, 0) + step
        self.article += step * article
        self.aside += step * aside
        self.link += step * link
        self.heading += step * heading

    def start(self, name: str, attributes: str) -> None:
        if name in BLOCK_TAGS:
            self.close_block()
            if self.counts.get("p"):
                self.end_until(("p",), None)
        if name in SIBLINGS:
            self.end_until(SIBLINGS[name], {"li": ("ul", "ol", "menu"), "tr": ("table",), "td": ("table",), "th": ("table",)}.get(name))
        if name == "body" and self.counts.get("head"):
            self.end_until(("head",), None)
        if name == "br":
            self.parts.append(" ")
        if name in VOID_TAGS:
            return
        self.landmark |= name in LANDMARKS
        aside = name in ASIDE_TAGS or name == "header" and not self.article or (
            bool(attributes) and name not in HEADINGS and named_aside(attributes, name in ROOTS))
        element = (name, name in LANDMARKS, aside, name == "a", name in HEADINGS)
        self.open.append(element)
        self._count(element, 1)

    def end(self, name: str) -> None:
        if name in BLOCK_TAGS:
            self.close_block()
        if name == "br":
            self.parts.append(" ")
        if self.counts.get(name):
            self.end_until((name,), None)

    def end_until(self, names: tuple[str, ...], scope: tuple[str, ...] | None) -> None:
        """Close the open elements up to the last of these names, unless a scope's element is in between."""
        if not any(self.counts.get(n) for n in names):
            return
        if scope is not None:
            for element in reversed(self.open):
                if element[0] in names:
                    break
                if element[0] in scope:
                    return
        while True:
            element = self.open.pop()
            self._count(element, -1)
            if element[0] in names:
                return

    def read(self, html: str) -> list[Block]:
        at, end = 0, len(html)
        while at < end:
            left = html.find("<", at)
            if left < 0:
                left = end
            self.text(html[at:left])
            if left >= end - 1:
                self.text(html[left:])
                break
            mark = html[left + 1]
            if mark.isascii() and mark.isalpha():
                at = self._start_tag(html, left + 1)
            elif mark == "/" and (name := NAME.match(html, left + 2)):
                self.end(name.group().lower())
                at = tag_end(html, name.end()) + 1
            elif html.startswith("<!--", left):
                found = COMMENT_END.search(html, left + 4)
                at = left + 5 if html.startswith("<!-->", left) else found.end() if found else end
            elif mark in "!?/":
                close = html.find(">", left)
                at = close + 1 if close >= 0 else end
            else:
                self.text("<")
                at = left + 1
        self.close_block()
        return self.blocks

    def _start_tag(self, html: str, at: int) -> int:
        name = NAME.match(html, at)
        close = tag_end(html, name.end())
        lower = name.group().lower()
        if lower not in RAW_TAGS:
            self.start(lower, html[name.end():close])
            return close + 1
        ended = RAW_END[lower].search(html, close)
        return tag_end(html, ended.end()) + 1 if ended else len(html)


def read_blocks(html: str | None) -> tuple[list[Block], bool]:
    """The text blocks of a page, and whether the page has an article or main element."""
    page = Page()
    return page.read(html or ""), page.landmark


def features(blocks: list[Block], landmark: bool) -> np.ndarray:
    """One row per block, as the labelled table has them."""
    own = np.array([(b.words, b.links) for b in blocks], dtype=float).reshape(len(blocks), 2)
    none = np.zeros((min(1, len(blocks)), 2))
    place = np.array([(float(b.article) if landmark else 0.5, b.aside, b.heading) for b in blocks], dtype=float).reshape(len(blocks), 3)
    return np.hstack([own, np.vstack([none, own[:-1]]), np.vstack([own[1:], none]), place])


@dataclass(frozen=True)
class Tree:
    """A decision tree as arrays: the feature of each node (-1 for a leaf), its threshold, children and class."""

    feature: tuple[int, ...]
    threshold: tuple[float, ...]
    children: tuple[tuple[int, int], ...]
    main: tuple[bool, ...]

    def predict(self, rows: np.ndarray) -> np.ndarray:
        feature, threshold, children = np.array(self.feature), np.array(self.threshold), np.array(self.children)
        node = np.zeros(len(rows), dtype=int)
        while (inner := feature[node] >= 0).any():
            at = node[inner]
            right = rows[inner, feature[at]] > threshold[at]
            node[inner] = children[at, right.astype(int)]
        return np.array(self.main)[node]


def labelled_rows() -> list[list[float]]:
    lines = [x for x in LABELLED.strip().splitlines()[1:] if not x.startswith("#")]
    return [[float(x) for x in line.split()] for line in lines]


def train(spark: SparkSession, rows: list[list[float]] | None = None, depth: int = 8) -> Tree:
    """Fit the tree on labelled blocks (feature values and 0 or 1 for the article), the table above by default."""
    df = spark.createDataFrame(rows or labelled_rows(), ", ".join(f"{c} double" for c in (*FEATURES, "label")))
    assembled = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(df).coalesce(1)
    model = DecisionTreeClassifier(maxDepth=depth, minInstancesPerNode=1, maxBins=128, seed=1).fit(assembled)
    nodes: list[list] = []

    def walk(node) -> int:
        at = len(nodes)
        nodes.append([-1, 0.0, (at, at), node.prediction() == 1.0])
        if node.subtreeDepth() > 0:
            split = node.split()
            nodes[at][:3] = [split.featureIndex(), split.threshold(), (walk(node.leftChild()), walk(node.rightChild()))]
        return at

    walk(model._java_obj.rootNode())
    return Tree(*(tuple(x) for x in zip(*nodes, strict=True)))


@lru_cache(maxsize=4)
def extractor(tree: Tree) -> Callable[[str | None], tuple[str, int, int]]:
    def extract(html: str | None) -> tuple[str, int, int]:
        blocks, landmark = read_blocks(html)
        if not blocks:
            return "", 0, 0
        kept = [b.text for b, main in zip(blocks, tree.predict(features(blocks, landmark)), strict=True) if main]
        return "\n\n".join(kept), len(blocks), len(kept)

    return extract


def extract_pages(df: DataFrame, tree: Tree, html: str = "html", keep: list[str] | None = None) -> DataFrame:
    """Add ``text`` (the article; empty if there is none), ``n_blocks`` and ``n_kept`` to every row.

    Character references are decoded, white space in a block becomes one space, blocks are joined by
    an empty line. NULL and empty pages have an empty text, a page without tags is one block. Pages
    are read whole, whatever their length, and broken markup is read as far as it goes. Other
    columns, repeated rows and equal ids stay as they are; columns named like the new ones give way to them.
    An empty table gives an empty one. Nothing is shuffled.
    """

    def make():
        extract = extractor(tree)
        return lambda pages: list(zip(*map(extract, pages), strict=True)) if pages else [[], [], []]

    return append_columns(df, html, "text string, n_blocks int, n_kept int", make, keep)
