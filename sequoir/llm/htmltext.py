"""Main text of web pages by a decision tree over flat text blocks.

A page becomes a flat list of text blocks. Each has its word count and link
density, those of the blocks before and after it, and what its place in the
page says: inside an article, inside navigation, forms and the like, or under a
class or id that names boilerplate or content. A decision tree, trained on the
small labelled table below, says which blocks are main text. It asks for link
density and words first; the place is asked where these leave it open, as with
reader comments, which are prose like the article's, or a list's short items.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sequoir.llm.common import map_arrow

#: Elements whose text is never read; they end at their own end tag.
SKIPPED = frozenset("script style noscript template iframe object svg math title textarea noembed noframes xmp audio video canvas map".split())
#: Elements that are boilerplate wherever they are.
CHROME = frozenset("nav aside form footer menu dialog button select option datalist fieldset legend head search".split())
#: Elements that hold an article.
ARTICLE = frozenset("article main".split())
#: Containers: their class and place hold for everything in them.
CONTAINERS = CHROME | ARTICLE | frozenset("html body div section header ul ol dl table tbody thead tfoot tr td th blockquote figure details center address hgroup".split())
#: Other elements that begin a new block.
BLOCKS = CONTAINERS | frozenset("p li dt dd h1 h2 h3 h4 h5 h6 pre hr figcaption summary caption optgroup".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BAD_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert popup modal overlay newsletter "
    "subscribe subscription signup login register comment comments commentlist disqus reply replies respond discussion sidebar sidebars widget widgets rail menu menus nav navbar navigation breadcrumb "
    "breadcrumbs footer footnav masthead topbar toolbar share sharing social related recommended recommendations trending popular pagination pager copyright legal disclaimer skip skiplink search hidden "
    "contentinfo complementary".split()
)
GOOD_NAMES = frozenset("content article post entry story main articlebody postbody maintext".split())
#: A class like has-sidebar or no-comments tells of the page's layout and names nothing.
LAYOUT = frozenset(("has", "with", "no"))
#: Of an article's own names only these make it boilerplate.
ARTICLE_BAD = frozenset("comment comments reply ad ads advert advertisement sponsored promo teaser related widget".split())

_tag = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>", re.S)
_name = re.compile(r"</?([a-zA-Z][^\s/>]*+)")
_attributes = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?(?=[\s/]|$)""", re.I | re.S)
_parts = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
_ends = {x: re.compile(rf"</{x}(?=[\s/>]|$)", re.I) for x in SKIPPED}

FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "article", "framed", "chrome", "bad", "good", "heading")


#: So many of them are of the text, and the others of its place; depth of the questions about the text alone, and rows that settle it.
TEXT_FEATURES, TEXT_DEPTH, SETTLED = 6, 3, 20


@dataclass
class Block:
    text: str
    words: int
    linked: int
    article: bool
    chrome: bool
    bad: bool
    good: bool
    heading: bool

    @property
    def links(self) -> float:
        return self.linked / self.words if self.words else 0.0


def _named(attributes: str) -> tuple[frozenset[str], bool]:
    """Parts of class, id and role; whether the element is hidden."""
    if not attributes or "=" not in attributes and "hidden" not in attributes.lower():
        return frozenset(), False
    names: set[str] = set()
    hidden = False
    for key, value in _attributes.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            hidden = True
        elif key == "style":
            hidden |= bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I))
        elif key != "aria-hidden":
            for word in value.split():
                parts = {x.lower() for x in _parts.findall(word)}
                if not parts & LAYOUT:
                    names |= parts | {word.lower()}
    return frozenset(names), hidden


def blocks(html: str) -> list[Block]:
    """The page's text blocks in order. Time is linear in the page's length."""
    found: list[Block] = []
    pieces: list[str] = []
    linked: list[str] = []
    stack: list[tuple[str, bool, bool, bool, bool]] = []  # name, article, chrome, bad, good
    opened: dict[str, int] = {}
    state = [False, False, False, False]  # of the innermost container
    own_bad = heading = False
    anchors = depth = 0  # whether a link is open, and how many containers were when it began
    inside = within = False  # whether a block that isn't a container is open, and was when the link began
    quoted = True  # until a quote in a tag is found never to end
    at, size = 0, len(html)

    def text(piece: str) -> None:
        if piece:
            pieces.append(piece)
            if anchors:
                linked.append(piece)

    def flush() -> None:
        nonlocal own_bad, heading
        if pieces:
            words = unescape("".join(pieces)).split()
            if words:
                n = len(unescape(" ".join(linked)).split()) if linked else 0
                article, chrome, bad, good = state
                found.append(Block(" ".join(words), len(words), min(n, len(words)), article, chrome, bad or own_bad, good, heading))
            pieces.clear()
            linked.clear()
        own_bad = heading = False

    while at < size:
        start = html.find("<", at)
        if start < 0:
            text(html[at:])
            break
        if html.startswith("<!--", start):
            text(html[at:start])
            end = html.find("-->", start + 4)
            at = size if end < 0 else end + 3
            continue
        after = html[start + 1 : start + 2]
        if after in ("!", "?"):
            text(html[at:start])
            end = html.find(">", start)
            at = size if end < 0 else end + 1
            continue
        named = _name.match(html, start)
        if not named:
            if after == "/":  # </ without a name is a comment
                text(html[at:start])
                end = html.find(">", start)
                at = size if end < 0 else end + 1
            else:
                text(html[at : start + 1])
                at = start + 1
            continue
        text(html[at:start])
        tag = _tag.match(html, start) if quoted else None
        if tag:
            closing, name, attributes, at = bool(tag[1]), tag[2].lower(), tag[3], tag.end()
        else:
            quoted = False
            end = html.find(">", start)
            if end < 0:
                break  # a tag that never ends
            closing, name, attributes, at = html[start + 1] == "/", named[1].lower(), html[named.end() : end], end + 1
        if name in SKIPPED:
            if name == "title":
                flush()
            if not closing and not attributes.endswith("/"):
                end = _ends[name].search(html, at)
                if end is None:
                    at = size
                else:
                    close = html.find(">", end.end())
                    at = size if close < 0 else close + 1
            text(" ")
        elif name in CONTAINERS:
            flush()
            inside = False
            if closing:
                if opened.get(name):
                    while stack:
                        top = stack.pop()
                        opened[top[0]] -= 1
                        if top[0] == name:
                            break
                    state = list(stack[-1][1:]) if stack else [False] * 4
                if len(stack) < depth:  # a link may hold blocks, but ends with what it is in
                    anchors = 0
            elif not (attributes.endswith("/") and name not in ("div", "section")):
                names, hidden = _named(attributes)
                article, chrome, bad, good = state
                if name in ARTICLE or "main" in names and "role" in attributes.lower():
                    article = True
                    bad |= bool(names & ARTICLE_BAD)
                elif name not in ("html", "body"):
                    bad |= bool(names & BAD_NAMES) or not article and bool(names & {"header"})
                    good |= bool(names & GOOD_NAMES)
                chrome |= name in CHROME or name == "header" and not article
                state = [article, chrome, bad or hidden, good]
                stack.append((name, *state))
                opened[name] = opened.get(name, 0) + 1
        elif name in BLOCKS:
            flush()
            if within:
                anchors = 0
            inside = not closing
            if not closing:
                names, hidden = _named(attributes)
                own_bad = hidden or bool(names & BAD_NAMES)
                heading = name in HEADINGS
        elif name == "a":
            anchors, depth, within = (0, 0, False) if closing else (1, len(stack), inside)
        elif name in ("br", "img", "input", "wbr"):
            if name != "wbr":
                text(" ")
    flush()
    return found


def features(page: list[Block]) -> np.ndarray:
    """(blocks, FEATURES); beyond the ends of the page there are no words."""
    framed = any(b.article and not b.bad and not b.chrome for b in page)
    words = [0.0, *(float(b.words) for b in page), 0.0]
    links = [0.0, *(b.links for b in page), 0.0]
    return np.array([[words[i + 1], links[i + 1], words[i], links[i], words[i + 2], links[i + 2], b.article, framed, b.chrome, b.bad, b.good, b.heading] for i, b in enumerate(page)], float).reshape(-1, len(FEATURES))


#: The labelled table: pages as rows of blocks, fixed values. A block is + (main text) or -, then what its place says
#: (a: article, c: chrome, b: bad name, g: good name, h: heading), words, /linked words, x how many of it in a row.
PAGES = """
-c1/1x7 -b8 +ah7 +a30 +a64 +a18 +a2 +a110 +a9 +a27 +a5 +a1 -c5 -c3
-c1/1x6 -c2/2x4 -b14 +ah4 +a45 +a22/3 +a7 +a80 +a3x4 +a12 +a140/4 -ac4 -ac3/3x3 -ab2 -ab16 -ab31 -ab4/4 -c2/2x5 -c9
-c3 -c1/1x8 +ah11 +a3/2 +a95 +ah3 +a6 +a1 +a50 +a14 +a300/6 +a2 -ab24 -ab60 -ab11 -b5/5x4 -b18 -c20 -c40
-c1/1x5 -30 -5/5x4 +a4 +a60 +a8 +a15 +a10/10 +a42 +a1/1 +a7 +a3/3 +a2 +a60/60 +a33/9 -ah3/3 -a4/4x5 -c1/1x6 -c35 -12 -50 -2
-c2/2x6 -b45 -b5 +ah2 +a1 +a3 +a5 +a11 +a2 +a21 +a1 -ac60 -ac1 -ac15/2 -acb12 -acb70 -cb30 -cb4/4 -b90 -c80
-b1/1x6 -b6 +ga6 +ga70 +ga4 +ga24/2 +gah5 +ga1 -gac7 -gab22 -gab48 -g12 -g3/3x4 -g40 -6/6x3 -c6
-1/1x6 -2/2x3 +h6 +60 +85/4 +35 +24 +9 +120/12 +18 +300/4 +5 +40 -4/4x6 -9/9x2 -7
-1/1x9 -3 +h9 +40 +8 +70 +33/3 +3 +55 -h2 -5/5x5 -12/12 -b11 -b34 -c6 -c3/3x4
-c1/1x5 +h4 +25 +48 +16/2 +90 +7 +60 -c2/2x4 -c30 -b26 -b3/3x5
-c1/1x6 +gh5 +g12 +g60 +g3 +g25/5 +g2 +g140 +gh3 +g6 +g1 -gb9 -gb40 -gc20 -gc2/2x4 -g3/3x5 -b8/7x4 -c12
-b1/1x5 -2 +gh7 +g34 +g4 +g300/9 +g45/2 +g8 +g19 -gb4 -gb28 -gb3/3x3 -cb18 -c5 -6
-1/1x7 -8 -5 -4/4x3 -2/2x6 -6 -9 -3/3x4
-c1/1x8 -3 -12/12x5 -6/6x4 -c7
+90 +60
+30
+h3 +50
+a1/1
-c1/1x4 +ah3 +a2/2 -c1/1x4
"""


#: Blocks by what their place says, fixed values. First, surroundings: words, links, words before, links before, words after, links after.
SURROUNDINGS = """
1 0 0 0 60 0
1 0 45 0 1 0
2 0 2 1 30 0
4 0 80 0 3 0
6 0 8 0 60 0
9 0 12 0 9 0
12 1 80 0 50 0
2 1 1 1 1 1
15 0.2 60 0 20 0
25 0 6 0 0 0
40 0 1 1 12 0.1
60 0 60 0 45 0
90 0.05 40 0 10 0.2
300 0.02 80 0 300 0
6 0.6 70 0 8 1
30 0.8 9 0.9 25 0.7
3 1 40 0 20 0
1 1 0 0 1 0
"""
#: Second, places: article, framed, chrome, bad, good; main text or not, in any surroundings.
PLACES = """
1 1 0 0 0 1
1 1 0 0 1 1
1 1 1 0 0 0
1 1 0 1 0 0
1 1 1 1 0 0
0 1 0 0 0 0
0 1 1 0 0 0
0 1 0 1 0 0
0 1 0 0 1 0
0 0 1 0 0 0
0 0 0 1 0 0
0 0 1 1 0 0
0 0 0 1 1 0
1 0 1 0 0 0
1 0 0 1 0 0
"""
#: Third, blocks where no place says anything: surroundings, good, heading; main text or not.
UNPLACED = """
60 0 4 0 80 0 0 0 1
80 0.05 60 0 10 0 0 0 1
35 0 80 0 50 0.1 0 0 1
25 0 35 0 40 0 0 0 1
18 0.1 60 0 45 0 0 0 1
300 0.02 80 0 12 0 0 0 1
120 0.1 5 1 6 1 0 0 1
40 0.2 9 0 7 0 0 0 1
22 0 5 1 4 1 0 0 1
3 0 60 0 80 0 0 0 1
1 0 45 0 60 0 0 0 1
8 0 50 0 30 0 0 0 1
5 0 2 1 60 0 0 1 1
7 0 60 0 45 0 0 1 1
4 0 0 0 30 0 0 1 1
4 0 3 0.8 2 1 0 1 0
2 1 3 1 2 1 0 0 0
5 1 60 0 4 1 0 0 0
9 0.9 50 0 9 0.9 0 0 0
30 0.8 9 0.9 25 0.7 0 0 0
12 1 60 0 50 0 0 0 0
60 0.7 60 0 60 0 0 0 0
6 0 2 1 3 1 0 0 0
8 0 70 0 0 0 0 0 0
11 0 30 0.8 0 0 0 0 0
5 0 3 1 7 0 0 0 0
9 0 6 0 5 0 0 0 0
4 0 0 0 3 1 0 0 0
12 0 40 0 6 0 1 0 1
4 0 12 0 0 0 1 0 1
2 0 0 0 3 0 1 0 1
60 0 3 1 40 0 1 0 1
300 0 3 1 0 0 1 0 1
25 0.2 30 0 2 0 1 0 1
6 0 3 1 50 0 1 1 1
3 1 50 0 4 1 1 0 0
10 1 12 1 9 1 1 0 0
30 0.8 9 0.9 25 0.7 1 0 0
"""


def page_rows() -> np.ndarray:
    """FEATURES of the blocks of PAGES and whether they are main text."""
    rows = []
    for line in PAGES.strip().splitlines():
        page, main = [], []
        for label, place, words, linked, times in re.findall(r"([+-])([a-z]*?)(\d+)(?:/(\d+))?(?:x(\d+))?(?:\s|$)", line):
            for _ in range(int(times or 1)):
                page.append(Block("", int(words), int(linked or 0), *(x in place for x in "acbgh")))
                main.append(label == "+")
        rows.append(np.column_stack([features(page), main]))
    return np.concatenate(rows).astype(float)


def labelled() -> np.ndarray:
    """FEATURES of blocks by what their place says, and whether they are main text: a block of links among such isn't, in any place."""
    read = lambda table: [[float(v) for v in x.split()] for x in table.strip().splitlines()]
    menu = lambda around: around[1] > 0.77 and max(around[3], around[5]) > 0.5
    rows = [[*around, *place, heading, main and not menu(around)] for *place, main in read(PLACES) for around in read(SURROUNDINGS) for heading in (0.0, 1.0)]
    return np.array(rows + [[*around, 0, 0, 0, 0, good, heading, main] for *around, good, heading, main in read(UNPLACED)])


@dataclass
class Leaf:
    main: bool
    rows: int = 0  # those of the table that it has, if all are alike


@dataclass
class Split:
    feature: int
    limit: float
    low: Leaf | Split
    high: Leaf | Split


def _gini(y: np.ndarray) -> float:
    p = y.mean()
    return 2 * p * (1 - p)


def grow(x: np.ndarray, y: np.ndarray, depth: int = 12) -> Leaf | Split:
    """A classification tree by least Gini impurity; of equal splits the first feature, then the lowest limit."""
    if depth == 0 or y.min() == y.max():
        return Leaf(bool(2 * y.sum() > len(y)), len(y) if y.min() == y.max() else 0)
    best: tuple[float, int, float] | None = None
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for limit in (values[:-1] + values[1:]) / 2:
            low = x[:, f] <= limit
            cost = (low.sum() * _gini(y[low]) + (~low).sum() * _gini(y[~low])) / len(y)
            if best is None or cost < best[0] - 1e-12:
                best = cost, f, float(limit)
    if best is None:
        return Leaf(bool(2 * y.sum() > len(y)))
    low = x[:, best[1]] <= best[2]
    return Split(best[1], best[2], grow(x[low], y[low], depth - 1), grow(x[~low], y[~low], depth - 1))


def train() -> Leaf | Split:
    """The tree: a few questions about the text, grown on the pages; where they don't settle it, all questions."""
    pages, rows = page_rows(), labelled()
    below = grow(rows[:, :-1], rows[:, -1].astype(int))

    def settled(node: Leaf | Split) -> Leaf | Split:
        if isinstance(node, Split):
            return Split(node.feature, node.limit, settled(node.low), settled(node.high))
        return node if node.rows >= SETTLED else below

    return settled(grow(pages[:, :TEXT_FEATURES], pages[:, -1].astype(int), TEXT_DEPTH))


def path(tree: Leaf | Split, row: np.ndarray) -> list[str]:
    """The features that decide a row, in order."""
    found = []
    while isinstance(tree, Split):
        found.append(FEATURES[tree.feature])
        tree = tree.low if row[tree.feature] <= tree.limit else tree.high
    return found


def classify(tree: Leaf | Split, row: np.ndarray) -> bool:
    while isinstance(tree, Split):
        tree = tree.low if row[tree.feature] <= tree.limit else tree.high
    return tree.main


def main_text(html: str | None, tree: Leaf | Split) -> str:
    page = blocks(html or "")
    if not page:
        return ""
    rows = features(page).tolist()
    return "\n\n".join(b.text for b, row in zip(page, rows, strict=True) if classify(tree, row))


EXTRACTED = "page_id long, url string, text string, n_chars long"


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of pages (page_id, url, html).

    Null, empty and text-free html give an empty text of 0 characters. Tags and
    comments that never end take the rest of the page, as browsers have it.
    Repeated rows stay; other columns aren't read; an empty table gives an
    empty result. Time and memory are in proportion to a page's length.
    """
    tree = train()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x, tree) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), batch.column(1).cast(pa.string()), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    return map_arrow(pages.select("page_id", "url", "html"), run, EXTRACTED)
