"""Main text of web pages: flat text blocks, classified by a decision tree.

A page is cut into blocks at block-level tags. A block's features are its number of words and link
density, those of the blocks before and after it, and what its place in the markup says: elements and
class names it stands in, whether it is a heading or a list item. The tree is trained on the blocks of the
labelled pages in ``html_pages``, a fixed table of a few hundred rows. Blocks taken for the article are
joined in page order.

Markup is read as browsers do as far as text is concerned: comments, declarations and the content of
scripts, styles and the like are skipped to their end or the page's, quoted attributes may hold ``>``, a tag cut off
by the end of the page is no text, end tags may be missing, and ``<`` before anything but a tag is text.

Defined results: a null or empty page has the empty text; text of any length is read whole; repeated rows get equal
texts; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import functools
import re
from bisect import bisect_right
from dataclasses import dataclass
from html import unescape

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from arenalake.llm.html_pages import LABELLED_PAGES
from arenalake.llm.tree import Tree, fit_tree

# A tag, with attributes whose quoted values may hold ">".
TAG = re.compile(
    r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+|["'])*+)>"""
)
ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>"']++)))?+""")
COMMENT_END = re.compile(r"--!?>")
TOKEN = re.compile(r"[a-z]+")

#: Elements whose content is no text, or no text of the page, up to their end tag.
RAW = frozenset("script style xmp iframe noembed noframes title textarea".split())
SKIPPED = frozenset("noscript template svg math object canvas audio video select button datalist dialog".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Tags that do not end a block.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s "
    "samp small span strike strong sub sup time tt u var wbr".split()
)
#: Elements that other blocks stand in, and whose end tags are therefore matched.
CONTAINERS = frozenset(
    "article main section div nav header footer aside form fieldset ul ol menu dl table blockquote figure details body".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CHROME_TAGS = frozenset("nav aside form menu".split())
CHROME_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar status tablist".split()
)
#: Words of class names and ids that mark what is not the article.
CHROME_WORDS = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar sidenav rail aside ad ads adbox advert adverts "
    "advertisement advertisements adslot banner promo promotion sponsor sponsored sponsors cookie cookies consent gdpr "
    "notice notices notification alert popup modal overlay newsletter subscribe subscription signup share sharing "
    "social follow related recommended recommendations trending popular comment comments commentlist disqus reply "
    "replies respond discussion login signin register search searchbox widget widgets pager pagination paging toolbar "
    "masthead topbar copyright legal disclaimer skip hidden outbrain taboola teaser teasers tags".split()
)
HEADER_WORDS = frozenset("header head byline meta dateline author".split())
FOOTER_WORDS = frozenset("footer foot bottom colophon".split())
MAIN_WORDS = frozenset("article content post entry story main".split())
#: Endings by which compound names such as "cookiebar" are known.
CHROME_STEMS = ("cookie", "sidebar", "advert", "comment", "newsletter", "breadcrumb", "banner", "sponsor", "subscribe")


@dataclass
class Place:
    """What an open element adds to the blocks in it."""

    name: str
    main: bool = False
    chrome: bool = False
    header: bool = False
    footer: bool = False
    listed: bool = False


@dataclass
class Block:
    """A block's place in the page, text, words, words in links, and what its place in the markup says."""

    at: int
    text: str
    words: int
    linked: int
    marks: tuple  # in the article, in what is not, in the article's header or footer, in a list, a heading


def place_of(name: str, attributes: str) -> Place:
    place = Place(name, main=name in ("article", "main"), chrome=name in CHROME_TAGS, listed=name in ("ul", "ol", "dl"))
    place.header, place.footer = name == "header", name == "footer"
    if not attributes.strip():
        return place
    named: set[str] = set()
    for key, *values in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), next((v for v in values if v), "")
        if key in ("class", "id"):
            for word in TOKEN.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", unescape(value)).lower()):
                named.add(word)
                place.chrome |= word.startswith(CHROME_STEMS)
        elif key == "role":
            role = value.lower().strip()
            place.main |= role in ("main", "article")
            place.chrome |= role in CHROME_ROLES
        elif key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
            place.chrome = True
        elif key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value.lower()):
            place.chrome = True
    if name != "body":
        place.chrome |= bool(named & CHROME_WORDS)
        place.header |= bool(named & HEADER_WORDS)
        place.footer |= bool(named & FOOTER_WORDS)
        place.main |= bool(named & MAIN_WORDS) and not (place.chrome or place.header or place.footer)
    return place


def text_blocks(html: str) -> list[Block]:
    """The blocks of a page in order, without empty ones."""
    blocks: list[Block] = []
    open_places: list[Place] = []
    own: Place | None = None  # the block's own tag, such as a paragraph with a class
    item = ""  # heading, list item or cell that the block is in
    pieces: list[str] = []
    links: list[str] = []
    in_link = 0
    begin = 0

    def marks() -> tuple:
        places = open_places if own is None else [*open_places, own]
        main = edge = chrome = listed = False
        for p in places:
            if p.main:
                main, listed = True, False
            edge |= main and (p.header or p.footer)
            chrome |= p.chrome or not main and (p.header or p.footer)
            listed |= p.listed
        return main, chrome, edge, listed, item in HEADINGS

    def end_block() -> None:
        nonlocal pieces, links
        if pieces:
            words = unescape("".join(pieces)).split()
            if words:
                linked = len(unescape("".join(links)).split())
                blocks.append(Block(begin, " ".join(words), len(words), linked, marks()))
        pieces, links = [], []

    def add(start: int, end: int) -> None:
        nonlocal begin
        if start < end:
            if not pieces:
                begin = start
            pieces.append(html[start:end])
            if in_link:
                links.append(html[start:end])

    at, size, text_from = 0, len(html), 0
    while True:
        at = html.find("<", at)
        if at < 0 or at + 1 >= size:
            break
        follow = html[at + 1]
        if follow in "!?" or (follow == "/" and not html[at + 2 : at + 3].isalpha()):
            if follow == "/" and at + 2 >= size:
                break
            add(text_from, at)
            if html.startswith("<!--", at):
                if html.startswith((">", "->"), at + 4):
                    end = html.index(">", at) + 1
                else:
                    close = COMMENT_END.search(html, at + 4)
                    end = close.end() if close else size
            else:
                end = html.find(">", at) + 1 or size
            at = text_from = end
            continue
        if not (follow == "/" or (follow.isascii() and follow.isalpha())):
            at += 1  # a plain "<"
            continue
        tag = TAG.match(html, at)
        add(text_from, at)
        if tag is None:  # cut off
            text_from = size
            break
        closing, name = tag[1], tag[2].lower()
        at = text_from = tag.end()
        if name in INLINE:
            if name == "br":
                pieces.append(" ")
                links.append(" ")
            elif name == "a":
                in_link = 0 if closing else 1
            continue
        if name in RAW or name in SKIPPED:
            if closing or tag[3].endswith("/") and name in ("svg", "math"):
                continue
            at = text_from = skipped(html, at, name)
            if name not in ("button", "select", "svg", "math", "noscript", "script"):
                end_block()
            continue
        end_block()
        own, in_link = None, 0
        if name in CONTAINERS:
            item = ""
            if closing:
                for k in range(len(open_places) - 1, -1, -1):
                    if open_places[k].name == name:
                        del open_places[k:]
                        break
            else:
                open_places.append(place_of(name, tag[3]))
        elif closing or name in VOID:
            item = ""
        else:
            item = name
            own = place_of(name, tag[3]) if tag[3] else None
            if own:
                own.main = False  # a block alone is no article
    add(text_from, size)
    end_block()
    return blocks


def skipped(html: str, at: int, name: str) -> int:
    """Where the content of a skipped element ends; elements of one name may be nested but in raw text."""
    edge = _edges(name)
    depth = 1
    while found := edge.search(html, at):
        at = found.end()
        if found[1]:
            depth -= 1
        elif name not in RAW:
            depth += 1
        if not depth:
            return html.find(">", at) + 1 or len(html)
    return len(html)


@functools.lru_cache(None)
def _edges(name: str) -> re.Pattern:
    return re.compile(rf"<(/?){name}(?=[\s/>])", re.IGNORECASE)


def features(pages: list[list[Block]]) -> np.ndarray:
    """A row for each block of all pages.

    The columns are words and link density of the block, of the one before and of the one behind it, then its
    standing (4 in an article, 3 in an article's header or footer, 2 on a page without an article, 1 beside
    one, 0 in what is not article), and whether it is in a list, a heading or a copyright line.
    """
    rows = []
    for blocks in pages:
        own = [(b.words, b.linked / b.words) for b in blocks]
        beside = 1 if any(b.marks[0] and not b.marks[1] for b in blocks) else 2
        around = [(0, 0.0), *own, (0, 0.0)]
        for k, b in enumerate(blocks):
            main, chrome, edge, listed, heading = b.marks
            standing = 0 if chrome else beside if not main else 3 if edge else 4
            legal = b.text.startswith(("©", "Copyright", "(c)"))
            rows.append((*around[k + 1], *around[k], *around[k + 2], standing, listed, heading, legal))
    return np.array(rows, float).reshape(-1, 10)


def labelled_blocks(pages: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the blocks of labelled pages: lines that begin with ``+`` (article) or ``-``."""
    def filled(fragment: str) -> str:
        return re.sub(r"\{(\d+)\}", lambda m: " ".join(["word"] * int(m[1])) + ("." if int(m[1]) > 4 else ""), fragment)

    x, y = [], []
    for page in pages:
        lines = [(line[0] == "+", filled(line[2:])) for line in page.strip().split("\n")]
        starts = np.cumsum([0, *(len(text) + 1 for _, text in lines)]).tolist()
        blocks = text_blocks("\n".join(text for _, text in lines))
        x.append(features([blocks]))
        y += [lines[bisect_right(starts, b.at) - 1][0] for b in blocks]
    return np.vstack(x), np.array(y, np.int64)


@functools.lru_cache(1)
def default_tree() -> Tree:
    return fit_tree(*labelled_blocks(LABELLED_PAGES))


def article_texts(pages: list[str | None], tree: Tree) -> list[str]:
    blocks = [text_blocks(html or "") for html in pages]
    sizes = [len(b) for b in blocks]
    verdicts = tree.predict(features(blocks)).tolist() if sum(sizes) else []
    out, at = [], 0
    for own, size in zip(blocks, sizes):
        out.append("\n".join(b.text for b, taken in zip(own, verdicts[at : at + size]) if taken))
        at += size
    return out


def main_text(html: Column, tree: Tree | None = None) -> Column:
    """The main text of a page."""
    model = tree or default_tree()

    @F.pandas_udf("string")
    def extract(pages: pd.Series) -> pd.Series:
        return pd.Series(article_texts(pages.tolist(), model), dtype=object)

    return extract(html)
