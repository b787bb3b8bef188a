"""Main text of web pages: flat text blocks, classified by a decision tree.

A page is cut into flat blocks at block-level tags. A block's features are its
word count and link density, those of the block before and the block after,
and the kind of container it stands in (content, none, or page furniture). A
decision tree trained on the labelled blocks of ``LAYOUTS`` keeps or drops each
block. A container is told by its tag, or by a class, id or role that is such a
name as a whole: ``sidebar`` or ``site-footer``, but not ``has-sidebar`` or
``comments-open``, which say something about the page. Where markup says
nothing, as on pages of plain ``div``, the neighbours decide: a short line
between paragraphs stays, one between links goes. The kept blocks'
texts are joined in page order by one space; inside a block character
references are decoded, white space becomes one space, and ends are trimmed.

The tree has a few nodes and goes with the task; pages are handled one by one,
so the job is one pass without a shuffle.

Defined results: a null page is an empty one and has the empty text; a tag,
comment, script, style, textarea or title cut off by the end of the page ends
there, and a character reference cut off stays as text; a head is no scope, its
end tag may be left out; an unclosed noscript, button, select, object, svg or
the like ends at body or at the end tag of an element around it; a ``<`` that starts no tag is text; repeated
rows give equal results; null keys are kept; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from functools import cache
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentimart.llm.common import text_of

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"""
    r"""|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attributes>(?:[^>"']+|"[^"]*"|'[^']*')*+)(?:>|\Z)"""
    r"""|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attributes2>[^>]*)(?:>|\Z)""", re.DOTALL)
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup "
    "time tt u var wbr img".split())
#: Elements whose whole content is no text of the page.
OPAQUE = frozenset("script style title noscript template svg math iframe object select textarea button datalist".split())
#: Of those, the ones that hold no tags.
RAW = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE) for tag in ("script", "style", "textarea", "title")}
#: Of those, the ones that can stand in one another; and those where titles and the like are no raw text if unclosed.
NESTED, FOREIGN = frozenset("object template svg math".split()), frozenset(("svg", "math"))
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Containers that open no scope of their own in the markup that pages have (often unclosed).
FLAT = frozenset("p br hr h1 h2 h3 h4 h5 h6 li dt dd tr td th tbody thead tfoot option pre blockquote input img meta link head base".split())
FURNITURE_TAGS = frozenset("nav header footer aside form menu dialog".split())
FURNITURE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice "
    "alert nav navbar navigation menu breadcrumb breadcrumbs sidebar footer header masthead toolbar comment comments discussion "
    "replies respond disqus related recommended share sharing social newsletter subscribe subscription signup login search popup "
    "modal overlay widget pagination pager contentinfo complementary".split())
#: Furniture that an article tag inside it does not leave.
DEEP = frozenset("comment comments discussion replies respond disqus related recommended sidebar aside footer form complementary".split())
#: What a name may have beside them: cookie-notice and site-footer are names of furniture, has-sidebar is not.
GLUE = frozenset("site page top bottom left right primary secondary box wrapper wrap container inner outer area section block bar "
                 "list item items links link post posts entry article content main global the".split())
CONTENT_TAGS = frozenset("article main".split())
CONTENT_WORDS = frozenset("article main content post entry story articlebody".split())
CONTENT_GLUE = CONTENT_WORDS | frozenset("body text primary site page inner wrapper wrap container area single".split())
CONTENT, NEUTRAL, FURNITURE = 1, 0, -1


class Block(NamedTuple):
    text: str
    words: int
    link_density: float
    container: int


def blocks(page: str) -> list[Block]:
    """The flat text blocks of a page, in order, empty ones left out."""
    out: list[Block] = []
    pieces: list[str] = []
    linked: list[str] = []
    scopes: list[tuple[str, int, bool]] = [("", NEUTRAL, False)]  # tag, container, deep
    in_link = False
    opaque, at = "", 0
    inside: Counter = Counter()  # elements open in the opaque one, also as a list; FLAT ones open around it; RAW ones that no end tag follows
    inner: list[str] = []
    around: Counter = Counter()
    open_scopes: Counter = Counter()  # tags in scopes, so that an end tag without a start costs nothing
    endless: set[str] = set()

    def flush() -> None:
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                n = len(text.split())
                m = len(html.unescape("".join(linked)).split())
                out.append(Block(text, n, min(1.0, m / n), scopes[-1][1]))
            pieces.clear()
            linked.clear()

    def say(text: str) -> None:
        if text and not opaque:
            pieces.append(text)
            if in_link:
                linked.append(text)

    while m := TOKEN.search(page, at):
        say(page[at:m.start()])
        at = m.end()
        tag = (m["tag"] or m["tag2"] or "").lower()
        if not tag:
            continue
        end = bool(m["end"] or m["end2"])
        empty = (m["attributes"] or "").endswith("/")
        if tag in RAW and not end and not empty:
            close = None if tag in endless else RAW[tag].search(page, at)
            if close:
                flush()
                at = close.start()
                continue
            endless.add(tag)
            if opaque not in FOREIGN:
                at = len(page)
                break
        if opaque:
            if not end:
                if tag != "body":
                    if tag == opaque and tag not in NESTED:
                        inside.clear()
                        inner.clear()
                    elif not empty and tag not in VOID:
                        inside[tag] += 1
                        inner.append(tag)
                    continue
            elif inside[tag]:
                while True:
                    inside[last := inner.pop()] -= 1
                    if last == tag:
                        break
                continue
            elif tag == opaque:
                opaque = ""
                continue
            elif tag not in ("body", "html", "head") and not around[tag] and not open_scopes[tag]:
                continue
            opaque = ""
        if tag in FLAT and tag not in VOID:
            around[tag] = max(0, around[tag] - 1) if end else around[tag] + 1
        if tag in OPAQUE:
            flush()
            if not end and not empty:
                opaque = tag
                inside.clear()
                inner.clear()
        elif tag == "br":
            say(" ")
        elif tag == "a":
            in_link = not end
            say("")
        elif tag not in INLINE:
            flush()
            in_link = False
            if tag == "body":
                scopes[1:] = []
                open_scopes.clear()
            elif tag in FLAT:
                pass
            elif end:
                while open_scopes[tag]:
                    open_scopes[last := scopes.pop()[0]] -= 1
                    if last == tag:
                        break
            else:
                scopes.append(_scope(tag, m["attributes"] or m["attributes2"] or "", scopes))
                open_scopes[tag] += 1
    if not opaque:
        say(page[at:])
    flush()
    return out


def _parts(name: str) -> frozenset[str]:
    return frozenset(w for w in re.split(r"[-_:]+", name) if w)


def _scope(tag: str, attributes: str, scopes: list[tuple[str, int, bool]]) -> tuple[str, int, bool]:
    container, deep = scopes[-1][1:]
    names = [_parts(n) for m in NAMES.finditer(attributes) for n in (m[1] or m[2] or m[3] or "").lower().split()]
    own = {w for parts in names if parts <= FURNITURE_WORDS | GLUE for w in parts & FURNITURE_WORDS}
    if tag in FURNITURE_TAGS and not (tag == "header" and container == CONTENT):
        own = own | {tag}
    if own:
        return tag, FURNITURE, deep or bool(own & DEEP)
    named = any(parts & CONTENT_WORDS and parts <= CONTENT_GLUE for parts in names)
    if (tag in CONTENT_TAGS or named) and not deep and (container != FURNITURE or tag in CONTENT_TAGS):
        return tag, CONTENT, False
    return tag, container, deep


#: Where the tree may cut: coarsely, so that it learns kinds of blocks and not the sizes in its table.
WORD_CUTS, DENSITY_CUTS = (0.5, 4.5, 14.5), (0.6,)
CUTS = (WORD_CUTS, DENSITY_CUTS, WORD_CUTS, DENSITY_CUTS, WORD_CUTS, DENSITY_CUTS, (-0.5, 0.5))
FEATURES = ("words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after", "container")


def features(found: list[Block]) -> list[tuple[float, ...]]:
    none = Block("", 0, 0.0, NEUTRAL)
    out = []
    for i, b in enumerate(found):
        before = found[i - 1] if i else none
        after = found[i + 1] if i + 1 < len(found) else none
        out.append((b.words, b.link_density, before.words, before.link_density, after.words, after.link_density, b.container))
    return out


# The labelled table: pages as lists of (markup, words, label), one block each; % stands for the words.
_NAV = [("<nav><ul><li><a>%</a></li>", 1, 0)] + [("<li><a>%</a></li>", 1, 0)] * 3 + [("<li><a>%</a></li></ul></nav>", 2, 0)]
_LINKS = [("<div><a>%</a></div>", 1, 0), ("<div><a>%</a></div>", 3, 0), ("<div><a>%</a></div>", 2, 0), ("<div><a>%</a></div>", 5, 0)]
_BODY = [("<p>%</p>", 45, 1), ("<p>%</p>", 6, 1), ("<p>%</p>", 80, 1), ("<p>%</p>", 1, 1), ("<p>%<a>x y</a></p>", 22, 1)]
_ARTICLE = [("<article><h1>%</h1>", 7, 1), *_BODY, ("<p><a>%</a></p>", 12, 1), ("<p>%</p></article>", 30, 1)]
_FOOT = [("<footer>%</footer>", 18, 0)]
_FARM = [("<div><a>%</a></div>", n, 0) for n in (40, 24, 9, 34, 14, 17)]

_SIZES = (2, 9, 40)


def _t(words: int, label: int = 1) -> tuple[str, int, int]:
    return "<div>%</div>", words, label


def _a(words: int, label: int) -> tuple[str, int, int]:
    return "<div><a>%</a></div>", words, label


LAYOUTS = (
    [*_NAV, ("<div class='ad'>%</div>", 9, 0), *_ARTICLE, *_FOOT],
    [*_NAV, ("<div class='ad'>%</div>", 60, 0), ("<article><h1>%</h1>", 2, 1), ("<p>%</p></article>", 3, 1), ("<footer>%</footer>", 70, 0)],
    [("<header>%</header>", 4, 0), *_NAV, ("<main><header><h1>%</h1></header>", 9, 1), *_BODY, ("<p>%</p></main>", 25, 1), ("<aside>%</aside>", 40, 0),
     ("<section id='comments'>%", 3, 0), ("<div>%</div>", 35, 0), ("<div>%</div></section>", 12, 0), *_FOOT],
    [("<div class='cookie-notice'>%</div>", 28, 0), *_LINKS, ("<div class='post-content'><h2>%</h2>", 5, 1), *_BODY, ("<p>%</p></div>", 50, 1),
     ("<div class='share'>%</div>", 4, 0), ("<form>%</form>", 14, 0), ("<div class='related'><a>%</a></div>", 8, 0)],
    [("<article><p>%</p>", 30, 1), ("<ul><li><a>%</a></li>", 2, 0), ("<li><a>%</a></li>", 3, 0), ("<li><a>%</a></li></ul>", 2, 0), ("<p>%</p></article>", 41, 1)],
    [("<div>%</div>", 55, 1)], [("<p>%</p>", 7, 1)], [("<article>%</article>", 1, 1)], [("<article><p>%</p>", 1, 1), ("<p>%</p></article>", 1, 1)], [("<nav>%</nav>", 5, 0)],
    [("<div class='sidebar'>%</div>", 65, 0), ("<article>%</article>", 12, 1), ("<div class='comments'><article>%</article></div>", 44, 0)],
    # An article of short lines, linked and plain, among furniture and links.
    [*_NAV, _t(4, 0), *_LINKS, ("<article><h1>%</h1>", 4, 1), *[("<p>%</p>", n, 1) for n in (3, 2, 5, 4, 2, 8, 1, 6, 3, 12, 2)],
     ("<p><a>%</a></p>", 14, 1), ("<p>%</p>", 2, 1), ("<p>%</p></article>", 3, 1), *_LINKS, *_FOOT],
    [*_LINKS, ("<main><h1>%</h1>", 3, 1), ("<div>%</div>", 2, 1), ("<div>%</div>", 4, 1), ("<div>%</div></main>", 2, 1), *_LINKS],
    [("<div class='post-content'><p>%</p>", 3, 1), ("<p>%</p>", 2, 1), ("<p>%</p>", 17, 1), ("<p>%</p></div>", 1, 1), ("<form>%</form>", 3, 0)],
    # Articles of two paragraphs of any size, alone and among links; the same without the tag, if one is long.
    *[[("<article><p>%</p>", a, 1), ("<p>%</p></article>", b, 1)] for a in _SIZES for b in _SIZES],
    *[[*_LINKS, ("<article><p>%</p>", a, 1), ("<p>%</p></article>", b, 1), *_LINKS] for a in _SIZES for b in _SIZES],
    *[[_t(a), _t(40)] for a in _SIZES[1:]], *[[*_LINKS, _t(a), _t(40), *_LINKS] for a in _SIZES],
    # From here on the markup says nothing (div only), and the neighbours decide.
    [*_LINKS, _t(50), _t(26), _t(90), _t(34), *_LINKS, _t(5, 0)],
    [*_LINKS, _t(8), _t(70), _t(14), _t(60), *_LINKS, _t(3, 0)],                           # a heading after links, a line after links
    [*_LINKS, _t(60), _t(3), _t(45), _t(6), _t(80), *_LINKS, _t(6, 0), *_LINKS],           # short lines between paragraphs
    [*_LINKS, _t(40), _t(3), _t(2), _t(4), _t(7), _t(3), _t(55), *_LINKS],                 # talk, a line each
    [_t(2, 0), *_LINKS, _t(4, 0), *_LINKS, _t(9), _t(75), _t(30), _t(4), *_LINKS],         # labels over link lists, a last short line
    [*_LINKS, _t(35), _a(12, 1), _t(48), _a(7, 1), _t(64), *_FARM, _t(8, 0), *_FARM],      # linked paragraphs, then a link farm
    [*_LINKS, _t(7), _t(41), _a(18, 1), _t(36), _t(3), _t(29), _a(25, 1), _t(66), *_FARM],
    [*_FARM, _t(10, 0), *_FARM, _t(8, 0), *_FARM, _t(12), _t(52), _t(33), *_FARM],         # teasers between linked headings
    [_a(27, 0), _a(16, 0), _t(11, 0), _a(31, 0), _t(9, 0), _a(20, 0), _t(5), _t(47), _t(2), _t(39), _a(2, 0), _t(3, 0), _a(4, 0)],
    [*_LINKS, _t(40), _a(15, 1), _t(4), _t(52), _a(8, 1), _t(6), _t(33), _a(10, 1), _t(29), *_LINKS],
    [*_FARM, _t(6), _t(50), _t(7), _t(28), *_FARM, _t(10), _t(70), *_FARM, _t(9, 0), *_FARM],
    [_t(6), _t(58), _t(5), _t(40), *_LINKS, _t(7, 0)],                                     # no links above
    [_t(2, 0), _t(5, 0), *_LINKS, _t(7), _t(60), _t(4), _t(2), _t(38), *_LINKS, _t(5, 0), _t(3, 0)],  # a site's name and its small print
    [_t(3, 0), _t(4, 0), *_FARM, _t(5), _t(44), _t(31), _t(3)],                            # the article ends the page
    [*_LINKS, _t(6), _t(57), _t(49), _t(2), *_FARM, _t(6, 0), _t(2, 0)],
    [*_LINKS, _t(6), _t(24), _t(3), _t(19), *_LINKS, _t(9, 0), *_FARM, _t(3, 0)],
)


#: Each layout also stands for pages whose blocks of 15 words or more have this share of its words.
SCALES = (1.0, 0.7, 1.2, 2.0)


def labelled() -> list[tuple[tuple[float, ...], int]]:
    rows = []
    for scale in SCALES:
        for layout in LAYOUTS:
            found = blocks("".join(markup.replace("%", "w " * (max(15, round(n * scale)) if n >= 15 else n)) for markup, n, _ in layout))
            rows += zip(features(found), [label for _, _, label in layout], strict=True)
    return rows


class Node(NamedTuple):
    feature: int
    cut: float
    low: Node | int
    high: Node | int


def train(rows: list[tuple[tuple[float, ...], int]], depth: int = 14) -> Node | int:
    """A decision tree by Gini impurity; ties go to the earlier feature and cut, leaves to the majority."""
    ones = sum(y for _, y in rows)
    if not depth or ones in (0, len(rows)):
        return int(2 * ones >= len(rows))

    def impurity(part: list) -> float:
        p = sum(y for _, y in part) / len(part)
        return len(part) * p * (1 - p)

    best = None
    for f in range(len(FEATURES)):
        for cut in CUTS[f]:
            low, high = [r for r in rows if r[0][f] <= cut], [r for r in rows if r[0][f] > cut]
            if not low or not high:
                continue
            cost = impurity(low) + impurity(high)
            if best is None or cost < best[0] - 1e-12:
                best = cost, f, cut, low, high
    if best is None:
        return int(2 * ones >= len(rows))
    return Node(best[1], best[2], train(best[3], depth - 1), train(best[4], depth - 1))


@cache
def default_tree() -> Node | int:
    return train(labelled())


def keeps(tree: Node | int, x: tuple[float, ...]) -> bool:
    while isinstance(tree, Node):
        tree = tree.low if x[tree.feature] <= tree.cut else tree.high
    return bool(tree)


def main_text(page: str, tree: Node | int | None = None) -> str:
    tree = default_tree() if tree is None else tree
    found = blocks(page)
    return " ".join(b.text for b, x in zip(found, features(found), strict=True) if keeps(tree, x))


def extracted(pages: DataFrame, tree: Node | int | None = None) -> DataFrame:
    """``(page_id, url, text, n_chars)`` of ``pages(page_id, url, html)``."""
    tree = default_tree() if tree is None else tree

    @F.pandas_udf("string")
    def extract(htmls: pd.Series) -> pd.Series:
        return pd.Series([main_text(h, tree) for h in htmls], dtype=object)

    return pages.select("page_id", "url", extract(text_of("html")).alias("text")).withColumn("n_chars", F.length("text").cast("long"))
