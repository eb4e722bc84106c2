"""Main text of web pages by composite text density.

A page is parsed into a DOM. Elements that are no article text by their tag or
by the words of their class and id (menus, sidebars, adverts, notices, forms,
comments, scripts) are left out; where such a word is only part of a class, or
may name a section of a text, the element is kept if it is text-dense, and a
heading is always kept. For every other node the composite density is
its characters per tag, adjusted for links:

    density = C/T * log(C/LC * T/LT) / log(C/nLC * LC + bLC/bC * C + e)

with C characters, T tags, LC and LT those inside links, nLC = C - LC, and b
for the body. The node whose children's densities sum highest is the core (an
inline one stands for its block). The least density on the path from the core
to the body is the threshold: every node that reaches it gives the subtree
with the highest sum below it. Headings that lead to the core, and short
paragraphs among or like chosen ones are added.

``article`` and ``main`` elements are features. The core is sought in one that
has over half the page's unlinked characters. Where one holds the core, what
is outside is left out, and beside the path from the core to it only blocks
below the threshold that are menus (several links and hardly other text) are.

Defined results: a null or empty page, or one without text, gives an empty
text; unclosed elements end with their parents; a cut-off page ends all of
them; repeated rows are extracted row by row.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import whole

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup.
RAW = frozenset("script style textarea title noscript iframe noembed noframes template xmp".split())
BLOCK = frozenset(
    "html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4"
    " h5 h6 header hgroup hr li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Words that mark even an ``article`` or ``main`` element.
SIDE = frozenset("ad ads advert advertisement sponsored promo comment comments reply related teaser".split())
#: Never part of an article.
DROPPED = frozenset("head nav footer aside form button select option input svg canvas object audio video map menu dialog".split()) | RAW
#: Words of class or id that mark what is no article text.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu breadcrumb"
    " breadcrumbs sidebar sidenav aside footer masthead cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe"
    " subscription signup login search share sharing social related recommended widget pagination pager comment comments commentlist reply"
    " replies respond disqus discussion alert copyright legal disclaimer toolbar skip tags".split()
)
#: Marks that may as well name a section of a text.
TITLES = frozenset(
    "adv advertising navigation menu notice notices alert search sharing share social related recommended discussion"
    " copyright legal disclaimer tags login signup subscription subscribe promotion banner skip modal overlay widget toolbar".split()
)
#: A marked element is text-dense from so many characters, so many of them a tag, and up to this share in links.
DENSE_CHARS, DENSE_TAG, DENSE_LINKS = 80, 20, 0.3
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
WHOLE = frozenset("article main".split())
PARAGRAPHS = frozenset("p pre blockquote ul ol dl table".split())
#: A menu has so many links or more, and over this share of its characters in them.
MENU_LINKS, MENU_SHARE = 3, 0.8
#: What an open element is closed by.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
BARRIER = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:=\s*(?:"[^"]*"|'[^']*'|[^\s>"'][^\s>]*+)|[^>])*+)(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""([^\s/>=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]*))?""")
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Node:
    __slots__ = ("tag", "parent", "items", "drop", "chars", "tags", "link_chars", "link_tags", "density", "sum", "best", "heading", "maybe")

    def __init__(self, tag: str, parent: Node | None, drop: bool = False, maybe: bool = False):
        self.tag, self.parent, self.drop, self.maybe = tag, parent, drop, maybe
        self.items: list[Node | str] = []


def _marked(attributes: str, marks: frozenset, inside: bool, heading: bool) -> tuple[bool, bool]:
    """Whether an element is no article text, and whether it may be none (then
    its density decides). An id inside an article names a section of it."""
    maybe = False
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "role" and value in ROLES:
            return True, False
        if name in ("class", "id") and (words := {w.lower() for w in WORDS.findall(value)}) & marks and not words & {"no", "without", "with", "has"}:
            if (name == "class" or not inside) and not heading and {t.lower() for t in value.split()} & (marks if marks is SIDE else marks - TITLES):
                return True, False
            maybe = True
    return False, maybe


def parse(page: str) -> Node:
    root = Node("html", None)
    stack, at = [root], 0
    body = None

    def close(tags: frozenset | set, barrier: set | frozenset = frozenset()) -> None:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in tags:
                del stack[k:]
                return
            if stack[k].tag in barrier:
                return

    def text(piece: str) -> None:
        if piece:
            stack[-1].items.append(entities.unescape(piece) if "&" in piece else piece)

    while at < len(page):
        m = TOKEN.search(page, at)
        if not m:
            text(page[at:])
            break
        text(page[at : m.start()])
        at, tag = m.end(), (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            if tag == "br" or tag == "p" and not any(n.tag == "p" for n in stack):
                stack[-1].items.append(Node(tag, stack[-1]))
            elif tag not in ("html", "body"):
                close({tag}, WHOLE if tag not in BLOCK else frozenset())
            continue
        if tag in ("html", "body"):
            if tag == "body":
                close({"head"})
                body = body or stack[-1]
            continue
        if tag in BLOCK:
            close({"p"}, frozenset(("td", "th", "article", "main", "section", "div", "li", "blockquote")))
            if tag in HEADINGS and stack[-1].tag in HEADINGS:
                stack.pop()
        if tag in CLOSES:
            close(CLOSES[tag], BARRIER[tag])
        drop, maybe = _marked(m[3], SIDE if tag in WHOLE else MARKS, any(n.tag in WHOLE for n in stack), tag in HEADINGS)
        node = Node(tag, stack[-1], drop or tag in DROPPED, maybe and tag not in HEADINGS)
        stack[-1].items.append(node)
        if tag in VOID or m[3].endswith("/") and tag not in BLOCK:
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(page, at)
            if not end:
                break
            at = page.find(">", end.start()) + 1 or len(page)
            continue
        stack.append(node)
    return root


def _order(root: Node) -> list[Node]:
    """All nodes, parents first."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo += [x for x in reversed(node.items) if isinstance(x, Node)]
    return out


def _count(node: Node) -> None:
    """Characters and tags of a node, those in links too, from its children's."""
    kids = [x for x in node.items if isinstance(x, Node) and not x.drop]
    node.chars = sum(len("".join(x.split())) for x in node.items if isinstance(x, str)) + sum(k.chars for k in kids)
    node.tags = len(kids) + sum(k.tags for k in kids)
    link = node.tag == "a"
    node.link_chars = node.chars if link else sum(k.link_chars for k in kids)
    node.link_tags = node.tags + 1 if link else sum(k.link_tags for k in kids)


def _dense(node: Node) -> bool:
    return node.chars >= max(DENSE_CHARS, DENSE_TAG * node.tags) and node.link_chars <= DENSE_LINKS * node.chars


def _prune(root: Node) -> list[Node]:
    order = _order(root)
    for node in order:
        node.heading = node.tag == "h1" or node.tag in WHOLE
    for node in reversed(order):
        _count(node)
        if node.maybe and not _dense(node):
            node.drop = True
        # marks do not take away what holds an article, nor does a form around the page
        if node.drop and node.heading and node.tag not in WHOLE and (node.tag == "form" or node.tag not in DROPPED):
            node.drop = False
        # a page's header is no article text, an article's own is
        if node.tag == "header" and not _within(node.parent) and not any(x.tag in WHOLE for x in _order(node)):
            node.drop = True
        if node.parent and not node.drop:
            node.parent.heading |= node.heading
    for node in order:
        node.items = [x for x in node.items if not (isinstance(x, Node) and x.drop)]
    return _order(root)


def _within(node: Node | None) -> Node | None:
    while node and node.tag not in WHOLE:
        node = node.parent
    return node


def _densities(order: list[Node]) -> None:
    for node in reversed(order):
        _count(node)
    body = order[0]
    share = body.link_chars / body.chars if body.chars else 0
    for node in reversed(order):
        kids = [x for x in node.items if isinstance(x, Node)]
        c, t, lc, lt = node.chars, max(node.tags, 1), node.link_chars, max(node.link_tags, 1)
        if c:
            base = math.log(c / max(c - lc, 1) * lc + share * c + math.e)
            node.density = c / t * max(math.log(max(c / max(lc, 1) * t / lt, 1)), 0) / base
        else:
            node.density = 0.0
        node.sum = sum(k.density for k in kids) or node.density
        node.best = max([node, *(k.best for k in kids)], key=lambda n: n.sum)


def _path(node: Node) -> list[Node]:
    out = [node]
    while out[-1].parent:
        out.append(out[-1].parent)
    return out


def _menu(node: Node) -> bool:
    """Several links and hardly any text beside them."""
    return node.link_tags >= MENU_LINKS and node.link_chars > MENU_SHARE * node.chars


def _home(body: Node) -> Node:
    """The outermost ``article`` or ``main`` with over half the page's unlinked characters, else the body."""
    todo = [body]
    while todo:
        node = todo.pop()
        kids = [x for x in node.items if isinstance(x, Node) and 2 * (x.chars - x.link_chars) > body.chars - body.link_chars]
        if node.tag in WHOLE:
            return node
        todo += kids
    return body


def _content(order: list[Node]) -> list[Node]:
    """The subtrees that make up the text, in page order, none inside another."""
    core = _home(order[0]).best
    while core.parent and core.tag not in BLOCK:
        core = core.parent
    path = _path(core)
    threshold = min(n.density for n in path)
    bounds = [k for k, n in enumerate(path) if n.tag in WHOLE]
    if bounds:
        inner = path[: bounds[-1] + 1]
        for below, above in zip(inner, inner[1:]):
            above.items = [x for x in above.items if isinstance(x, str) or x is below or x.density >= threshold or not _menu(x)]
        return [inner[-1]]
    chosen = {id(core)}
    for node in order:
        if node.density >= threshold and node.density > 0:
            chosen.add(id(node.best))
    for below, above in zip(path, path[1:]):
        for x in above.items:
            if x is below:
                break
            if isinstance(x, Node) and x.tag in HEADINGS:
                chosen.add(id(x))
    # short paragraphs and headings among chosen ones
    for node in order:
        kids = [x for x in node.items if isinstance(x, Node)]
        at = [k for k, x in enumerate(kids) if id(x) in chosen]
        alike = {kids[k].tag for k in at} & PARAGRAPHS
        chosen |= {id(x) for k, x in enumerate(kids) if at and (at[0] < k < at[-1] or x.tag in alike) and not _menu(x)}
    out: list[Node] = []
    inside: set[int] = set()
    for node in order:
        if id(node) in chosen or node.parent and id(node.parent) in inside:
            if not (node.parent and id(node.parent) in inside):
                out.append(node)
            inside.add(id(node))
    return out


def _blocks(top: Node) -> list[str]:
    blocks: list[str] = []
    run: list[str] = []

    def flush() -> None:
        if text := " ".join("".join(run).split()):
            blocks.append(text)
        run.clear()

    todo: list = [top]
    while todo:
        x = todo.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            run.append(x)
        elif x.tag == "br":
            run.append(" ")
        elif x.tag in BLOCK:
            flush()
            todo.append(None)
            todo += reversed(x.items)
        else:
            todo += reversed(x.items)
    flush()
    return blocks


def main_text(page: str | None) -> str:
    if not page:
        return ""
    order = _prune(parse(page))
    _densities(order)
    return "\n\n".join(b for node in _content(order) for b in _blocks(node))


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` as ``row`` with the main text of each."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(p) for p in batch], dtype=object)

    return pages.select(whole(pages, (html_col.lower(),)), F.pandas_udf(run, "string")(F.col(html_col)).alias("text"))


def digest(pages: DataFrame) -> DataFrame:
    return extract(pages.select("page_id", "url", "html")).select("row.page_id", "row.url", "text", F.length("text").cast("long").alias("n_chars"))
