"""Main text of web pages by composite text density.

A tolerant parser builds the tree of block elements. Every node gets a link-adjusted density of
characters per tag:

    density = C / T * log(C * T / (LC * LT)) / log(base)
    base    = C * LC / (C - LC) + LC_body * C / C_body + e

with C characters and T tags of the subtree, LC and LT those inside links (zeros count as one).
A node's sum is the sum of its children's densities. The threshold of a page is the smallest
density on the path from its densest node to the body; of the nodes that reach it, the one with the
largest sum is selected. If it lies in an article or main element, or if such elements hold at least
``SHARE`` of its unlinked text, all outermost articles of the page are returned in page order, else
the selected subtree. Elements that are never article text (menus, headers and footers of the page,
side bars, notices, adverts, forms, scripts, comments), told by tag, role or names in class or id, are
left out of the tree beforehand, unless a form or a named element is the one around the page's text.
Nothing else of an article or main element is dropped; of another subtree, blocks of several links
below the threshold are (menus without a name), but no headings, paragraphs, list items and cells.

One page is one row and one call; pages are dealt by the scan, nothing is shuffled.

Edge cases: a null or empty page, or one without text, gives the empty string; text outside any
element counts as the body's; an unclosed tag at the end is dropped; unclosed elements end with
their parent; unknown references stay as written; repeated rows give repeated results; an empty
table an empty result; other columns are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from activlake.llm.common import by_name, table

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']+|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")

# Elements of HTML by their part in a page.
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp".split())
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label map mark q "
    "rp rt ruby s samp small span strike strong sub sup time tt u var".split()
)
NEVER_TEXT = frozenset(
    "head nav footer aside form script style textarea title noscript iframe noembed noframes xmp "
    "template svg math select button dialog menu object canvas audio video datalist".split()
)
HOLDS_ARTICLE = frozenset(("article", "main"))
#: Never dropped for their links.
TEXT = frozenset("h1 h2 h3 h4 h5 h6 p li dt dd td th tr blockquote pre figcaption caption".split())
ROOTS = frozenset(("html", "body"))
NEVER_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alert alertdialog menu menubar "
    "form toolbar".split()
)
NEVER_HINTS = frozenset(
    "ad ads adv advert advertisement adverts advertising banner breadcrumb breadcrumbs comment "
    "comments consent cookie cookies disclaimer discussion disqus footer gdpr header login "
    "masthead menu modal nav navbar navigation newsletter notice notices notification outbrain "
    "overlay popup promo promoted promotion recommended related replies reply respond responses "
    "share sharing sidebar signup social sponsor sponsored subscribe subscription taboola toolbar "
    "topbar widget".split()
)
#: Words that may stand beside a hint in one name, as in ``site-header`` or ``comment-list``.
BESIDE_HINTS = frozenset(
    "site main page global top bottom left right primary secondary bar box block section area "
    "container wrapper list links items posts articles stories buttons button slot unit form".split()
)
#: Hints of elements that are not the article however long they are.
NEVER_MOST = frozenset(
    "ad ads adv advert adverts advertisement advertising comment comments consent cookie cookies "
    "disqus gdpr replies reply respond responses".split()
)
#: Names of reader comments, alone or beside any other word, as in ``user-comments``.
COMMENTS = frozenset("comment comments replies".split())
#: Words that make such a name tell about an article, as in ``has-comments`` or ``comments-closed``.
ABOUT_COMMENTS = frozenset(
    "has have with no not without allow allows allowed open opened closed enabled disabled count "
    "counter number total can show hide".split()
)
#: Articles are returned if they hold at least this share of the densest part's unlinked text.
SHARE = 0.25
ARTICLE_HINTS = frozenset("article content entry main post story".split())
#: A start tag ends open elements of these kinds within the nearest barrier.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}


class Node:
    __slots__ = ("tag", "parent", "parts", "dropped", "named", "chars", "tags", "link_chars", "link_tags",
                 "density", "total")

    def __init__(self, tag: str, parent: Node | None, dropped: bool = False):
        self.tag, self.parent, self.dropped = tag, parent, dropped
        self.named: frozenset[str] = frozenset()
        self.parts: list[str | Node] = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0

    def children(self) -> Iterator[Node]:
        return (p for p in self.parts if isinstance(p, Node))


def _never_text(tag: str, attributes: str, in_article: bool) -> tuple[bool, frozenset[str]]:
    """Whether the element never is text, and the hints that it is none, which ``_settle`` weighs."""
    if tag in ROOTS:
        return False, frozenset()
    if (tag in NEVER_TEXT and tag != "form") or (tag == "header" and not in_article):
        return True, frozenset()
    named = {"form"} if tag == "form" else set()
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values).lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True, frozenset()
        if name == "role" and value in NEVER_ROLES:
            if value != "form":
                return True, frozenset()
            named.add(value)
        if name in ("class", "id"):
            for token in value.split():
                said = set(re.split(r"[-_]+", token)) - {""}
                if said & COMMENTS and not said & ABOUT_COMMENTS:
                    named.add("comments")
                if tag in HOLDS_ARTICLE:
                    named |= {"comments"} if said == {"reply"} else set()
                elif said <= NEVER_HINTS | BESIDE_HINTS and not (
                    said & ARTICLE_HINTS and said & {"header"}
                ):
                    named |= said & NEVER_HINTS
    return False, frozenset(named)


def _settle(root: Node) -> None:
    """Drop the elements that hints name, except the one around the page's article: it holds an
    article or main, itself without a hint, with no less text than those outside of such elements
    or, without any of these, most of the page's unlinked text. An article that is named as a
    comment is one unless the page has no other."""
    order = _in_order(root)
    if not any(n.named for n in order):
        return
    text = {id(n): n.chars - n.link_chars for n in order}
    held: dict[int, int] = dict.fromkeys(text, 0)
    only = not any(n.tag in HOLDS_ARTICLE and not n.named for n in order)
    for n in reversed(order):
        if n.tag in HOLDS_ARTICLE and (only or not n.named):
            held[id(n)] = max(held[id(n)], text[id(n)])
        if n.parent is not None:
            text[id(n.parent)] += text[id(n)]
            held[id(n.parent)] = max(held[id(n.parent)], held[id(n)])
    free, under = 0, set()
    for n in order:  # parents come first
        if n.named or id(n.parent) in under:
            under.add(id(n))
        elif n.tag in HOLDS_ARTICLE:
            free = max(free, text[id(n)])
    for n in order:
        if n.named:
            around = held[id(n)] > 0 and held[id(n)] >= free
            most = not free and not n.named & NEVER_MOST and 2 * text[id(n)] > text[id(root)]
            n.dropped = not (around or most)


def parse(page: str) -> Node:
    """The tree of block elements; text of inline elements belongs to the block around them."""
    root = node = Node("body", None)
    link: Node | None = None  # the block in which a link is open
    at = 0
    while True:
        found = TOKEN.search(page, at)
        text = page[at : found.start()] if found else page[at:]
        if text and not node.dropped:
            text = html.unescape(text)
            node.parts.append(text)
            length = len("".join(text.split()))
            node.chars += length
            if link is not None:
                node.link_chars += length
        if not found:
            _settle(root)
            return root
        at = found.end()
        tag = found[2] or found[5]
        if not tag:
            continue
        closing, tag = found[1] or found[4], tag.lower()
        if closing:
            if tag == "a":
                link = None
            if tag in INLINE or tag in VOID or tag in ROOTS:
                continue
            above = node
            while above is not None and above.tag != tag:
                above = above.parent
            if above is not None and above is not root:
                node, link = above.parent, None
            continue
        if not page[found.end() - 1 : found.end()] == ">":
            _settle(root)
            return root  # the page ends inside this tag
        if tag in VOID or tag in INLINE:
            if not node.dropped:
                node.tags += 1
                if tag in ("br", "hr", "wbr"):
                    node.parts.append(" " if tag != "wbr" else "")
                elif tag == "a":
                    link = node
                    node.link_tags += 1
            continue
        if tag in ROOTS:
            continue
        if node.tag == "p":
            node, link = node.parent, None
        kinds, barriers = ENDS.get(tag, ((), ()))
        above = node
        while kinds and above is not None and above.tag not in barriers:
            if above.tag in kinds:
                node, link = above.parent, None
            above = above.parent
        inside = node
        while inside is not None and inside.tag not in HOLDS_ARTICLE:
            inside = inside.parent
        attributes = found[3] or found[6] or ""
        never, named = _never_text(tag, attributes, inside is not None)
        child = Node(tag, node, node.dropped or never)
        child.named = named
        if not node.dropped:
            node.parts.append(child)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            at = end.end() if end else len(page)
        elif not attributes.rstrip().endswith("/") or tag not in ("svg", "path"):
            node = child


def _in_order(root: Node) -> list[Node]:
    """Nodes that may hold text, parents before children."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(c for c in node.children() if not c.dropped)
    return order


def measure(root: Node) -> list[Node]:
    """Fill in the densities and sums of all nodes."""
    order = _in_order(root)
    for node in reversed(order):
        for child in node.children():
            if not child.dropped:
                node.chars += child.chars
                node.tags += child.tags + 1
                node.link_chars += child.link_chars
                node.link_tags += child.link_tags
    ratio = root.link_chars / max(root.chars, 1)
    for node in reversed(order):
        chars, tags, links = node.chars, max(node.tags, 1), node.link_chars
        if chars:
            base = math.log(chars * links / max(chars - links, 1) + ratio * chars + math.e)
            inner = chars * tags / (max(links, 1) * max(node.link_tags, 1))
            node.density = chars / tags * max(math.log(inner), 0.0) / base
        node.total = sum(c.density for c in node.children() if not c.dropped) or node.density
    return order


def select(root: Node) -> tuple[Node, float]:
    """The subtree with the largest sum of those that reach the page's threshold, and that."""
    order = measure(root)
    densest = max(order, key=lambda n: n.density)
    threshold, node = densest.density, densest
    while node is not None:
        threshold, node = min(threshold, node.density), node.parent
    return max((n for n in order if n.density >= threshold), key=lambda n: n.total), threshold


def articles(root: Node, best: Node) -> list[Node]:
    """The outermost articles of the page in page order, if the selected subtree lies in one of them
    or they hold enough text beside it; else none."""
    found, stack = [], [root]
    while stack:
        node = stack.pop()
        if node.tag in HOLDS_ARTICLE and node.chars:
            found.append(node)
        else:
            stack.extend(c for c in reversed(list(node.children())) if not c.dropped)
    node: Node | None = best
    while node is not None and node.tag not in HOLDS_ARTICLE:
        node = node.parent
    text = sum(n.chars - n.link_chars for n in found)
    return found if node is not None or text >= SHARE * (best.chars - best.link_chars) else []


def _menu(node: Node, threshold: float) -> bool:
    """A block of several links without much else, as menus without a name are."""
    links = 2 * node.link_chars > node.chars and node.link_tags > 1
    return links and node.density < threshold and node.tag not in TEXT


def _blocks(node: Node, threshold: float) -> Iterator[str]:
    whole = node.tag in HOLDS_ARTICLE
    stack: list[Iterator] = [iter(node.parts)]
    run: list[str] = []
    while stack:
        part = next(stack[-1], None)
        if isinstance(part, str):
            run.append(part)
            continue
        yield " ".join("".join(run).split())
        run = []
        if part is None:
            stack.pop()
        elif not part.dropped and (whole or not _menu(part, threshold)):
            stack.append(iter(part.parts))
    yield " ".join("".join(run).split())


def main_text(page: str | None) -> str:
    """The main text of one page."""
    if not page:
        return ""
    root = parse(page)
    node, threshold = select(root)
    parts = articles(root, node) or [node]
    return " ".join(b for part in parts for b in _blocks(part, threshold) if b)


def extract(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` columns of the pages, ``text`` and its length in code points, ``n_chars``."""

    @F.pandas_udf("string")
    def texts(parts: pd.Series) -> pd.Series:
        return parts.map(main_text)

    kept = [by_name(pages, c) for c in keep]
    out = pages.select(*kept, texts(by_name(pages, html)).alias("text"))
    return out.select("*", F.length("text").cast("long").alias("n_chars"))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract(table(spark, sf_dir, "pages"), keep=("page_id", "url"))
