"""The main text of web pages by tree scoring.

A page becomes a tree.  What is never main text (scripts, menus, forms, elements whose
class, id or role names a sidebar, notice, advert, comment ...) is cut off.  Each block of
text passes points, for its length and its commas and discounted by the share of it that
is links, to its container and, halved each time, to the containers above.  The container
with most points, discounted by its own links, is kept together with those siblings that
score well or carry plain prose.

* Character references are decoded; white space inside a block becomes one space; blocks
  are joined in page order by one line feed; nothing else is dropped and nothing is cut.
* A null, empty or textless page has the empty text.  Broken markup (unclosed or stray
  tags, a page that ends inside a tag) is read as browsers do, as far as text goes.
* Ties go to the container that begins first.  Rows and other columns stay as they are.
* Time grows with the page's length; a task's memory with one batch of pages.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotewright.llm.common import shipped

VOID = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
NEVER = frozenset(
    "script style noscript template iframe object embed svg math canvas audio video map nav aside footer form "
    "button select textarea input option datalist dialog menu title head xmp noembed noframes".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split()
)
CONTAINERS = frozenset("article body center dd details div dl figure html main ol section table tbody td th tr ul".split())
PARTS = frozenset("dd dl li ol td th ul".split())
ROWS = frozenset("tbody tfoot thead tr".split())
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
CLOSES_P = BLOCKS - {"caption", "legend", "body", "html", "tbody", "tfoot", "thead", "tr"}
#: An opening tag ends an open element of these kinds, as far up as the named border.
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}
#: Words of a class or id that mark what isn't main text.
UNLIKELY = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense announcement banner breadcrumb breadcrumbs comment commentlist "
    "comments consent cookie cookies copyright discussion disqus disclaimer footer gdpr legal login masthead menu modal nav navbar "
    "navigation newsletter notice notices pager pagination popup privacy promo promoted recommendations recommended related "
    "remark remarks replies reply respond responses rss share sharing sidebar signup sitemap skyscraper social sponsor "
    "sponsored subnav subscribe toolbar topbar trending tweet widget".split()
)
UNLIKELY_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form".split())
#: Words of wrappers, which may name a part of what they hold ("has-sidebar").
WRAPPERS = frozenset("container grid has layout page row site with without wrap wrapper".split())
#: Names under which a header is the article's own.
ARTICLES = frozenset("article entry post story".split())
LIKELY = frozenset("article body content entry main page post story text".split())
PRIOR = {"article": 25.0, "main": 15.0, "div": 5.0, "section": 5.0, "td": 3.0, "ol": -3.0, "ul": -3.0, "dl": -3.0}

#: Elements that an inline end tag in them leaves open.
CLOSED_OUTSIDE = BLOCKS | {"td", "th"}

_NEXT = re.compile(r"<(?:(!--)|(/?)([A-Za-z][^\s/>]*+)|([!?/]))")
_ATTRIBUTES = re.compile(r"""(?:[\s/]++(?:[^\s/>=][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+))?+)?+)*+\s*+>""")
_ATTRIBUTE = re.compile(r"""([^\s/>=][^\s/>=]*+)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>]*+))?+""")
_KEYS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_COMMA = re.compile("[,،、，]")


class Node:
    __slots__ = ("attributes", "children", "holds", "links", "parent", "points", "size", "tag")

    def __init__(self, tag: str, attributes: dict[str, str], parent: Node | None) -> None:
        self.tag, self.attributes, self.parent = tag, attributes, parent
        self.children: list[Node | str] = []
        self.points, self.size, self.links = 0.0, 0, 0
        self.holds = tag in ("article", "h1", "main")  # and whoever holds one of these


class Open:
    """The open elements, and where those of each tag are: looking for the nearest one takes no
    longer on a deep page."""

    def __init__(self, root: Node) -> None:
        self.nodes = [root]
        self.places: dict[str, list[int]] = {}

    def push(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.nodes))
        self.nodes.append(node)

    def nearest(self, tags: frozenset[str] | set[str]) -> int:
        """The innermost element of some tags; 0, where the root is, if there is none."""
        return max((found[-1] for tag in tags if (found := self.places.get(tag))), default=0)

    def cut(self, at: int) -> None:
        """Close an element and all inside it."""
        for node in self.nodes[at:]:
            self.places[node.tag].pop()
        del self.nodes[at:]


def parse(page: str) -> Node:
    """The tree of a page; text is decoded."""
    root = Node("html", {}, None)
    stack = Open(root)
    at, end = 0, len(page)
    while at < end:
        found = _NEXT.search(page, at)
        begin = found.start() if found else end
        if begin > at:
            stack.nodes[-1].children.append(html.unescape(page[at:begin]))
        if not found:
            break
        comment, closing, name, other = found.groups()
        if comment:
            at = page.find("-->", found.end() - 2 if page.startswith(">", found.end()) else found.end())
            at = end if at < 0 else at + 3
            continue
        if other:  # a declaration, or a comment in the wrong form
            at = page.find(">", found.end())
            at = end if at < 0 else at + 1
            continue
        name = name.lower()
        rest = _ATTRIBUTES.match(page, found.end())
        stop = rest.end() if rest else page.find(">", found.end()) + 1
        if not stop:
            break  # the page ends inside a tag
        if closing:
            _close(stack, name)
        else:
            _open(stack, name, page[found.end() : stop - 1])
            if name in RAW:
                stop = _raw(stack, page, name, stop)
        at = stop
    return root


def _open(stack: Open, name: str, inside: str) -> None:
    if name in ("html", "body") and any(x.tag == name for x in stack.nodes[:3]):
        return
    if name in CLOSES_P:
        _close_up_to(stack, {"p"}, BLOCKS - {"p"})
    if name in SIBLINGS:
        kinds, border = SIBLINGS[name]
        for _ in kinds:
            _close_up_to(stack, kinds, border)
    attributes = {}
    if inside and not inside.isspace():
        for key, value in _ATTRIBUTE.findall(inside):
            attributes.setdefault(key.lower(), html.unescape(value.strip("\"'")))
    node = Node(name, attributes, stack.nodes[-1])
    stack.nodes[-1].children.append(node)
    if name not in VOID:
        stack.push(node)


def _close_up_to(stack: Open, kinds: set[str], border: frozenset[str] | set[str]) -> None:
    found = stack.nearest(kinds)
    if found and found >= stack.nearest(border):
        stack.cut(found)


def _close(stack: Open, name: str) -> None:
    found = stack.nearest({name})
    inline = name not in BLOCKS and name not in ("td", "th")
    if found and not (inline and stack.nearest(CLOSED_OUTSIDE) > found):  # an inline tag can't close the blocks in it
        stack.cut(found)


def _raw(stack: Open, page: str, name: str, at: int) -> int:
    """Skip text that isn't markup, up to its own end tag."""
    ended = re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I).search(page, at)
    stack.cut(len(stack.nodes) - 1)
    return ended.end() if ended else len(page)


def _words(node: Node) -> set[str]:
    named = f"{node.attributes.get('class', '')} {node.attributes.get('id', '')}"
    return {x.lower() for x in _KEYS.findall(named)}


def _unlikely(node: Node, in_article: bool) -> bool:
    """Whether an element can't be main text."""
    tag, attributes = node.tag, node.attributes
    if tag in NEVER or (tag == "header" and not in_article and not _words(node) & ARTICLES):
        return True
    if not attributes:
        return False
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true":
        return True
    if _HIDDEN.search(attributes.get("style", "")):
        return True
    if tag in ("html", "body"):
        return False
    if attributes.get("role", "").lower() in UNLIKELY_ROLES:
        return True
    words = _words(node)
    if tag in ("article", "main"):
        return bool(words & {"comment", "comments", "reply", "ad", "advert", "promo", "related"})
    if words & WRAPPERS and node.holds:
        return False
    return bool(words & UNLIKELY) or ("header" in words and not in_article and tag not in HEADINGS)


def _prune(root: Node) -> None:
    for node in reversed(_in_order(root)):
        if node.holds and node.parent is not None:
            node.parent.holds = True
    work = [(root, False)]
    while work:
        node, inside = work.pop()
        inside = inside or node.tag in ("article", "main") or bool(node.attributes and _words(node) & ARTICLES)
        node.children = [x for x in node.children if isinstance(x, str) or not _unlikely(x, inside)]
        work += [(x, inside) for x in node.children if not isinstance(x, str)]


def _in_order(root: Node) -> list[Node]:
    out, work = [], [root]
    while work:
        node = work.pop()
        out.append(node)
        work += [x for x in reversed(node.children) if not isinstance(x, str)]
    return out


def _own_text(block: Node) -> tuple[str, int]:
    """The text of a block outside the blocks in it, and how much of it is links."""
    parts, links = [], 0
    work: list[tuple[Node | str, bool]] = [(x, block.tag == "a") for x in reversed(block.children)]
    while work:
        item, linked = work.pop()
        if isinstance(item, str):
            parts.append(item)
            links += len(item.strip()) if linked else 0
        elif item.tag == "br":
            parts.append(" ")
        elif item.tag not in BLOCKS and item.tag not in ("td", "th"):
            work += [(x, linked or item.tag == "a") for x in reversed(item.children)]
    return " ".join("".join(parts).split()), links


def _score(nodes: list[Node]) -> None:
    for node in nodes:
        if node.tag in HEADINGS or not (node.tag in BLOCKS or node.tag in ("td", "th")):
            continue
        text, links = _own_text(node)
        if not text:
            continue
        size = len(text)
        points = 1 + len(_COMMA.findall(text)) + min(size / 100, 3)
        points *= min(1.0, size / 25) * (1 - min(1.0, links / size))
        above = node if node.tag in CONTAINERS else node.parent
        for _ in range(4):
            if above is None:
                break
            above.points += points
            points /= 2
            above = above.parent
        node.size += size
        node.links += min(size, links)
    for node in reversed(nodes):
        if node.parent is not None:
            node.parent.size += node.size
            node.parent.links += node.links


def _worth(node: Node) -> float:
    """A container's points with what its tag and names suggest, less its links."""
    if not node.points:
        return 0.0
    words = _words(node) if node.attributes else ()
    hint = 25.0 if any(x in LIKELY for x in words) else 0.0
    return (node.points + PRIOR.get(node.tag, 0.0) + hint) * (1 - node.links / max(1, node.size))


def _blocks(roots: list[Node]) -> list[str]:
    """The text of each block, in page order."""
    out: list[str] = []
    parts: list[str] = []

    def flush() -> None:
        text = " ".join("".join(parts).split())
        parts.clear()
        if text:
            out.append(text)

    border = object()
    work: list = []
    for root in reversed(roots):
        work += [border, root, border]
    while work:
        item = work.pop()
        if item is border:
            flush()
        elif isinstance(item, str):
            parts.append(item)
        elif item.tag in ("br", "td", "th"):
            parts.append(" ")
            work += reversed(item.children)
        else:
            inner = list(reversed(item.children))
            work += [border, *inner, border] if item.tag in BLOCKS else inner
    flush()
    return out


def _kept(nodes: list[Node]) -> list[Node]:
    """The best container with the siblings that belong to it."""
    best = max(nodes, key=_worth)
    if not best.points:
        return [nodes[0]]
    above = best
    while above is not None and above.tag not in ("article", "main"):
        above = above.parent
    best = above or best
    while best.parent is not None and (best.tag in ROWS or (best.tag in PARTS and 2 * best.size <= best.parent.size)):
        best = best.parent  # rows, and cells or items among others, are no containers of their own
    if best.parent is None or best.tag == "body":
        return [best]
    least = max(10.0, _worth(best) / 5)
    kept, passed = [], False
    for node in best.parent.children:
        if node is best:
            passed = True
            kept.append(node)
        elif isinstance(node, str):
            continue
        elif node.tag in HEADINGS:
            if not passed:
                kept.append(node)
        elif node.points and _worth(node) >= least:
            kept.append(node)
        elif node.tag == "p":
            density = node.links / max(1, node.size)
            if (node.size > 80 and density < 0.25) or (0 < node.size <= 80 and not node.links and _ends(node)):
                kept.append(node)
    return kept


def _ends(node: Node) -> bool:
    return _own_text(node)[0].endswith((".", "!", "?", "…", "。"))


def title_and_body(page: str | None) -> tuple[str, str]:
    """The main text of one page: an h1 that it begins with, and the rest."""
    if not page:
        return "", ""
    root = parse(page)
    _prune(root)
    nodes = _in_order(root)
    _score(nodes)
    kept = _kept(nodes)
    blocks = _blocks(kept)
    title = _blocks([x for node in kept for x in _in_order(node) if x.tag == "h1"][:1])
    cut = len(title) if blocks[: len(title)] == title else 0
    return "\n".join(blocks[:cut]), "\n".join(blocks[cut:])


def main_text(page: str | None) -> str:
    """The main text of one page."""
    return "\n".join(filter(None, title_and_body(page)))


def text_column(page: Column) -> Column:
    @F.arrow_udf("string")
    def extract(pages: pa.Array) -> pa.Array:
        return pa.array([main_text(x.as_py()) for x in pages], pa.string())

    return extract(page)


def title_and_body_column(page: Column) -> Column:
    """The main text in two parts, struct<title, body>."""

    @F.arrow_udf("struct<title:string,body:string>")
    def extract(pages: pa.Array) -> pa.Array:
        rows = [dict(zip(("title", "body"), title_and_body(x.as_py()), strict=True)) for x in pages]
        return pa.array(rows, pa.struct([("title", pa.string()), ("body", pa.string())]))

    return extract(page)


def extract_text(pages: DataFrame, html_column: str = "html", into: str = "text") -> DataFrame:
    """Add the main text of every page."""
    shipped(pages.sparkSession)
    return pages.withColumn(into, text_column(pages[html_column]))
