"""Main text of web pages by scoring the tree of elements.

Every paragraph of a page has points for its length and commas, discounted by
its share of link text. It passes them to its parent, half of them to the
grandparent, and ever smaller shares upwards. The container with the most
points, discounted by its own share of link text, holds the article; siblings
that look like a part of it are kept too. Menus, headers, footers, sidebars,
notices, adverts, forms, scripts and reader comments are known by element, role
or class and take no part.

A page is a row by itself: Arrow batches are cut into slices, nothing is
shuffled, and equal pages are extracted one by one.

Defined results: a null or empty page, and one without text, gives an empty
text; repeated rows stay repeated; a null page_id or url stays; other columns
are left out, so that their names don't matter; broken markup closes as a
browser would close paragraphs and list items, an end tag without a start is
ignored, and elements that are never closed end with the page; nesting beyond
`DEEPEST` levels is read as if it were flat.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from tillstar.llm.common import mapped

#: Pages that a worker turns into Python objects at a time.
PAGES = 200
#: Levels of nesting that are kept apart.
DEEPEST = 400

#: A paragraph has one point, one for each comma, and one for each 100 characters up to this number.
LONGEST = 3.0
#: A sibling of the best container is kept from this share of its points on.
SIBLING = 0.2
#: A list of at least three links whose text is mostly theirs is a menu.
MENU_LINKS, MENU_SHARE = 3, 0.8

# Elements of HTML by their meaning for the reader.
NO_TEXT = set("script style noscript template iframe object canvas audio video svg head title select datalist option".split())
NOT_ARTICLE = set("nav header footer aside form button input textarea fieldset dialog menu".split())
RAW = "script style textarea title iframe noscript xmp noembed noframes".split()
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rb rp rt ruby s samp small span strike"
    " strong sub sup time tt u var wbr".split()
)
ARTICLE = ("article", "main")
NOT_ARTICLE_ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
NOT_ARTICLE_WORDS = set(
    "ad ads adv advert adverts advertisement advertising adsense banner banners sponsor sponsored promo promotion"
    " nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager toolbar sidebar sidenav rail"
    " header masthead footer colophon copyright"
    " comment comments commentlist disqus respond replies"
    " cookie cookies consent gdpr notice notices notification popup modal overlay lightbox"
    " newsletter subscribe subscription signup login search social share sharing related recommended widget widgets".split()
)
#: Beside one of these in a class name, such a word speaks of the page's layout and not of the element.
LAYOUT_WORDS = set("has with no without open opened closed enabled disabled".split())
#: An opening tag closes an open element of the second list.
CLOSES = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "tr": ("tr", "td", "th"),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "option": ("option",),
}
#: Elements that an implied end doesn't leave.
SCOPES = set("ul ol dl table article section div body main aside nav header footer form blockquote td th".split())

# quotes that don't close within 65,536 characters are read as plain ones, so that a tag costs no scan of the page
_REST = r"(?:(?:[^>\"']++|\"[^\"]{0,65536}+\"|'[^']{0,65536}+')*+>|[^>]*+>)"
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|$)|<(?P<raw>{'|'.join(RAW)})(?=[\s/>]){_REST}"
    rf"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>{_REST})|<[!?/][^>]*>?",
    re.S | re.I,
)
_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I) for name in RAW}
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.S)
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
_NO_LETTER = re.compile(r"[^a-z0-9]+")


class Node:
    """An element: its place in the tree, what its blocks add up to, and the points that they pass to it."""

    __slots__ = ("blocks", "chars", "children", "drop", "link_chars", "links", "name", "parent", "points")

    def __init__(self, name: str, parent: Node | None, drop: bool):
        self.name, self.parent, self.drop = name, parent, drop
        self.children: list[Node] = []
        self.blocks: list[tuple[int, str]] = []
        self.chars = self.link_chars = self.links = 0
        self.points = 0.0

    def density(self) -> float:
        return self.link_chars / self.chars if self.chars else 0.0

    def score(self) -> float:
        return self.points * (1.0 - self.density())


def _beside_the_article(name: str, rest: str) -> bool:
    """Whether an element is a menu, a notice or the like, by its name, role, class or id."""
    if name in NOT_ARTICLE or name in NO_TEXT:
        return True
    if not rest or rest == "/":
        return False
    for key, *values in _ATTRIBUTE.findall(rest):
        key, value = key.lower(), values[0] or values[1] or values[2]
        if key == "hidden" or (key == "aria-hidden" and value == "true"):
            return True
        if key == "style" and "display:none" in value.replace(" ", "").lower():
            return True
        if key == "role" and value.strip().lower() in NOT_ARTICLE_ROLES:
            return True
        if key in ("class", "id") and name not in ("html", "body", *ARTICLE):
            for word in value.split():
                parts = set(_NO_LETTER.split(_CAMEL.sub("-", word).lower()))
                if parts & NOT_ARTICLE_WORDS and not parts & LAYOUT_WORDS:
                    return True
    return False


def tree(html: str) -> Node:
    """The page's elements, each with the text blocks that stand directly in it; blocks are numbered in page order."""
    root = Node("", None, False)
    here, depth, at, number = root, 0, 0, 0
    pending: list[str] = []  # the open block's text
    linked = links = 0  # characters of it, and links, inside <a>
    in_link = False
    flat: dict[str, int] = {}  # open elements below the deepest level

    def close_block() -> None:
        nonlocal number, linked, links
        text = " ".join(unescape("".join(pending)).split()) if pending else ""
        pending.clear()
        if text and not here.drop:
            here.blocks.append((number, text))
            number += 1
            part = min(linked, len(text))
            node: Node | None = here
            while node is not None:
                node.chars += len(text)
                node.link_chars += part
                node.links += links
                node = node.parent
        linked = links = 0

    def leave(node: Node) -> None:
        nonlocal here, depth
        while here is not node.parent:
            here, depth = here.parent, depth - 1

    def open_above(names: tuple[str, ...], scopes: set[str]) -> Node | None:
        node = here
        while node.parent is not None:
            if node.name in names:
                return node
            if node.name in scopes:
                return None
            node = node.parent
        return None

    def enter(name: str, rest: str) -> None:
        nonlocal here, depth
        made = Node(name, here, here.drop or _beside_the_article(name, rest))
        here.children.append(made)
        here, depth = made, depth + 1

    for found in _TOKEN.finditer(html):
        if found.start() < at:
            continue  # inside a raw element
        text = html[at : found.start()]
        at = found.end()
        if text:
            pending.append(text)
            if in_link:
                linked += len(" ".join(text.split()))
        raw = found["raw"]
        if raw:
            end = _END[raw.lower()].search(html, at)
            if raw.lower() == "xmp":
                pending.append(html[at : end.start() if end else len(html)].replace("&", "&amp;"))
            at = end.end() if end else len(html)
            continue
        name = (found["name"] or "").lower()
        if not name:
            continue
        if name in INLINE and name != "label":
            if name == "a":
                in_link = not found["end"]
                links += in_link
            continue
        if name in VOID:
            if name != "input":
                close_block()
            continue
        close_block()
        if found["end"]:
            if flat.get(name):
                flat[name] -= 1
                continue
            node = open_above((name,), set())
            if node is not None:
                leave(node)
                in_link = False
            continue
        if here.name == "head":
            leave(here)  # what can't stand in the head begins the body
        if name in CLOSES:
            node = open_above(CLOSES[name], SCOPES - set(CLOSES[name]))
        else:
            node = open_above(("p",), SCOPES)
        if node is not None:
            leave(node)
        if depth < DEEPEST:
            enter(name, found["rest"].rstrip(">"))
        else:
            flat[name] = flat.get(name, 0) + 1
    text = html[at:]
    if text:
        pending.append(text)
    close_block()
    return root


def nodes_of(root: Node) -> list[Node]:
    """All elements that take part, parents first."""
    out, left = [], [root]
    while left:
        node = left.pop()
        if not node.drop:
            out.append(node)
            left.extend(reversed(node.children))
    return out


def pass_points(nodes: list[Node]) -> None:
    """Paragraphs pass points to their ancestors: all to the container, half to the next, a third of that on the third level, and so on."""
    for node in nodes:
        own = sum(1.0 + text.count(",") + min(len(text) / 100, LONGEST) for _, text in node.blocks)
        if not own:
            continue
        own *= 1.0 - node.density()
        # a container's own text counts for itself; a paragraph, heading or other element without children passes it on
        container = node.name in ("", "html", "body", *ARTICLE) or (node.name in ("div", "section") and node.children)
        level, above = 0, node if container else node.parent
        while above is not None:
            above.points += own / (1 if level == 0 else 2 if level == 1 else 3 * level)
            level, above = level + 1, above.parent


def _part_of_article(node: Node, best: Node) -> bool:
    """Whether a sibling of the best container belongs to the article."""
    if node.drop or not node.chars or node.density() > 0.5:
        return False
    if node.score() >= SIBLING * best.score() or node.name in ("h1", "h2", "h3", "h4", "p", "blockquote", "pre", "figure", "table"):
        return True
    return node.density() < 0.25 and any(text[-1] in ".!?…。" and len(text) > 40 for n in nodes_of(node) for _, text in n.blocks)


def _is_menu(node: Node) -> bool:
    return node.name in ("ul", "ol", "dl", "div", "table", "p") and node.links >= MENU_LINKS and node.density() >= MENU_SHARE


def main_text(html: str | None) -> str:
    """The article of one page."""
    if not html:
        return ""
    root = tree(html)
    nodes = nodes_of(root)
    pass_points(nodes)
    holders = [n for n in nodes if n.chars]
    if not holders:
        return ""
    best = holders[0]
    for node in holders:
        if node.score() > best.score():
            best = node
    if best.score() <= 0:  # nothing but links
        return ""
    named: Node | None = best
    while named is not None and named.name not in ARTICLE:
        named = named.parent
    blocks: list[tuple[int, str]] = []
    if named is not None:  # an element that says it is the article holds all of it
        best = named
        left = [n for n in best.parent.children if n is best or (n.name == best.name and not n.drop and n.score() >= SIBLING * best.score())]
    elif best.name in ("", "html", "body"):
        left = [best]
    else:
        left = [n for n in best.parent.children if n is best or _part_of_article(n, best)]
        blocks += best.parent.blocks
    while left:
        node = left.pop()
        if not node.drop and (node is best or not _is_menu(node)):
            blocks += node.blocks
            left += node.children
    return " ".join(text for _, text in sorted(blocks))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page."""
    fields = {f.name: f.dataType.simpleString() for f in pages.schema.fields}

    def texts(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = [main_text(html) for html in batch.column("html").to_pylist()]
        columns = [batch.column("page_id"), batch.column("url"), pa.array(out, pa.string()), pa.array(map(len, out), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    schema = f"page_id {fields['page_id']}, url {fields['url']}, text string, n_chars long"
    return mapped(pages.select("page_id", "url", "html"), texts, schema, PAGES)
