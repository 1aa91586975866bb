"""Main text of web pages by composite text density.

A page is parsed into a tree of elements. What can't be article text by its role is set aside: navigation, page
headers and footers, sidebars, forms, scripts and styles, and elements whose role says so. A class or id that names
an advert, a notice, a menu or a sidebar only weighs: such an element is set aside unless it holds the largest density sum or
more than half of the page's text (text of article elements beside it weighs more); one that names reader comments, unless it holds nine tenths. For every other element the composite density weighs
its characters per tag against its share of links. The densities of an element's children are added
up, and the element with the largest sum carries the main text. The lowest density on the way from it up
to the body is the threshold: elements beside that way belong to the text too if they reach it and
aren't mostly links; so does loose text directly in a parent. ``article`` and ``main`` elements choose nothing: they only give
more weight to what lies beside the chosen element inside them.

Blocks are cut at block-level elements. White space inside a block, line breaks and no-break spaces included, becomes one
space; empty blocks vanish; blocks are joined by an empty line. Character references are decoded.

Defined results: a null or empty page, and a page without text, give an empty text. Broken markup is repaired
as browsers do it in the plain cases: paragraphs, list items and table cells end where the next
begins, an end tag closes what is open inside its element, and one without a start is skipped. A tag that is never
closed by ``>`` is text. Nothing is capped. Repeated rows and other columns are carried along.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.llm.base import pieces, texts_of

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S
)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")

# Fixed values of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp"}
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
CLOSES_P = set(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
# What an element of this name ends when it opens, up to the element that holds such parts.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
BOUNDARY = {"body", "html", "table", "td", "th", "button", "object", "article", "section", "main", "div", "nav", "footer"}

ASIDE = set("head nav footer aside form button select script style noscript template iframe svg canvas object dialog textarea".split())
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "alert", "dialog", "menu", "form"}
HINTS = set(
    "ad ads adv advert advertisement advertising adverts banner sponsor sponsored promo promotion cookie cookies consent "
    "gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription nav navbar navigation "
    "menu menus breadcrumb breadcrumbs pagination pager sidebar aside footer masthead comment comments commentlist "
    "disqus respond share sharing social related recommended widget toolbar skip hidden".split()
)
COMMENTS = {"comment", "comments", "commentlist", "disqus", "respond"}
# A class or id hints only if all its parts are hints or these: "related-posts" does, "related-work" and "has-sidebar" don't.
PARTS = set(
    "left right top bottom main site page primary secondary global box bar block container wrapper wrap inner outer list "
    "item items link links button buttons icon icons section area panel slot unit google header post posts article articles "
    "story stories mobile desktop sticky form signup text body title reply author thread".split()
)
ARTICLES = {"article", "main"}
# What lies beside the main text inside the same article element weighs so much more.
ARTICLE_WEIGHT = 4.0


class Node:
    __slots__ = ("name", "parent", "items", "aside", "article", "chars", "tags", "link_chars", "link_tags", "density", "total", "hint")

    def __init__(self, name: str, parent: Node | None, aside: bool = False, article: bool = False):
        self.name, self.parent, self.aside, self.article = name, parent, aside, article
        self.items: list[Node | str] = []
        self.hint = ""


def set_aside(name: str, attributes: str, inside_article: bool) -> bool:
    """Whether an element can't hold article text by its role."""
    if name in ASIDE or name == "header" and not inside_article:
        return True
    if not attributes.strip() or name in ("html", "body", *ARTICLES):
        return False
    for key, value in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), html.unescape(value.strip("\"'")).lower()
        if key == "hidden" or key == "aria-hidden" and value == "true":
            return True
        if key == "role" and value in ROLES:
            return True
        if key == "style" and re.search(r"display\s*:\s*none", value):
            return True
    return False


def hint_of(name: str, attributes: str) -> str:
    """What class and id hint at: "comment", "other" or nothing. Article elements can only be comments."""
    found = ""
    if not attributes.strip() or name in ("html", "body"):
        return found
    for key, value in ATTRIBUTE.findall(attributes):
        if key.lower() in ("class", "id"):
            for each in html.unescape(value.strip("\"'")).lower().split():
                parts = {x for x in re.split(r"[^a-z0-9]+", each) if x and not x.isdigit()}
                if parts & HINTS and parts <= HINTS | PARTS:
                    found = "comment" if parts & COMMENTS else found or "other"
    return "" if name in ARTICLES and found == "other" else found


def parse(page: str) -> Node:
    """The tree of a page; elements set aside are left out with all they hold."""
    root = Node("#root", None)
    here, at = root, 0

    def open_above(name: str, stop: set[str]) -> Node | None:
        n = here
        while n is not root and n.name not in stop | {name}:
            n = n.parent
        return n if n is not root and n.name == name else None

    size = len(page)
    while at < size:
        m = MARKUP.search(page, at)
        if m is None:
            here.items.append(html.unescape(page[at:]))
            break
        if m.start() > at:
            here.items.append(html.unescape(page[at : m.start()]))
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if m[1]:
            n = here
            while n is not root and n.name != name:
                n = n.parent
            if n is not root:
                here = n.parent
            continue
        if name in CLOSES_P and (p := open_above("p", BOUNDARY)) is not None:
            here = p.parent
        if name in ENDS:
            ended, holders = ENDS[name]
            n = here
            while n is not root and n.name not in holders:
                if n.name in ended:
                    here = n.parent
                n = n.parent
        inside = here
        while inside is not root and not inside.article:
            inside = inside.parent
        article = name in ARTICLES or "role" in m[3] and re.search(r"""role\s*=\s*["']?(main|article)\b""", m[3]) is not None
        node = Node(name, here, set_aside(name, m[3], inside is not root), article)
        node.hint = hint_of(name, m[3])
        here.items.append(node)
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*>|\Z", re.I).search(page, at)
            if name == "textarea" or name == "title":
                node.items.append(html.unescape(page[at : end.start()]))
            at = end.end()
        elif name not in VOID and not m[3].endswith("/"):
            here = node
        elif name not in VOID and name not in ("svg", "path"):
            here = node  # a slash has no meaning on ordinary elements
    return root


def kept_items(node: Node) -> list[Node | str]:
    return [x for x in node.items if isinstance(x, str) or not x.aside]


def nodes_below(root: Node) -> list[Node]:
    """All nodes that are not set aside, each after its children."""
    order, waiting = [], [root]
    while waiting:
        n = waiting.pop()
        order.append(n)
        waiting += [x for x in kept_items(n) if isinstance(x, Node)]
    return order[::-1]


def measure(root: Node) -> list[Node]:
    """Composite density and the sum over children of every node."""
    nodes = nodes_below(root)
    for n in nodes:
        n.chars = n.tags = n.link_chars = n.link_tags = 0
        for x in kept_items(n):
            if isinstance(x, str):
                n.chars += len("".join(x.split()))
            else:
                n.chars += x.chars
                n.tags += x.tags + 1
                n.link_chars += x.chars if x.name == "a" else x.link_chars
                n.link_tags += x.link_tags + (x.name == "a")
    top = nodes[-1]
    ratio = top.link_chars / max(top.chars, 1)
    for n in nodes:
        chars, tags, links, link_tags = n.chars, max(n.tags, 1), max(n.link_chars, 1), max(n.link_tags, 1)
        other = max(n.chars - n.link_chars, 1)
        base = math.log(chars / other * n.link_chars + ratio * chars + math.e)
        inner = chars / links * tags / link_tags
        n.density = chars / tags * (math.log(inner) / math.log(base) if inner > 1 and base > 1 else 0.0) if chars else 0.0
        n.total = sum(x.density for x in kept_items(n) if isinstance(x, Node))
    return nodes


def densest(nodes: list[Node]) -> Node:
    best = nodes[-1]
    for n in reversed(nodes):  # of equal sums the outermost
        if n.total > best.total:
            best = n
    return best


def weighed(body: Node) -> list[Node]:
    """The measured nodes, hinted elements set aside unless they carry the page."""
    nodes = measure(body)
    if any(n.hint == "comment" for n in nodes):
        for n in nodes:
            n.aside = n.aside or n.hint == "comment" and n.chars * 10 < body.chars * 9
        nodes = measure(body)
    if any(n.hint for n in nodes):
        best = densest(nodes)
        held = {id(n) for n in [best, *ancestors(best, body)]}
        articles = [(n, {id(p) for p in ancestors(n, body)}) for n in nodes if n.article]
        outer = [(n, above) for n, above in articles if not any(id(other) in above for other, _ in articles)]
        for n in nodes:
            if n.hint == "other" and id(n) not in held:
                beside = sum(x.chars for x, above in outer if id(n) not in above and not any(p is x for p in ancestors(n, body)))
                n.aside = n.aside or n.chars * 2 <= body.chars + (ARTICLE_WEIGHT - 1) * beside
        nodes = measure(body)
    return nodes


def wrap_loose(parent: Node, below: Node) -> bool:
    """Make a node of each run of text and inline elements directly in a parent, ``below`` left out; whether any was found."""
    items: list[Node | str] = []
    run: list[Node | str] = []
    found = False

    def end() -> None:
        nonlocal found
        if any(isinstance(x, str) and x.strip() for x in run):
            found = True
            made = Node("#run", parent)
            made.items = run.copy()
            items.append(made)
        else:
            items.extend(run)
        run.clear()

    for x in parent.items:
        if isinstance(x, str) or x is not below and not x.aside and (x.name in INLINE or x.name == "br"):
            run.append(x)
        else:
            end()
            items.append(x)
    end()
    parent.items = items
    return found


def chosen(root: Node) -> list[Node]:
    """The elements that hold the main text, in page order, none inside another."""
    body = next((n for n in reversed(nodes_below(root)) if n.name == "body"), root)
    nodes = weighed(body)
    best = densest(nodes)
    if best is body:
        return [body]
    way = [best, *ancestors(best, body)]
    loose = [wrap_loose(parent, below) for parent, below in zip(way[1:], way)]
    if any(loose):
        nodes = measure(body)
    threshold = min(n.density for n in way)
    picked = {id(best)}
    inside = any(n.article for n in way[1:])
    for parent, below in zip(way[1:], way):
        weight = ARTICLE_WEIGHT if inside else 1.0
        for x in kept_items(parent):
            if isinstance(x, Node) and x is not below and x.chars and x.link_chars * 2 < x.chars:
                if x.density * weight >= threshold:
                    picked.add(id(x))
        inside = inside and not (parent.article and not any(n.article for n in ancestors(parent, body)))
    return in_order(body, [n for n in nodes if id(n) in picked])


def ancestors(node: Node, top: Node) -> list[Node]:
    out = []
    while node is not top:
        node = node.parent
        out.append(node)
    return out


def in_order(top: Node, nodes: list[Node]) -> list[Node]:
    wanted, out, waiting = {id(n) for n in nodes}, [], [top]
    while waiting:
        n = waiting.pop()
        if id(n) in wanted:
            out.append(n)
        else:
            waiting += [x for x in reversed(n.items) if isinstance(x, Node)]
    return out


def blocks(node: Node) -> list[str]:
    """Texts between the limits of block-level elements."""
    found: list[str] = []
    run: list[str] = []

    def end() -> None:
        text = " ".join("".join(run).split())
        if text:
            found.append(text)
        run.clear()

    waiting: list[Node | str | None] = [node]
    while waiting:
        x = waiting.pop()
        if x is None:
            end()
        elif isinstance(x, str):
            run.append(x)
        elif x.name == "br":
            run.append(" ")
        elif x.name in INLINE:
            waiting += reversed(kept_items(x))
        else:
            end()
            waiting += [None, *reversed(kept_items(x))]
    end()
    return found


def main_text(page: str) -> str:
    return "\n\n".join(b for n in chosen(parse(page)) for b in blocks(n)) if page else ""


def extract(df: DataFrame, page: str = "html", text: str = "text") -> DataFrame:
    """All columns of ``df`` but ``page``, and the main text."""
    kept = [c for c in df.columns if c != page]
    given = df.select(*kept, F.col(page).cast("string").alias("__html"))

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            made = pa.array([main_text(x) for x in texts_of(batch.column(len(kept)))], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], made], [*kept, text])

    return given.mapInArrow(extracted, df.select(*kept).schema.add(text, "string"))
