"""Main text of a web page by composite text density.

A page is read into a tree of elements. Elements whose tag is never main text (scripts,
styles, menus, page headers and footers, asides) are left out. Forms, and elements that
a role or a whole token of class or id names as a sidebar, notice, advert, reader
comments and the like, are left out if that cannot be the main text: no article or main
with text lies inside, and either one lies outside all of them or they hold less than half of the body's text
outside links, each and together. Reader comments go whenever an article lies outside
all of these elements, even if they hold articles of their own. For every node
of the rest the link-adjusted text density is

    C / T * ln(1 + C * T / (LC * LT)) / ln(ln(C * LC / (C - LC) + C * LCb / Cb + e**e))

(C characters, T tags, LC and LT those in links, b the body; counts of 0 in a
divisor are 1; e**e keeps the inner logarithm above 1 on pages without links). The
density sum of a node adds up its children's densities, a run of text of its own
counting as a child. The node of the largest sum is the core of the main text. The
smallest density on the path from it to the body is the threshold: the main text is
the enclosing article (or main) if the core lies in one, else the core with all
other subtrees of the body that reach the threshold, and headings right before them.

Text: character references decoded, white space inside a block turned into one
space and trimmed, blocks in page order joined by an empty line. Nothing is cut.

Edge cases: null and empty pages, and pages of nothing but elements left out by tag, give an
empty text; unclosed and stray tags are closed as browsers do it for paragraphs,
lists and tables; equal sums go to the outermost, then the first node; repeated rows
are read alike; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .columns import fresh

# attributes are read name by name, as browsers do: a value without quotes reaches up to white space or ">", whatever it holds
_VALUE = r"\"[^\"]*\"|'[^']*'|[^\s>\"'][^\s>]*+"
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/<>]*+)((?:[\s/]++|[^\s/<>=]++(?:\s*+=\s*+(?:" + _VALUE + r")?)?|=)*+)>", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/<>]++)(?:\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"'][^\s>]*+)))?")
_WORD = re.compile(r"[a-z0-9]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol p pre section summary table tbody td tfoot th
    thead tr ul""".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# an opening tag closes an open element of these, looked for up to the barrier
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
          "option": ("option",), "tbody": ("tbody", "thead", "tr", "td", "th"), "tfoot": ("tbody", "thead", "tr", "td", "th")}
BARRIERS = frozenset("ul ol dl table menu html body article section div main select".split())
_P_BARRIERS = BARRIERS | {"li", "td", "th", "dd", "dt", "blockquote"}
_ITEM_BARRIERS = BARRIERS - {"section", "div"}
_ITEMS = frozenset(name for names in CLOSES.values() for name in names)
LEFT_OUT_TAGS = frozenset("""script style textarea title noscript iframe xmp noembed noframes head nav footer aside button select
    option input menu dialog template svg canvas object embed audio video map""".split())
LEFT_OUT_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar status".split())
LEFT_OUT_WORDS = frozenset("""ad ads adv advert advertisement adverts sponsor sponsored promo promotion banner cookie cookies consent
    gdpr notice notices alert popup modal overlay newsletter subscribe subscription paywall sidebar side rail menu nav navbar
    navigation breadcrumb breadcrumbs footer header masthead topbar toolbar comment comments commentlist disqus reply replies respond
    share sharing social related recommended recommendations widget pagination pager login signup search hidden skip""".split())
# words that make a token of several words no less a name of the above ("comments-area", but not "comments-open")
PART_WORDS = frozenset("""area bar block box button buttons container group inner item items links list outer page post section site
    wrap wrapper""".split())
COMMENT_WORDS = frozenset("comment comments commentlist disqus reply replies respond".split())
NEVER_LEFT_OUT = frozenset("html body main article".split()) | HEADINGS
TEXT = "#text"


class _Node:
    __slots__ = ("tag", "parent", "children", "text", "out", "named", "chars", "tags", "link_chars", "link_tags", "density", "sum",
                 "depth", "block_depth", "in_article", "paragraph", "item")

    def __init__(self, tag, parent, text="", out=False, named=""):
        self.tag, self.parent, self.children, self.text, self.out, self.named = tag, parent, [], text, out, named
        if parent is not None:
            parent.children.append(self)
        if tag == TEXT:
            return
        # what an ancestor-or-self is, told from the parent alone: its depth, the nearest block's, whether one is an article, the
        # paragraph and the list or table part that are open up to the next barrier
        self.depth = 0 if parent is None else parent.depth + 1
        self.block_depth = self.depth if tag in BLOCK or parent is None else parent.block_depth
        self.in_article = tag in ("article", "main") or parent is not None and parent.in_article
        above = parent is not None and parent
        self.paragraph = self if tag == "p" else None if not above or tag in _P_BARRIERS else above.paragraph
        self.item = self if tag in _ITEMS else None if not above or tag in _ITEM_BARRIERS else above.item


def _attributes(source: str) -> dict:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(source)}


def _left_out(tag: str, found: dict, in_article: bool) -> bool:
    if tag in LEFT_OUT_TAGS or (tag == "header" and not in_article):
        return True
    if tag in NEVER_LEFT_OUT:
        return False
    return "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "").lower()


def _named(tag: str, found: dict) -> str:
    """"comments" or "other" if role, class or id name the element as no main text, or it is a form; else ""."""
    if tag in NEVER_LEFT_OUT:
        return ""
    tokens = (found.get("class", "") + " " + found.get("id", "")).lower().split()
    names = [words for words in map(set, map(_WORD.findall, tokens)) if words & LEFT_OUT_WORDS and words <= LEFT_OUT_WORDS | PART_WORDS]
    if any(words & COMMENT_WORDS for words in names):
        return "comments"
    return "other" if names or tag == "form" or found.get("role", "").lower() in LEFT_OUT_ROLES else ""


def parse(page: str) -> _Node:
    """Tree of the page's elements and text runs; ``out`` marks the roots of left-out subtrees, ``named`` those that
    :func:`_leave_out_named` judges."""
    root = _Node("html", None)
    at = root
    place = 0
    open_nodes: dict = {}  # tag: its open elements, the innermost last

    def add_text(piece: str):
        if piece:
            _Node(TEXT, at, html.unescape(piece))

    def leave_up_to(node):
        """Close what is open below ``node``; every element is closed once, so all closing is linear."""
        nonlocal at
        while at is not node:
            open_nodes[at.tag].pop()
            at = at.parent

    def item_of(names):
        node = at.item
        while node is not None and node.tag not in names:
            node = node.parent.item
        return node

    length = len(page)
    while place < length:
        m = _TOKEN.search(page, place)
        if m is None:
            add_text(page[place:])
            break
        add_text(page[place:m.start()])
        place = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA["):
                add_text(m[0][9:-3])
            continue
        tag = m[2].lower()
        if m[1]:
            if tag in VOID:
                continue
            opened = open_nodes.get(tag)
            # an inline end tag does not reach beyond the block it stands in
            if opened and (tag in BLOCK or opened[-1].depth > at.block_depth):
                leave_up_to(opened[-1].parent)
            continue
        if tag in ("html", "body") and at is not root and tag == "html":
            continue
        if tag in BLOCK and at.paragraph is not None:
            leave_up_to(at.paragraph.parent)
        if tag in CLOSES:
            node = item_of(CLOSES[tag])
            while node is not None:
                leave_up_to(node.parent)
                node = item_of(CLOSES[tag])
        found = _attributes(m[3]) if m[3].strip("/ \t\n") else {}
        child = _Node(tag, at, out=_left_out(tag, found, at.in_article), named=_named(tag, found))
        if tag in RAW:
            end = re.compile(f"</{re.escape(tag)}[^>]*>", re.I).search(page, place)
            place = end.end() if end else length
        elif tag not in VOID and not m[3].rstrip().endswith("/") or tag in BLOCK and tag != "hr":
            open_nodes.setdefault(tag, []).append(child)
            at = child
    return root


def _in_order(root: _Node) -> list:
    """Nodes that are not left out, parents before children."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if not node.out:
            out.append(node)
            stack.extend(reversed(node.children))
    return out


def _count(nodes: list) -> None:
    for node in nodes:
        node.chars = len("".join(node.text.split())) if node.tag == TEXT else 0
        node.tags = 0 if node.tag == TEXT else 1
        node.link_chars = node.link_tags = 0
    for node in reversed(nodes):  # children first
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.tags
        if node.parent is not None:
            for name in ("chars", "tags", "link_chars", "link_tags"):
                setattr(node.parent, name, getattr(node.parent, name) + getattr(node, name))


def _leave_out_named(nodes: list) -> bool:
    """Leave out the named elements that cannot be the main text; whether there are any."""
    if not any(n.named for n in nodes):
        return False
    _count(nodes)
    body = next((n for n in nodes if n.tag == "body"), nodes[0])
    total = body.chars - body.link_chars
    inside, holds, article_outside = set(), set(), False  # in a named element; with an article or main inside
    for node in nodes:
        if node.named or node.parent is not None and id(node.parent) in inside:
            inside.add(id(node))
        if node.tag in ("article", "main") and node.chars > node.link_chars:
            article_outside = article_outside or id(node) not in inside
            above = node.parent
            while above is not None and id(above) not in holds:
                holds.add(id(above))
                above = above.parent
    found, gone = [], set()
    for node in nodes:  # parents come first
        if node.parent is not None and id(node.parent) in gone:
            gone.add(id(node))
        elif node.named == "comments" and article_outside or node.named and id(node) not in holds \
                and (article_outside or 2 * (node.chars - node.link_chars) < total or not node.chars):
            found.append(node)
            gone.add(id(node))
    if not article_outside and 2 * sum(n.chars - n.link_chars for n in found) >= total > 0:
        _weigh(nodes)  # together they are the larger part: whatever holds the densest node stays
        core = max((n for n in nodes if n.tag != TEXT), key=lambda n: n.sum)
        path = set()
        while core is not None:
            path.add(id(core))
            core = core.parent
        found = [n for n in found if id(n) not in path]
    for node in found:
        node.out = True
    return bool(found)


def _weigh(nodes: list) -> None:
    _count(nodes)
    body = next((n for n in nodes if n.tag == "body"), nodes[0])
    linked = body.link_chars / max(body.chars, 1)
    for node in nodes:
        chars, links = node.chars, node.link_chars
        if not chars:
            node.density = 0.0
            continue
        tags = max(node.tags, 1)
        adjust = math.log(1 + chars / max(links, 1) * tags / max(node.link_tags, 1))
        base = math.log(chars / max(chars - links, 1) * links + linked * chars + math.e ** math.e)
        node.density = chars / tags * adjust / math.log(base)
    for node in nodes:
        kept = [c for c in node.children if not c.out]
        node.sum = sum(c.density for c in kept) if kept else node.density


def _regions(nodes: list) -> list:
    """Roots of the main text's subtrees, in page order."""
    inner = [n for n in nodes if n.tag != TEXT]
    core = max(inner, key=lambda n: n.sum)  # the first of equals, and parents come first
    if not core.sum:
        return []
    threshold, node, article = core.density, core, None
    path = set()
    while node is not None:
        path.add(id(node))
        if node.tag in ("article", "main"):
            article = node
        if node.parent is not None:
            threshold = min(threshold, node.density)
        if node.tag == "body":
            break
        node = node.parent
    if article is not None:
        return [article]
    if id(nodes[0]) in path and core is nodes[0]:
        return [core]
    top = next((n for n in inner if n.tag == "body" and id(n) in path), nodes[0])
    if core is top:
        return [core]
    found, stack = [], list(reversed(top.children))
    while stack:
        node = stack.pop()
        if node.out:
            continue
        if node is core or (id(node) not in path and node.chars and (node.density >= threshold or node.tag in HEADINGS)):
            found.append(node)
        elif id(node) in path:
            stack.extend(reversed(node.children))
    # a sparse heading stays if text follows it
    return [n for n, after in zip(found, [*found[1:], None])
            if n is core or n.density >= threshold or (after is not None and after.tag not in HEADINGS)]


def _blocks(roots: list) -> list:
    """Text of each block, in order."""
    out, pieces = [], []

    def flush():
        line = " ".join("".join(pieces).split())
        pieces.clear()
        if line:
            out.append(line)

    for root in roots:
        stack = [(root, False)]
        while stack:
            node, done = stack.pop()
            if node.out:
                if node.tag in BLOCK:
                    flush()
                continue
            if node.tag == TEXT:
                pieces.append(node.text)
            elif done:
                flush()
            elif node.tag in ("br", "wbr"):
                pieces.append(" " if node.tag == "br" else "")
            else:
                if node.tag in BLOCK:
                    flush()
                    stack.append((node, True))
                stack.extend((c, False) for c in reversed(node.children))
        flush()
    return out


def main_text(page: str | None) -> str:
    """The main text of one page."""
    if not page:
        return ""
    root = parse(page)
    nodes = _in_order(root)
    if _leave_out_named(nodes):
        nodes = _in_order(root)
    _weigh(nodes)
    return "\n\n".join(_blocks(_regions(nodes)))


def _text_batches(html_at: int):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = pa.array([main_text(p.as_py()) for p in batch.column(html_at)], pa.string())
            rest = [(n, c) for i, (n, c) in enumerate(zip(batch.schema.names, batch.columns)) if i != html_at]
            yield pa.RecordBatch.from_arrays([c for _, c in rest] + [texts], [n for n, _ in rest] + ["text"])
    return run


def extract_main_text(pages: DataFrame, html_col: str = "html", name: str = "text") -> DataFrame:
    """``pages`` with the html replaced by its main text (underscores in front of a name that clashes). A page
    is a task's row, so nothing is shuffled."""
    ship_package(pages.sparkSession)
    rest = [c for c in pages.columns if c != html_col]
    sent = pages.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate([*rest, html_col])])
    schema = ", ".join([f"c{i} {pages.schema[c].dataType.simpleString()}" for i, c in enumerate(rest)] + ["text string"])
    out = sent.mapInArrow(_text_batches(len(rest)), schema)
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(rest)], F.col("text").alias(fresh(rest, name)))
