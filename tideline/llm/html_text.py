"""Main text of web pages by scoring the tree of elements.

The page is read into a tree; elements that never hold the article (scripts, styles, navigation, forms and the like, and
those whose class or id names a menu, advert, notice, sidebar or comment section) are left out with all below them.
Each paragraph gives points to its ancestors: one, one more for each comma, and up to three for its length; the parent
gets all, each further ancestor a share that falls with distance. Points are discounted by link density, the share of
the text that lies in links. Points only find the container. An <article> or <main> is kept as it is; any other container is kept with all
that lies beside it and beside its ancestors, however short, except parts that are mostly links. What remains is cut into blocks at block elements; white space inside a block becomes one
space, character references are decoded, empty blocks go, and the blocks are joined by one space in page order.

Names that may as well be a topic ("related", "legal", "social") leave a part of an article out only if it is short or
mostly links. Formulas keep their text.

Broken pages are read as they come: end tags without a start are skipped, missing end tags are supplied (that of the head
too), and what follows the last tag is text. Each tag takes a bounded number of steps, however deep the elements lie. A page without any element is one block of text. Null and empty pages have the empty
text. Each row is read on its own, so repeated rows get equal results; an empty table gives an empty result. Other
columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.batches import map_batches, pieces, texts

# Names from the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe object canvas noframes noembed xmp".split())
NEVER = RAW | frozenset("head nav footer aside form button select option input menu dialog fieldset audio video map svg annotation".split())
# All that may stand in a head; anything else begins the body.
HEAD = frozenset("title base link meta script style noscript template head html".split())
FOREIGN = frozenset(["svg", "math"])
# Start tags that end an open drawing or formula.
BREAKOUT = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li menu meta ol p pre ruby s small "
    "span strong strike sub sup table tt u ul var article section main".split()
)
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
# An open element of the first kind ends where one of the second begins.
ENDED_BY = {
    "p": BLOCK - {"br"},
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]),
    "td": frozenset(["td", "th", "tr"]),
    "th": frozenset(["td", "th", "tr"]),
    "option": frozenset(["option"]),
}
# The elements that a start tag may end.
ENDS = {name: frozenset(k for k, by in ENDED_BY.items() if name in by) for name in frozenset().union(*ENDED_BY.values())}
PARAGRAPH = frozenset("p pre td blockquote li dd div section article main figcaption".split())
HOLDER = frozenset("body html div section article main td blockquote center table tbody tr ul ol dl".split())

# Parts of names that always mean furniture, alone or in a compound such as "topnav" or "commentlist".
UNLIKELY = re.compile(
    r"(?<![a-z])(?:ads?|advert\w*|adbox|banner|breadcrumbs?|comments?(?:list|area|section|box|form|thread)?|cookies?|consent|disqus|login|"
    r"masthead|menu|(?:top|main|sub|side|site|foot|bottom|page|primary|global)?nav(?:bar|igation|menu|list|links)?|newsletter|notice|"
    r"pagination|pager|popup|promo\w*|(?:left|right)?sidebar|signup|sponsor\w*|subscribe|subscription|toolbar|widget\w*)(?![a-z])"
)
# Names that may as well be a topic: inside an article they count only for parts that are short or mostly links.
AMBIGUOUS = re.compile(
    r"(?<![a-z])(?:footer|legal|recommend\w*|related|replies|reply|respond|rss|share|sharing|skip|social|tags)(?![a-z])"
)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar form".split())

LEAST_PARAGRAPH = 25
#: Code points below which a paragraph gives no points.

MOST_LINKED = 0.5

FURNITURE_CHARS = 100
#: Parts of an article with an ambiguous name and fewer code points are furniture.

# A tag as the HTML standard reads it: a value ends at its own quote, an unquoted one at white space or the end of the tag.
_ATTRIBUTE = r"""[\s/]*([^\s/>][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)(?:"|\Z)|'([^']*)(?:'|\Z)|([^\s>]*)))?"""
_PLAIN = re.sub(r"\((?=\[)", "(?:", _ATTRIBUTE)
_TOKEN = re.compile(
    rf"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?>(?:{_PLAIN})*))[\s/]*(?:>|\Z)", re.S
)
_NAMED = re.compile(_ATTRIBUTE, re.S)
_SPACE = re.compile(r"\s+")


class Node:
    """An element: its name, what is in it in order, and the points it was given."""

    __slots__ = ("name", "parent", "inside", "score", "chars", "linked", "out", "doubtful", "article", "block", "open")

    def __init__(self, name: str, parent: Node | None):
        self.name, self.parent = name, parent
        self.inside: list[Node | str] = []
        self.score, self.chars, self.linked = 0.0, 0, 0
        self.out = self.doubtful = False
        self.article = name in ("article", "main") or parent is not None and parent.article
        # The block it stands in, and how many inline elements of each name are open in that block.
        self.block = self if parent is None or name in BLOCK else parent.block
        self.open: dict[str, int] = {}


def _judged(node: Node, attributes: str) -> None:
    """Mark an element that never holds text of the article, or may not."""
    name = node.name
    node.out = name in NEVER or name == "header" and not node.parent.article
    if node.out or not attributes or name in ("body", "html"):
        return
    for key, *values in _NAMED.findall(attributes):
        value, key = "".join(values).lower(), key.lower()
        if key in ("class", "id") and name not in ("article", "main"):
            if UNLIKELY.search(value):
                node.out = True
            elif AMBIGUOUS.search(value):
                node.out, node.doubtful = node.out or not node.article, True
        if key == "role" and value in ROLES or key == "hidden" or key == "aria-hidden" and value == "true":
            node.out = True
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            node.out = True


class _Tree:
    """The open elements while a page is read; counts of their names spare walks that would find nothing."""

    def __init__(self) -> None:
        self.root = self.here = Node("html", None)
        self.names: dict[str, int] = {}

    def enter(self, node: Node) -> None:
        self.names[node.name] = self.names.get(node.name, 0) + 1
        if node.block is not node:
            node.block.open[node.name] = node.block.open.get(node.name, 0) + 1
        self.here = node

    def leave(self, node: Node) -> None:
        """Close ``node`` and all that is open in it."""
        at = self.here
        while True:
            self.names[at.name] -= 1
            if at.block is not at:
                at.block.open[at.name] -= 1
            if at is node:
                break
            at = at.parent
        self.here = node.parent

    def nearest(self, name: str) -> Node | None:
        """The innermost open element of a name."""
        if not self.names.get(name):
            return None
        node = self.here
        while node.name != name:
            node = node.parent
        return node

    def end_tag(self, name: str) -> None:
        # An inline end tag doesn't reach beyond the block it stands in.
        if name in BLOCK or self.here.block.open.get(name):
            node = self.nearest(name)
            if node is not None:
                self.leave(node)

    def make_room(self, name: str) -> None:
        """End the open elements that the start of another one ends."""
        head = self.nearest("head")
        if head is not None and name not in HEAD:
            self.leave(head)
        if name in BREAKOUT:
            for foreign in FOREIGN:
                node = self.nearest(foreign)
                if node is not None:
                    self.leave(node)
        ended = ENDS.get(name, ())
        if not any(self.names.get(n) for n in ended):
            return
        node = self.here
        while node is not self.root:
            if node.name in ended:
                self.leave(node)
                return
            if node.name in HOLDER:
                return
            node = node.parent


def parsed(page: str) -> Node:
    """The tree of a page."""
    tree = _Tree()
    at, size = 0, len(page)
    while at < size:
        found = _TOKEN.search(page, at)
        text = page[at : found.start() if found else size]
        if text:
            if text.strip() and tree.here.name == "head":
                tree.make_room("body")
            tree.here.inside.append(text)
        if not found:
            break
        at = found.end()
        name = (found[2] or "").lower()
        if not name:
            continue
        if found[1]:
            tree.end_tag(name)
            continue
        tree.make_room(name)
        node = Node(name, tree.here)
        _judged(node, found[3])
        tree.here.inside.append(node)
        closed = page[at - 2 : at] == "/>"
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else size
        elif name not in VOID and not (closed and (name in FOREIGN or _in_foreign(tree))):
            tree.enter(node)
    _settle(tree.root)
    return tree.root


def _in_foreign(tree: _Tree) -> bool:
    return any(tree.names.get(n) for n in FOREIGN)


def _settle(root: Node) -> None:
    """Leave out the doubtful parts of an article that are short or mostly links."""
    order, stack = [], [(root, False)]
    while stack:
        node, linked = stack.pop()
        order.append((node, linked))
        stack += [(c, linked or c.name == "a") for c in node.inside if isinstance(c, Node) and not c.out]
    size: dict[int, list[int]] = {id(node): [0, 0] for node, _ in order}
    for node, linked in reversed(order):
        chars, links = size[id(node)]
        own = sum(len(c.strip()) for c in node.inside if isinstance(c, str))
        chars, links = chars + own, links + (own if linked else 0)
        if node.doubtful and (chars < FURNITURE_CHARS or links > chars * MOST_LINKED):
            node.out = True
        elif node.parent is not None:
            up = size[id(node.parent)]
            up[0] += chars
            up[1] += links


def _measured(root: Node) -> list[Node]:
    """Fill in text lengths and points, children before parents; return the elements that got points."""
    order, stack = [], [(root, False)]
    while stack:
        node, linked = stack.pop()
        order.append((node, linked))
        for child in node.inside:
            if isinstance(child, Node) and not child.out:
                stack.append((child, linked or child.name == "a"))
    scored: dict[int, Node] = {}
    for node, linked in reversed(order):
        own = [c for c in node.inside if isinstance(c, str)]
        text = sum(len(c.strip()) for c in own)
        node.chars += text
        node.linked += text if linked else 0
        if node.parent is not None:
            node.parent.chars += node.chars
            node.parent.linked += node.linked
        blocks = any(isinstance(c, Node) and c.name in PARAGRAPH and not c.out for c in node.inside)
        direct = text if blocks else node.chars
        if node.name in PARAGRAPH and direct >= LEAST_PARAGRAPH:
            points = 1 + sum(c.count(",") for c in own) + min(direct // 100, 3)
            up, level = node if blocks else node.parent, 0
            while up is not None and level < 4:
                up.score += points / (1 if level == 0 else 2 if level == 1 else level * 3)
                scored[id(up)] = up
                up, level = up.parent, level + 1
    return list(scored.values())


def _density(node: Node) -> float:
    return node.linked / node.chars if node.chars else 0.0


def _kept(root: Node) -> list[Node]:
    """The best container; outside an article element with what lies beside it and its ancestors and is not mostly links."""
    scored = _measured(root)
    if not scored:
        # No paragraph is long enough to tell: an article element, else the whole page.
        stack = [root]
        while stack:
            node = stack.pop()
            if node.name in ("article", "main") and node.chars:
                return [node]
            stack.extend(c for c in reversed(node.inside) if isinstance(c, Node) and not c.out)
        return [root]
    for node in scored:
        node.score *= 1 - _density(node)
    best = max(scored, key=lambda n: n.score)
    # A paragraph or a part of the article stands for the article it is in.
    up = best.parent
    while up is not None:
        if up.name in ("article", "main") or up.score >= best.score * 0.75:
            best = up
        up = up.parent
    if best.name in ("article", "main"):
        return [best]
    while best.parent is not None:
        best.parent.inside = [c for part in _parts(best.parent) if best in part or not _link_dense(part) for c in part]
        best = best.parent
    return [best]


def _parts(node: Node) -> list[list[Node | str]]:
    """What is in a node: each block element on its own, what stands between them together."""
    parts: list[list[Node | str]] = [[]]
    for child in node.inside:
        if isinstance(child, Node) and child.name in BLOCK:
            parts += [[child], []]
        else:
            parts[-1].append(child)
    return parts


def _link_dense(part: list[Node | str]) -> bool:
    chars = sum(len(c.strip()) if isinstance(c, str) else 0 if c.out else c.chars for c in part)
    return sum(c.linked for c in part if isinstance(c, Node) and not c.out) > chars * MOST_LINKED


def main_text(page: str) -> str:
    """The main text of a page."""
    blocks: list[str] = []
    line: list[str] = []

    def end() -> None:
        text = _SPACE.sub(" ", unescape("".join(line))).strip()
        if text:
            blocks.append(text)
        line.clear()

    for top in _kept(parsed(page)):
        stack: list[Node | str | None] = [None, top]
        while stack:
            node = stack.pop()
            if node is None:
                end()
            elif isinstance(node, str):
                line.append(node)
            elif not node.out:
                if node.name in BLOCK:
                    end()
                    stack.append(None)
                stack.extend(reversed(node.inside))
    end()
    return " ".join(blocks)


def extracted(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``(page_id, url, text, n_chars)`` of every page."""
    named = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            found = [main_text(row.decode()) for row in texts(piece.column(2))]
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), piece.column(1), pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    kinds = [pages.schema[c].dataType.simpleString() for c in (page_id, url)]
    return map_batches(named, work, f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars long")


def text_of_pages(spark, sf_dir: str) -> DataFrame:
    """op2: main text of every page."""
    return extracted(spark.read.parquet(f"{sf_dir}/pages.parquet"))
