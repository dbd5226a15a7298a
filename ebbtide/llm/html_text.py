"""Main text of web pages by composite text density.

Every element has its number of characters and tags and those inside links; its density is characters per tag,
lowered by a logarithm whose base grows with the share of link text. The subtree with the largest sum of child
densities holds the article; the least density on its path to the body is the threshold above which further
subtrees are kept."""

from __future__ import annotations

import html
import math
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.common import text_batches

# Element names by their role in HTML, and words that name page furniture.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = set(
    "script style noscript template head title meta link svg math canvas object embed iframe audio video map "
    "nav header footer aside menu form button select option textarea input label fieldset dialog textarea noframes".split()
)
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark nobr q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr img".split()
)
# An element that ends an open one of the listed kinds, up to the given barrier.
CLOSES = {
    **{t: ({"p"}, {"button", "table", "td", "th"}) for t in (
        "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 "
        "h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul"
    ).split()},
    "li": ({"li"}, {"ul", "ol", *HIDDEN}),
    "dt": ({"dt", "dd"}, {"dl", *HIDDEN}),
    "dd": ({"dt", "dd"}, {"dl", *HIDDEN}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
FURNITURE = set(
    "ad ads advert adverts advertisement advertising adbox adslot sponsor sponsored promo promotion banner sidebar "
    "side menu nav navbar navigation breadcrumb breadcrumbs footer header masthead topbar toolbar cookie cookies "
    "consent gdpr notice popup modal overlay newsletter subscribe subscription signup login share sharing social "
    "related recommended recommendations comment comments reply replies disqus respond widget pagination pager "
    "copyright legal disclaimer hidden skip toc".split()
)
LAYOUT = ("has-", "with-", "no-", "is-", "without-")  # such a class tells of the furniture elsewhere
ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|$)|'[^']*(?:'|$))*)(>|$)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""(?:^|\s|["'/])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)|(?=[\s/]|$))""", re.I)
_WORDS = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")
_SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("name", "parent", "children", "chars", "tags", "link_chars", "link_tags", "density", "total", "hidden", "article")

    def __init__(self, name: str, parent: Node | None, hidden: bool = False):
        """A hidden element knows its parent, whose end ends it too, but is not among its children."""
        self.name, self.parent, self.children, self.hidden = name, parent, [], hidden
        self.article = self if name in ("article", "main") else parent.article if parent is not None else None
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0
        if parent is not None and not hidden:
            parent.children.append(self)


def _is_furniture(name: str, attributes: str, by_attributes: bool, open_form: bool) -> bool:
    if name in HIDDEN:
        return not (open_form and name == "form")
    if not by_attributes:
        return False
    for key, value in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return True
        if key == "role" and value.lower() in ROLES:
            return True
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
        if key in ("class", "id") and name not in ("body", "html", "main", "article"):
            parts = (part for part in value.split() if not part.lower().startswith(LAYOUT))
            if any(word.lower() in FURNITURE for part in parts for word in _WORDS.findall(part)):
                return True
    return False


def parse(page: str, by_attributes: bool = True, open_form: bool = False) -> Node:
    """A tree of elements and strings without page furniture. Missing end tags are supplied as HTML does.

    Open elements are kept with their depths by name, so that one is found, or found missing, without a climb."""
    root = Node("body", None)
    here, at, depth = root, 0, 0
    opened: dict[str, list[int]] = defaultdict(list)

    def leave(names: set[str], barrier: set[str]) -> tuple[Node, int]:
        target = max((opened[name][-1] for name in names if opened[name]), default=0)
        if target <= max((opened[name][-1] for name in barrier if opened[name]), default=0):
            return here, depth
        node = here
        for _ in range(depth - target + 1):
            opened[node.name].pop()
            node = node.parent
        return node, target - 1

    while at < len(page):
        token = _TOKEN.search(page, at)
        if not here.hidden and (text := page[at : token.start() if token else len(page)]):
            here.children.append(html.unescape(text))
        if not token:
            break
        at = token.end()
        closing, name, attributes, end = token.groups()
        if name is None or not end:
            continue
        name = name.lower()
        if name in ("html", "body"):
            continue
        if closing:
            outer, depth = leave({name}, set())
            if outer is here and name == "p" and not here.hidden:
                Node("br", here)
            here = outer
            continue
        single = name in VOID or attributes.rstrip().endswith("/") and name not in INLINE and name not in CLOSES
        if name in RAW and not single:
            done = re.compile(rf"</{re.escape(name)}\s*>?", re.I).search(page, at)
            at = done.end() if done else len(page)
            if not here.hidden and name not in INLINE:
                Node("br", here)
            continue
        if name in CLOSES:
            here, depth = leave(*CLOSES[name])
        hidden = here.hidden
        if not hidden and _is_furniture(name, attributes, by_attributes, open_form):
            Node("br", here)
            hidden = True
        node = Node(name, here, hidden)
        if not single:
            depth += 1
            opened[name].append(depth)
            here = node
    return root


def measure(root: Node) -> list[Node]:
    """Counts and densities of all elements, children first; returned in that order."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(c for c in node.children if isinstance(c, Node))
    order.reverse()
    for node in order:
        for child in node.children:
            if isinstance(child, str):
                node.chars += len(_SPACE.sub(" ", child).strip())
            else:
                node.chars += child.chars
                node.tags += child.tags + (child.name != "br")
                node.link_chars += child.link_chars
                node.link_tags += child.link_tags + (child.name == "a")
        if node.name == "a":
            node.link_chars, node.link_tags = node.chars, node.tags
    share = root.link_chars / max(root.chars, 1)
    for node in order:
        c, t = max(node.chars, 1), max(node.tags, 1)
        lc, lt = max(node.link_chars, 1), max(node.link_tags, 1)
        if node.chars:
            base = math.log(c / max(c - lc, 1) * lc + share * c + math.e)
            node.density = c / t * max(math.log(c / lc * t / lt, base), 1e-6) if node.link_chars < c else 0.0
        node.total = sum(child.density for child in node.children if isinstance(child, Node))
    return order


def _content(root: Node) -> list[Node]:
    """The subtrees that are kept, in page order."""
    order = measure(root)
    top = max(order, key=lambda n: (n.total, n.density))
    if top.total <= 0:
        return [root]
    path, node = [], top
    while node is not None:
        path.append(node.density)
        node = node.parent
    threshold = min(path)
    kept, best = set(), {}
    for node in order:
        inner = [best[id(c)] for c in node.children if isinstance(c, Node)]
        best[id(node)] = max([node, *inner], key=lambda n: n.total)
    stack = [root]
    while stack:
        node = stack.pop()
        if node.density >= threshold - 1e-9:
            # A subtree of an article stands for all of it, with its thinly worded blocks.
            chosen = best[id(node)] if best[id(node)].total > 0 else node
            kept.add(id(chosen.article or chosen))
            stack.extend(c for c in node.children if isinstance(c, Node))
    found, stack = [], [root]
    while stack:
        node = stack.pop()
        if id(node) in kept:
            found.append(node)
        else:
            stack.extend(c for c in reversed(node.children) if isinstance(c, Node))
    return found


def _blocks(nodes: list[Node]) -> Iterator[str]:
    """The text between the borders of block elements. Where the whole page is kept, its lists of links are not."""
    text: list[str] = []
    whole = any(node.parent is None for node in nodes)
    for top in nodes:
        stack: list = [(top, False)]
        while stack:
            node, over = stack.pop()
            if isinstance(node, str):
                text.append(node)
                continue
            if node.name not in INLINE:
                yield "".join(text)
                text = []
                if whole and node.link_tags > 1 and node.link_chars == node.chars:
                    continue
            if not over:
                stack.append((node, True))
                stack.extend((c, False) for c in reversed(node.children))
        yield "".join(text)
        text = []


def _has_article(root: Node) -> bool:
    """Whether there is an element that articles have and mere forms don't need."""
    stack = [root]
    while stack:
        node = stack.pop()
        if node.name in ("article", "main", "p", "h1"):
            return True
        stack.extend(c for c in node.children if isinstance(c, Node))
    return False


def main_text(page: str | None) -> str:
    """The article of a page: blocks in page order joined by line breaks, white space inside a block as one space."""
    if not page:
        return ""
    # Where class names leave nothing, they do not mean what they seem to; and then a form may hold the whole page.
    for by_attributes, open_form in ((True, False), (False, False), (True, True)):
        root = parse(page, by_attributes, open_form)
        if open_form and not _has_article(root):
            continue
        blocks = (_SPACE.sub(" ", block).strip() for block in _blocks(_content(root)))
        if text := "\n".join(block for block in blocks if block):
            return text
    return ""


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(page.as_py()) for page in batch.column(2)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
            names=[*batch.schema.names[:2], "text", "n_chars"],
        )


def extracted_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars): the main text of each page and its number of code points.

    Null and empty pages give an empty text. A page all of which stands in a form is read as if it had none, if it has
    an article, a paragraph or a main heading. Text without any element is its own article. Nothing is cut: a page is
    read whole, a broken last tag is dropped, missing end tags are supplied. Ids and urls pass through, nulls and
    repeats too; other columns are ignored."""
    text_batches(pages.sparkSession)
    kinds = dict(pages.dtypes)
    return pages.select(id_col, url_col, html_col).mapInArrow(
        _extract, f"`{id_col}` {kinds[id_col]}, `{url_col}` {kinds[url_col]}, text string, n_chars bigint"
    )
