"""Main text of web pages by composite text density.

For each node of a page the density is its characters over its tags, adjusted by links: text
inside links counts against a node, more so in pages whose body is mostly links. A node's density
sum is the sum over its children; texts beside blocks count as children. The threshold is the
smallest density on the path from the body to the node with the largest density sum, or the median
density of that node's blocks if it is less: densities grow with the size of a node, and a shorter
section of the same prose is no less a part of the article. From the body
down, every branch whose density reaches the threshold gives its subtree with the largest density
sum. The blocks of these and the headings right before them, in page order, are the result.

Elements that never hold prose of the article (navigation, scripts, forms, asides, and elements
named as adverts, comments and the like) are left out before anything is counted.

Scale: one pass, no shuffle; each page is parsed by itself in linear time, and memory is bounded by
an Arrow batch and the largest single page.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator
from statistics import median_low

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import pack, tune_arrow, unpack

# Elements of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp".split())
SKIP = frozenset(
    "script style textarea title noscript iframe noembed noframes head nav footer aside form "
    "button select option input label fieldset template svg math canvas object embed audio video "
    "menu dialog map".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small "
    "span strike strong sub sup time tt u var wbr img br ruby rt rp".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
# An open element on the left is closed by the start of one on the right.
CLOSED_BY = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "thead", "tfoot"]),
    "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "option": frozenset(["option", "optgroup"]),
}
# Where a search for an open element to close ends.
SCOPE = frozenset("table ul ol dl select html body article section div main".split())

# Words in class, id or role that name boilerplate; matched as whole words of the value.
BOILERPLATE = frozenset(
    "ad ads advert adverts advertisement advertising banner promo promoted promotion sponsor "
    "sponsored sponsors nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar aside "
    "footer masthead toolbar comment comments reply replies respond disqus cookie cookies consent "
    "gdpr notice notices newsletter subscribe subscription signup login share sharing social "
    "related recommended popup modal overlay search pagination pager widget widgets complementary "
    "contentinfo dialog form alert".split()
)
# Words before which a word names what the element has or lacks, not what it is.
MODIFIERS = frozenset("has no not with without hide".split())
COMMENTS = frozenset("comment comments reply replies respond disqus".split())
# A named element stays if it holds more than this share of the page's text; one that is named for
# comments, which may outgrow the article, only if it holds more than the second.
MOST, MOST_COMMENTS = 0.5, 0.8
# Elements whose class or id is not taken as boilerplate: they hold the page or the article.
NEVER_BOILERPLATE = frozenset(["html", "body", "article", "main"])

TOKEN = re.compile(
    r"<!--(?P<comment>.*?)(?:--!?>|\Z)|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)"
    r"(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?/][^>]*>",
    re.DOTALL,
)
ATTR = re.compile(
    r"(?<![\w-])(?P<name>class|id|role|hidden|style|aria-hidden)(?![\w-])"
    r"(?:\s*=\s*(?:\"(?P<d>[^\"]*)\"|'(?P<s>[^']*)'|(?P<u>[^\s\"'>]+)))?",
    re.IGNORECASE,
)
WORD_SPLIT = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[A-Z])")
HIDDEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
SPACE = re.compile(r"\s+")


RUN = "#run"
HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])


class Node:
    """An element; `parts` holds texts and child nodes in page order.

    A node with the tag RUN holds the texts and inline elements between two blocks. `top` is the
    block with the largest density sum below a node, or itself; `around` the nearest article or main
    element that a node is or is in.
    """

    __slots__ = ("tag", "parent", "parts", "skip", "named", "held", "chars", "tags", "link_chars", "link_tags",
                 "density", "density_sum", "block", "top", "around")

    def __init__(self, tag: str, parent: Node | None, skip: bool, named: frozenset = frozenset()):
        self.tag, self.parent, self.parts, self.skip = tag, parent, [], skip
        self.named = named
        self.around = self if tag in ("article", "main") else parent and parent.around


def naming(value: str) -> frozenset[str]:
    """The words of a class, id or role that name boilerplate."""
    split = re.sub(r"(?<=[a-z])(?=[A-Z])", " ", value).lower()
    words = re.split(r"[^a-z0-9]+", split)
    return frozenset(
        w for before, w in zip(["", *words], words) if w in BOILERPLATE and before not in MODIFIERS
    )


def left_out(tag: str, attrs: str) -> tuple[bool, frozenset[str]]:
    """(whether an element is left out whatever it holds, the boilerplate words that name it)."""
    if tag in SKIP and tag != "form":
        return True, frozenset()
    named = frozenset(["form"]) if tag == "form" else frozenset()
    if not attrs or tag in NEVER_BOILERPLATE:
        return False, named
    for found in ATTR.finditer(attrs):
        name = found["name"].lower()
        value = found["d"] or found["s"] or found["u"] or ""
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True, named
        if name == "style":
            if HIDDEN_STYLE.search(value):
                return True, named
        elif name in ("class", "id", "role"):
            named |= naming(value)
    return False, named


def parse(page: str) -> Node:
    """The tree of a page. Unclosed elements are closed as browsers do; a page header within an
    article stays, one outside is left out."""
    root = current = Node("html", None, False)
    open_articles = at = 0
    any_named = False
    length = len(page)
    last_end = page.rfind(">") + 1  # no tag ends after it
    while at < length:
        found = TOKEN.search(page, at) if at < last_end or "<!--" in page[at:] else None
        if found is None:
            current.parts.append(page[at:])
            break
        if found.start() > at:
            current.parts.append(page[at : found.start()])
        at = found.end()
        tag = (found["tag"] or "").lower()
        if not tag:
            continue
        if found["close"]:
            node = current
            while node is not root and node.tag != tag:
                # A stray end tag does not close the article around it.
                if node.tag in ("article", "main", "td", "body") and tag not in (
                    "html", "body", "main", "table"):
                    node = root
                    break
                node = node.parent
            if node is not root:
                open_articles -= _articles(current, node.parent)
                current = node.parent
            continue
        if tag in ("html", "body"):
            continue
        if tag in CLOSES_P or tag in CLOSED_BY:
            target = _closed_by(current, tag, root)
            if target is not None:
                open_articles -= _articles(current, target)
                current = target
        always, named = left_out(tag, found["attrs"])
        always = always or (tag == "header" and not open_articles)
        any_named = any_named or bool(named)
        node = Node(tag, current, always or bool(named), frozenset() if always else named)
        current.parts.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*>?", re.IGNORECASE)
            closing = end.search(page, at)
            at = closing.end() if closing else length
        elif tag not in VOID and not found["attrs"].endswith("/"):
            open_articles += tag == "article"
            current = node
    if any_named:
        _restore(root)
    return root


def _restore(root: Node) -> None:
    """Take back the elements that were left out by their name and hold most of the page's text.

    Where an article or main element has text elsewhere, a name is believed whatever it holds.
    """
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(p for p in node.parts if isinstance(p, Node) and (p.named or not p.skip))
    for node in reversed(order):
        node.held = sum(
            len("".join(p.split())) if isinstance(p, str) else p.held if p.named or not p.skip else 0
            for p in node.parts
        )
    mains = [n for n in order if n.tag in ("article", "main") and n.held]
    for node in order:
        share = MOST_COMMENTS if node.named & COMMENTS else MOST
        if node.named and node.held > share * root.held:
            if all(_above(node, m) or _above(m, node) for m in mains):
                node.skip = False


def _above(node: Node, below: Node | None) -> bool:
    """Whether `below` is `node` or lies in it."""
    while below is not None and below is not node:
        below = below.parent
    return below is node


def _articles(node: Node, until: Node) -> int:
    count = 0
    while node is not until:
        count += node.tag == "article"
        node = node.parent
    return count


def _closed_by(current: Node, tag: str, root: Node) -> Node | None:
    """The new current node if the start of `tag` closes an open p, li, td and so on."""
    node, target = current, None
    while node is not root:
        if (node.tag == "p" and tag in CLOSES_P) or tag in CLOSED_BY.get(node.tag, ()):
            target = node.parent
            if node.tag != "td" and node.tag != "th":
                return target
        elif node.tag in SCOPE:
            break
        node = node.parent
    return target


def _visible(text: str) -> int:
    return len("".join(html.unescape(text).split()))


def _postorder(root: Node) -> list[Node]:
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(p for p in node.parts if isinstance(p, Node) and not p.skip)
    order.reverse()
    return order


def _wrap_runs(root: Node) -> None:
    """Put what stands between blocks into nodes of its own, where a node has both."""
    for node in _postorder(root):
        inner = [isinstance(p, Node) and not p.skip and p.block for p in node.parts]
        node.block = node is root or node.tag not in INLINE or any(inner)
        if not any(inner):
            continue
        parts, node.parts, run = node.parts, [], None
        for part, block in zip(parts, inner, strict=True):
            if block or (isinstance(part, Node) and part.skip and part.tag not in INLINE):
                node.parts.append(part)
                run = None
                continue
            if run is None:
                run = Node(RUN, node, False)
                run.block = True
                node.parts.append(run)
            run.parts.append(part)
            if isinstance(part, Node):
                part.parent = run


def densities(root: Node) -> list[Node]:
    """Fill the counts and densities of all nodes that are not left out; children come first."""
    _wrap_runs(root)
    order = _postorder(root)
    for node in order:
        node.chars = node.tags = node.link_chars = node.link_tags = 0
        for part in node.parts:
            if isinstance(part, str):
                node.chars += _visible(part)
            elif not part.skip:
                node.chars += part.chars
                node.tags += part.tags + (part.tag != RUN)
                node.link_chars += part.link_chars
                node.link_tags += part.link_tags + (part.tag == "a")
        if node.tag == "a":
            node.link_chars = node.chars
    body = order[-1]
    body_links = body.link_chars / max(1, body.chars)
    for node in order:
        chars, tags = node.chars, max(1, node.tags)
        links, link_tags = max(1, node.link_chars), max(1, node.link_tags)
        if chars == 0:
            node.density = 0.0
        else:
            plain = max(1, chars - node.link_chars)
            base = math.log(chars * links / plain + body_links * chars + math.e)
            odds = max(1.0, (chars / links) * (tags / link_tags))
            node.density = chars / tags * math.log(odds, base) if odds > 1 else 0.0
        inner = [p for p in node.parts if isinstance(p, Node) and not p.skip and p.block]
        # A block without blocks stands for itself.
        node.density_sum = sum(p.density for p in inner) if inner else node.density
        node.top = max([node, *(p.top for p in inner)], key=lambda n: n.density_sum)
    return order


def main_nodes(root: Node) -> list[Node]:
    """The nodes that hold the article, in page order; none is inside another.

    From the node with the largest density sum, the path to the body gives the threshold, its
    smallest density, or the median of the node's blocks. A node that does not meet it is left out
    with all below it, but for headings before a node that stays.
    """
    densities(root)
    node = root.top
    inside = [p.density for p in node.parts if isinstance(p, Node) and not p.skip and p.block]
    threshold = median_low(inside or [node.density])
    while node is not None:
        threshold = min(threshold, node.density)
        node = node.parent
    chosen: set[Node] = set()
    stack = [root]
    while stack:
        node = stack.pop()
        if node in chosen or node.density < threshold:
            continue
        # Short blocks of an article, such as its h1, stay with it.
        chosen.add(node.top.around or node.top)
        if node not in chosen:
            stack.extend(
                p for p in reversed(node.parts) if isinstance(p, Node) and not p.skip and p.block
            )
    holding: set[Node] = set()
    for node in chosen:
        while node is not None and node not in holding:
            holding.add(node)
            node = node.parent
    found, stack = [], [root]
    while stack:
        node = stack.pop()
        if node in chosen:
            found.append(node)
        elif node in holding:
            kept, before = [], False
            for part in reversed(node.parts):
                if not isinstance(part, Node) or part.skip:
                    continue
                if part in holding or (before and part.tag in HEADINGS):
                    kept.append(part)
                    before = True
                elif part.density_sum != part.density:
                    before = False  # a heading before such a part belongs to it
            stack.extend(kept)
        else:
            found.append(node)
    return found


def blocks(node: Node) -> list[str]:
    """Texts of the blocks below a node in page order: white space is one space, ends trimmed."""
    found: list[str] = []
    run: list[str] = []

    def close() -> None:
        text = SPACE.sub(" ", "".join(run)).strip()
        run.clear()
        if text:
            found.append(text)

    stack = [iter(node.parts)]
    block = [True]
    while stack:
        part = next(stack[-1], None)
        if part is None:
            stack.pop()
            if block.pop():
                close()
        elif isinstance(part, str):
            run.append(html.unescape(part))
        elif part.skip:
            if part.tag not in INLINE:
                close()
        elif part.tag == "br" or part.tag == "hr":
            run.append(" ")
            if part.tag == "hr":
                close()
        else:
            is_block = part.tag not in INLINE
            if is_block:
                close()
            stack.append(iter(part.parts))
            block.append(is_block)
    close()
    return found


def main_text(page: str | None) -> str:
    """The article of a page, one block per line."""
    if not page:
        return ""
    return "\n".join(text for node in main_nodes(parse(page)) for text in blocks(node))


def main_texts():
    """Pandas UDF: `main_text` of each page."""

    @F.pandas_udf("string")
    def read(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pd.Series([main_text(page) for page in pages], dtype=object)

    return read


def extract_main_text(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """`pages` with `text`, the main text (empty if there is none), and `n_chars`, its code points.

    Null or empty html gives empty text. Markup that is cut off or wrongly nested is read as far
    as it goes. Each row is read by itself, so equal rows give equal results. Other columns pass
    through; a column named like a result is replaced. Empty table: no rows.
    """
    tune_arrow(pages.sparkSession)
    read = pages.select(
        pack(pages), main_texts()(F.col(f"`{html_col}`").cast("string")).alias("_text")
    )
    return unpack(
        read,
        pages.columns,
        text=F.col("_text"),
        n_chars=F.length("_text").cast("bigint"),
    )
