"""Main text of HTML pages by tree scoring.

A page becomes a tree. Each paragraph-like block has points for its length and its commas, and passes
them to its parent in full, to its grandparent by half, and further up by less. A container's points are discounted by
the share of its text that lies in links. The best container is kept; if it lies in an article or
main element, that is the container. Its siblings are kept if they score well themselves or are prose
paragraphs. Elements that never hold the article (menus, headers, footers, sidebars, notices,
adverts, forms, scripts, styles, reader comments), by name, role or class, are left out before and after.

Block texts: character references decoded, white space inside a block one space, trimmed; blocks in
page order, joined by one space. Each page is handled by itself in its task.

Defined cases: a null or empty page, or one without text, gives the empty text; unclosed and stray
tags are repaired; a very long page costs time and memory in proportion; repeated rows give equal rows; an empty table an empty result.
"""

from __future__ import annotations

import html as references
import re
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A quote counts after an equals sign only, a tag that never ends takes the rest of the page: both as browsers do. What was
#: read is not tried again in another way, so a page is read once.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*+>?"
    r"|<(?P<close>/?)(?P<name>[A-Za-z][^\s/>]*+)(?P<rest>(?:=\s*+(?>\"[^\"]*+\"|'[^']*+')|[^>])*+)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"""(?<![^\s"'/])(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?(?![\w-])""", re.I)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe xmp noembed noframes".split())
NEVER = frozenset("""script style noscript template textarea title iframe nav header footer aside form button select option
    input label fieldset head menu dialog object svg math canvas audio video map figure figcaption""".split()) - {"figure", "figcaption"}
BLOCK = frozenset("""address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul br""".split()) - {"br"}
CLOSES_P = BLOCK - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "br"}
PARAGRAPH = frozenset("p pre blockquote td dd li div section article main h1 h2 h3 h4 h5 h6".split())
SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
STOP = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}

#: Words of class, id and role names that mark what is not the article.
BOILERPLATE = frozenset("""ad ads adv advert adverts advertisement advertising adbox adslot banner banners sponsor sponsored promo promotion
    promotions nav navbar navigation menu menus menubar breadcrumb breadcrumbs pagination pager header masthead footer foot sidebar
    sidebars aside widget widgets related recommended recommendations share sharing social comment comments commentlist disqus
    discussion replies reply respond notice notices alert alerts cookie cookies consent gdpr popup modal overlay newsletter subscribe subscription signup
    login search searchform form copyright legal tags toc toolbar skip outbrain taboola complementary contentinfo dialog""".split())
#: Words that mark the article in spite of these.
CONTENT = frozenset("article content main post entry story body text".split())
SPLIT = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[0-9])")
CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
#: Elements nested deeper are kept as siblings, as browsers do; their text stays.
DEEPEST = 512
#: Ancestors that a paragraph passes points to.
LEVELS = 6
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Node:
    __slots__ = ("name", "parent", "children", "names", "skip", "points", "chars", "linked", "depth", "block")

    def __init__(self, name, parent, names=(), skip=False):
        self.name, self.parent, self.names, self.skip = name, parent, names, skip
        self.depth = parent.depth + 1 if parent else 0
        self.block = self if parent is None or name in BLOCK else parent.block
        self.children: list = []  # nodes and texts
        self.points, self.chars, self.linked = 0.0, 0, 0


def attributes(rest: str) -> tuple[frozenset, bool]:
    """Words of class, id and role; whether the element is hidden."""
    names, hidden = [], False
    for key, value in ATTRIBUTE.findall(rest):
        key, value = key.lower(), value.strip("\"'")
        if key in ("class", "id", "role"):
            names += SPLIT.split(CAMEL.sub(" ", value).lower())
        elif key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and HIDDEN.search(value):
            hidden = True
    return frozenset(names), hidden


def parse(page: str) -> Node:
    root = node = Node("root", None)
    at, n = 0, len(page)
    while at < n:
        m = TOKEN.search(page, at)
        if m is None:
            node.children.append(references.unescape(page[at:]))
            break
        if m.start() > at:
            node.children.append(references.unescape(page[at : m.start()]))
        at = m.end()
        if m["cdata"] is not None:
            node.children.append(m["cdata"])
            continue
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        if m["close"]:
            up = node
            while up is not root and up.name != name:
                # a stray inline end tag does not end blocks
                if name not in BLOCK and up.name in BLOCK:
                    up = root
                    break
                up = up.parent
            if up is not root:
                node = up.parent
            continue
        if name in ("html", "body") and any(True for x in path(node) if x.name == name):
            continue
        if name in CLOSES_P:
            node = end(node, ("p",), ("table", "td", "th", "li", "blockquote", "div", "section", "article", "main", "aside", "header", "footer", "nav", "form", "button"))
        if name in SAME:
            node = end(node, SAME[name], STOP[name])
        if name[0] == "h" and name[1:].isdigit():
            node = end(node, ("h1", "h2", "h3", "h4", "h5", "h6"), tuple(BLOCK - {"h1", "h2", "h3", "h4", "h5", "h6"}))
        names, hidden = attributes(m["rest"]) if m["rest"] else (frozenset(), False)
        odd = bool(names & BOILERPLATE) and not (names & CONTENT and not names & {"comment", "comments", "sidebar", "footer", "nav", "menu", "ad", "ads", "advert", "advertisement"})
        child = Node(name, node, names, hidden or name in NEVER or odd and name not in ("html", "body", "article", "main"))
        node.children.append(child)
        if name in RAW:
            close = re.compile(rf"</{name}\b[^>]*>?", re.I).search(page, at)
            at = close.end() if close else n
        elif name not in VOID and not m["rest"].endswith("/") and child.depth < DEEPEST:
            node = child
    return root


def path(node):
    while node is not None:
        yield node
        node = node.parent


def end(node: Node, names: tuple, stop: tuple) -> Node:
    """The node to go on from when an open element of these names ends by itself."""
    for x in path(node):
        if x.name in names:
            return x.parent
        if x.name in stop or x.parent is None:
            return node
    return node


def ordered(root: Node) -> list[tuple[Node, bool]]:
    """Nodes that are not left out, parents first, each with whether it lies in a link."""
    out, stack = [], [(root, False)]
    while stack:
        node, link = stack.pop()
        if node.skip:
            continue
        link = link or node.name == "a"
        out.append((node, link))
        stack += [(c, link) for c in reversed(node.children) if not isinstance(c, str)]
    return out


def rated(root: Node) -> list[Node]:
    """Fill in characters, link shares and points; the nodes that got points."""
    nodes = ordered(root)
    prose: dict[int, list] = {}
    for node, link in nodes:
        text = " ".join("".join(c if isinstance(c, str) else " " for c in node.children).split())
        node.chars, node.linked = len(text), len(text) if link else 0
        # text of inline elements counts for the block that they are in
        entry = prose.setdefault(id(node.block), [node.block, 0, 0])
        entry[1] += len(text)
        entry[2] += text.count(",") + text.count("、")
    for node, _ in reversed(nodes):
        if node.parent is not None:
            node.parent.chars += node.chars
            node.parent.linked += node.linked
    got = {}
    for block, chars, commas in prose.values():
        if chars < 25 or block.name not in PARAGRAPH or block.linked > 0.5 * block.chars:
            continue
        points = 1 + commas + min(chars / 100, 3)
        if block.name in ("div", "section", "article", "main"):  # text of its own
            block.points += points
            got[id(block)] = block
        for level, up in enumerate(islice((x for x in path(block.parent) if x.block is x), LEVELS)):
            up.points += points if level == 0 else points / 2 if level == 1 else points / (level * 3)
            got[id(up)] = up
    for node in got.values():
        node.points *= 1 - node.linked / max(1, node.chars)
        if node.name in ("article", "main"):
            node.points *= 1.25
    return list(got.values())


def chosen(root: Node) -> list[Node]:
    """The best container with its good siblings, in page order; the body if no block has points."""
    scored = rated(root)
    if not scored:
        return [root]
    best = max(scored, key=lambda x: x.points)
    for up in path(best):
        if up.name in ("article", "main") or "main" in up.names and up.name not in ("html", "body"):
            best = up
    parent = best.parent
    if parent is None or parent.name in ("html", "root") or best.name == "body":
        return [best]
    out = []
    for x in parent.children:
        if isinstance(x, str) or x.skip:
            continue
        links = x.linked / max(1, x.chars)
        good = x is best or x.points >= max(10, 0.2 * best.points) or x.name == best.name and x.names and x.names == best.names
        if good or x.name in ("p", "pre", "blockquote") and (x.chars > 80 and links < 0.25 or x.chars and not x.linked):
            out.append(x)
        elif x.name in ("h1", "h2", "h3", "h4", "h5", "h6") and not x.linked and x.chars:
            out.append(x)
    return out


def block_texts(nodes: list[Node]) -> list[str]:
    out, parts = [], []

    def flush():
        text = " ".join("".join(parts).split())
        parts.clear()
        if text:
            out.append(text)

    stack: list = list(reversed(nodes))
    while stack:
        x = stack.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            parts.append(x)
        elif not x.skip:
            if x.name in BLOCK or x.parent is None:
                flush()
                stack.append(None)
            elif x.name in ("br", "wbr"):
                parts.append(" " if x.name == "br" else "")
            stack += reversed(x.children)
    flush()
    return out


def main_text(page: str | None) -> str:
    return " ".join(block_texts(chosen(parse(page)))) if page else ""


def extracted(name: str):
    def run(batches):
        for batch in batches:
            texts = [main_text(x) for x in batch.column(name).to_pylist()]
            kept = batch.drop_columns([name])
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(texts, pa.string())], [*kept.schema.names, "text"])

    return run


def extract(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The `keep` columns and the main text of every row of `pages`."""
    kept = pages.select(*keep, F.col(html_col).alias("_html"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name != "_html")
    return kept.mapInArrow(extracted("_html"), f"{schema}, text string")
