"""A tolerant reader of HTML that keeps what the extraction of main text needs.

Only elements that break lines become nodes; others, such as links and emphasis,
belong to the text of the node they stand in. Elements left open are closed as
browsers do it for paragraphs, list items and table cells, and at the end of the page.
"""

from __future__ import annotations

import html as references
import re
from collections import Counter
from typing import NamedTuple

# Kinds of HTML elements.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
VOID = frozenset("area base basefont br col embed frame hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes script style textarea title xmp".split())
SILENT = frozenset("audio button canvas datalist head iframe math noembed noframes noscript object option script select style svg template textarea title video xmp".split())
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr li main menu nav ol p pre search section summary table ul".split()
)
# What a new element ends if it is still open, up to the element that holds both.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"tr", "thead", "tbody"}, {"table"}),
    "tfoot": ({"tr", "thead", "tbody"}, {"table"}), "option": ({"option"}, {"select", "datalist"}),
}

# A value in quotes may hold any character, and runs to the end of the page if the quote is never closed.
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*(?:\"|\Z)|=\s*'[^']*(?:'|\Z)|[^>=]|=)*+)>?", re.S
)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
NAMING = frozenset(("class", "id", "role", "itemprop"))


class Node(NamedTuple):
    """One element: its place among the nodes, what its attributes are called, and its own text."""

    tag: str
    parent: int
    depth: int
    tokens: frozenset[str]
    label: str | None


class Page(NamedTuple):
    """Nodes in page order, the end of each subtree, and the blocks of text as (node, text, characters in links)."""

    nodes: list[Node]
    ends: list[int]
    blocks: list[tuple[int, str, int]]
    counts: list[Counter]


def _tokens(attributes: str) -> tuple[frozenset[str], str | None]:
    found, label = set(), None
    if "=" in attributes:
        for name, *values in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), "".join(values)
            if name in NAMING:
                found.update(t.lower() for t in _TOKEN.findall(value))
            elif name == "data-label":
                label = value
    return frozenset(found), label


class _Reader:
    def __init__(self) -> None:
        self.nodes = [Node("#page", -1, 0, frozenset(), None)]
        self.ends, self.counts = [0], [Counter()]
        self.blocks: list[tuple[int, str, int]] = []
        self.stack, self.open = [0], Counter()
        self.parts: list[str] = []
        self.linked, self.link_chars, self.silent = False, 0, 0

    def flush(self) -> None:
        if self.parts:
            if text := " ".join("".join(self.parts).split()):
                self.blocks.append((self.stack[-1], text, min(self.link_chars, len(text))))
            self.parts = []
        self.linked, self.link_chars = False, 0

    def pop(self) -> None:
        self.flush()
        node = self.stack.pop()
        tag = self.nodes[node].tag
        self.open[tag] -= 1
        self.silent -= tag in SILENT
        self.ends[node] = len(self.nodes)

    def start(self, tag: str, attributes: str) -> None:
        top = self.nodes[self.stack[-1]].tag
        if top == "p" and tag in ENDS_PARAGRAPH:
            self.pop()
        if tag in ENDS and any(self.open[t] for t in ENDS[tag][0]):
            ended, within = ENDS[tag]
            deepest = len(self.stack)
            for at in range(len(self.stack) - 1, 0, -1):
                above = self.nodes[self.stack[at]].tag
                if above in within:
                    break
                if above in ended:
                    deepest = at
            while len(self.stack) > deepest:
                self.pop()
        if tag in VOID:
            if tag in ("br", "hr"):
                self.parts.append(" ")
            self.counts[self.stack[-1]][tag] += 1
            if tag == "hr":
                self.flush()
            return
        self.flush()
        parent = self.stack[-1]
        self.stack.append(len(self.nodes))
        self.nodes.append(Node(tag, parent, self.nodes[parent].depth + 1, *_tokens(attributes)))
        self.ends.append(len(self.nodes))
        self.counts.append(Counter())
        self.open[tag] += 1
        self.silent += tag in SILENT

    def end(self, tag: str) -> None:
        if self.open[tag]:
            while self.nodes[self.stack[-1]].tag != tag:
                self.pop()
            self.pop()

    def text(self, raw: str) -> None:
        if raw and not self.silent:
            text = references.unescape(raw) if "&" in raw else raw
            self.parts.append(text)
            if self.linked:
                self.link_chars += len(text)


def read_page(html: str) -> Page:
    """The nodes and blocks of a page. White space inside a block is one space; a line break is white space."""
    reader, at = _Reader(), 0
    while tag := _TAG.search(html, at):
        reader.text(html[at : tag.start()])
        at = tag.end()
        closing, name, attributes = tag.groups()
        if name is None:
            continue
        name = name.lower()
        if name == "a":
            reader.linked = not closing
        elif name in INLINE:
            continue
        elif closing:
            reader.end(name)
        else:
            reader.start(name, attributes)
            if name in RAW:
                over = re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I).search(html, at)
                at = over.end() if over else len(html)
                reader.pop()
    reader.text(html[at:])
    while reader.stack:
        reader.pop()
    return Page(reader.nodes, reader.ends, reader.blocks, reader.counts)
