"""HTML extraction: boosted trees over the nodes of a page, decoded down the tree.

Every element that breaks lines is a node. Its features are counts of its own text
and of its whole subtree (density, links, signs), its tag and attribute tokens and
those of its ancestors, its depth, its place in the page and how it compares with
its siblings. Boosted trees give each node the odds of being main text, not being
it, or only holding both. Decoding takes the most likely states of the whole page
under which main text holds main text or parts to leave out, parts to leave out hold
nothing else, and only elements that hold both have free choice below them.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.boosting import BoostedTrees
from tidemark.llm.common import whole
from tidemark.llm.dom import Page, read_page
from tidemark.llm.layouts import NAMES, labelled_pages

MIXED, KEEP, DROP = range(3)
LABELS = {"mixed": MIXED, "keep": KEEP, "drop": DROP}
# Labelled pages the model is fitted on, and attribute tokens it knows.
TRAIN_PAGES, MAX_TOKENS = 500, 120
# Characters of pages that are decoded together.
_BATCH_CHARS = 4 << 20

TAGS = (
    "#page html body div p article main section header footer nav aside form ul ol li h1 h2 h3 h4 table tr td th dl dt dd blockquote pre "
    "figure figcaption label fieldset details head script style address ins center"
).split()
_TAG_NUMBER = {t: i for i, t in enumerate(TAGS)}
_SIGNS = ".,;:!?"


class Nodes(NamedTuple):
    """The nodes of several pages one after the other; parents and ends count from the first node of all."""

    tag: np.ndarray
    parent: np.ndarray
    end: np.ndarray
    depth: np.ndarray
    page: np.ndarray
    first: np.ndarray
    own: np.ndarray
    tokens: list[frozenset[str]]


_OWN = ("chars", "words", "links", "signs", "stops", "digits", "capitals", "blocks", "breaks", "images", "inputs", "copyright")


def gather(pages: list[Page]) -> Nodes:
    tag, parent, end, depth, page, first, tokens = [], [], [], [], [], [], []
    own = np.zeros((sum(len(p.nodes) for p in pages), len(_OWN)))
    for number, p in enumerate(pages):
        base = len(tag)
        first.append(base)
        for node, stop in zip(p.nodes, p.ends):
            tag.append(_TAG_NUMBER.get(node.tag, len(TAGS)))
            parent.append(base + node.parent if node.parent >= 0 else base)
            end.append(base + stop)
            depth.append(node.depth)
            tokens.append(node.tokens)
        page += [number] * len(p.nodes)
        for node, text, linked in p.blocks:
            signs = sum(map(text.count, _SIGNS))
            digits = sum(map(text.count, "0123456789"))
            own[base + node] += (
                len(text), text.count(" ") + 1, linked, signs, text[-1] in ".!?:;\"'”»", digits, text[:1].isupper(), 1, 0, 0, 0, "©" in text
            )
        for node, count in enumerate(p.counts):
            if count:
                own[base + node, 8:11] += count["br"], count["img"], count["input"]
    whole_numbers = (np.array(x, np.int64) for x in (tag, parent, end, depth, page, first))
    return Nodes(*whole_numbers, own, tokens)


class Features:
    """What the model sees of a node. The known attribute tokens are the commonest of the training pages."""

    def __init__(self, tokens: list[str]) -> None:
        # a token stands for itself and for the kinds of parts that are called so
        self.place = {t: [i] for i, t in enumerate(tokens)}
        for i, names in enumerate(NAMES.values(), len(tokens)):
            for t in {t for name in names for t in name.split("-")}:
                self.place.setdefault(t, []).append(i)
        self.width = len(tokens) + len(NAMES)

    @classmethod
    def of_training(cls, nodes: Nodes) -> Features:
        seen = Counter(t for page, t in {(p, t) for p, own in zip(nodes.page.tolist(), nodes.tokens) for t in own})
        return cls(sorted(sorted(t for t, n in seen.items() if n >= 3), key=lambda t: -seen[t])[:MAX_TOKENS])

    def matrix(self, nodes: Nodes) -> np.ndarray:
        n, number = len(nodes.tag), np.arange(len(nodes.tag))
        total = np.vstack([np.zeros(len(_OWN)), np.cumsum(nodes.own, axis=0)])
        below = total[nodes.end] - total[number]
        at_page = nodes.first[nodes.page]
        page = below[at_page]
        chars, own = below[:, 0], nodes.own
        up = nodes.parent
        children = np.bincount(up, number != at_page, n)
        rank = self._rank(nodes)
        siblings = np.maximum(children[up], 1)
        largest = np.zeros(n)
        np.maximum.at(largest, up, np.where(number != at_page, chars, 0))
        same = self._same_tag_siblings(nodes)
        per = lambda a, b: a / np.maximum(b, 1)
        inner = nodes.end - number
        before = (total[number] - total[at_page])[:, 0]
        columns = [
            nodes.depth, np.log1p(own[:, 0]), np.log1p(chars), per(own[:, 0], chars), per(below[:, 2], chars), per(own[:, 2], own[:, 0]),
            per(chars, inner), per(below[:, 1], inner), per(chars, below[:, 1]), per(100 * below[:, 3], chars), per(below[:, 4], below[:, 7]),
            per(100 * below[:, 5], chars), per(below[:, 6], below[:, 7]), np.log1p(below[:, 7]), per(chars, below[:, 7]), below[:, 8], below[:, 9], below[:, 10],
            below[:, 11], own[:, 11], per(chars, page[:, 0]), per(chars, chars[up]), per(before, page[:, 0]), per(before + chars, page[:, 0]), np.log1p(inner), children,
            rank, siblings - 1 - rank, per(rank, siblings), per(chars, largest[up]), per(chars * siblings, chars[up]), per(below[:, 2][up], chars[up]),
            same, np.log1p(chars[up]), own[up][:, 0] > 0, np.log1p(page[:, 0]),
        ]
        blocks = [np.stack(columns, axis=1).astype(np.float32)]
        hot = np.zeros((n, len(TAGS) + 1), np.float32)
        hot[number, nodes.tag] = 1
        named = np.zeros((n, self.width), np.float32)
        for i, tokens in enumerate(nodes.tokens):
            for t in tokens:
                named[i, self.place.get(t, [])] = 1
        above = np.hstack([hot, named])
        inherited = np.zeros_like(above)
        tags_below = np.vstack([np.zeros((1, len(TAGS) + 1), np.float32), np.cumsum(hot, axis=0)])
        counts = tags_below[nodes.end] - tags_below[number] - hot
        for level in range(1, int(nodes.depth.max(initial=0)) + 1):
            here = np.flatnonzero(nodes.depth == level)
            inherited[here] = np.maximum(inherited[up[here]], above[up[here]])
        return np.hstack([*blocks, hot, hot[up], named, inherited, np.minimum(counts, 20)])

    @staticmethod
    def _rank(nodes: Nodes) -> np.ndarray:
        """How many siblings stand before a node."""
        rank, order = np.zeros(len(nodes.parent)), np.argsort(nodes.parent, kind="stable")
        parent = nodes.parent[order]
        first = np.r_[True, parent[1:] != parent[:-1]]
        rank[order] = np.arange(len(order)) - np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
        return rank

    @staticmethod
    def _same_tag_siblings(nodes: Nodes) -> np.ndarray:
        _, group, size = np.unique(nodes.parent * (len(TAGS) + 1) + nodes.tag, return_inverse=True, return_counts=True)
        return size[group] - 1


def decode(log_p: np.ndarray, nodes: Nodes) -> np.ndarray:
    """The state of each node: the most likely ones in which KEEP holds KEEP and DROP, and DROP only DROP."""
    score = log_p.copy()
    root = np.arange(len(score)) == nodes.first[nodes.page]
    deepest = int(nodes.depth.max(initial=0))
    levels = [np.flatnonzero((nodes.depth == d) & ~root) for d in range(deepest + 1)]
    for here in reversed(levels):
        own = score[here]
        best = np.stack([own.max(axis=1), np.maximum(own[:, KEEP], own[:, DROP]), own[:, DROP]], axis=1)
        np.add.at(score, nodes.parent[here], best)
    state = np.full(len(score), DROP)
    state[root] = score[root].argmax(axis=1)
    for here in levels:
        above, own = state[nodes.parent[here]], score[here].copy()
        own[above != MIXED, MIXED] = -np.inf
        own[above == DROP, KEEP] = -np.inf
        state[here] = own.argmax(axis=1)
    return state


class Extractor(NamedTuple):
    features: Features
    trees: BoostedTrees

    def states(self, pages: list[Page]) -> tuple[Nodes, np.ndarray]:
        nodes = gather(pages)
        return nodes, decode(self.trees.log_probabilities(self.features.matrix(nodes)), nodes)

    def texts(self, pages: list[Page]) -> list[str]:
        nodes, state = self.states(pages)
        return [
            "\n".join(text for node, text, _ in page.blocks if state[base + node] == KEEP)
            for page, base in zip(pages, nodes.first.tolist())
        ]


def node_labels(page: Page) -> np.ndarray:
    """The labels of a training page; a node without one has that of its parent, and the root holds both."""
    found = []
    for node in page.nodes:
        above = found[node.parent] if node.parent >= 0 else MIXED
        found.append(LABELS[node.label] if node.label else DROP if node.tag in ("head", "script", "style", "title") else above)
    return np.array(found)


def train(count: int = TRAIN_PAGES, seed: int = 7, rounds: int = 30) -> Extractor:
    """Fits the model on ``count`` labelled pages, on the driver."""
    pages = [read_page(p) for p in labelled_pages(count, seed)]
    nodes = gather(pages)
    features = Features.of_training(nodes)
    return Extractor(features, BoostedTrees(3, rounds).fit(features.matrix(nodes), np.concatenate([node_labels(p) for p in pages])))


def _extract(model: Extractor):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            size = np.cumsum([len(x) for x in batch["html"].to_pylist()])
            while at < batch.num_rows:
                done = size[at - 1] if at else 0
                stop = max(at + 1, int(np.searchsorted(size, done + _BATCH_CHARS, "right")))
                part = batch.slice(at, stop - at)
                texts = model.texts([read_page(h) for h in part["html"].to_pylist()])
                made = [pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
                yield pa.RecordBatch.from_arrays([part["page_id"], part["url"], *made], names=["page_id", "url", "text", "n_chars"])
                at = stop

    return run


def extract_text(pages: DataFrame, model: Extractor | None = None) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages``.

    ``text`` is the main text of the whole page: its blocks in page order, one per line,
    with character references decoded and white space as single spaces. A null or empty
    page, and one without main text, has an empty text. Null ids and urls stay null,
    repeated rows are pages of their own, an empty table gives no row, and other columns
    are not read.
    """
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), whole("html").alias("html"))
    return rows.mapInArrow(_extract(model or train()), "page_id bigint, url string, text string, n_chars bigint")
