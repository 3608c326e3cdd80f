"""Benchmark decontamination: CGK embedding and bit sampling over item-sized windows.

Items and windows are word sequences. The CGK walk reads a sequence through a
pointer that each step moves or holds, by a random bit of the word it sees, so two
sequences a few edits apart soon walk in step again: edit distance becomes Hamming
distance. Sampled steps of several walks make the keys of hash tables; a window
that meets an item in a table is a candidate, and a bit-parallel edit distance of
the item within the text around it decides.

A window within k edits of an item of n words shares at least n - 1 - 2k of its
word pairs, so only windows that hold that many pairs of the items of their size are
walked; this loses nothing.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrays import WordHashes, mixed, window_hashes
from tidemark.llm.common import hash_pair, whole

MAX_EDITS = 0.25  # of the item's words
# Items of fewer words are sought as they are: an edit would change too much of them.
EDITED_WORDS = 6
WALKS, TABLES, SAMPLES = 12, 6, 3
BLOCK_WORDS = 200_000
# Sizes of what a task works on at a time; they bound its memory and change no result.
_SLICE_BYTES, _WINDOWS = 2 << 20, 4_096
PLACE = ["item_id", "start", "stop", "edits", "similarity"]
_END = np.uint64(0)


def infix_edits(item: list[int], text: list[int]) -> tuple[int, int]:
    """Least edit distance of ``item`` to any run of ``text``, and where the first such run ends."""
    n = len(item)
    at: dict[int, int] = defaultdict(int)
    for i, w in enumerate(item):
        at[w] |= 1 << i
    ones, top = (1 << n) - 1, 1 << (n - 1)
    up, down, score, best, end = ones, 0, n, n, 0
    for j, w in enumerate(text):
        eq = at.get(w, 0)
        x = eq | down
        d = ((((x & up) + up) ^ up) | x) & ones
        plus, minus = down | (~(d | up) & ones), up & d
        score += bool(plus & top) - bool(minus & top)
        plus, minus = (plus << 1) & ones, (minus << 1) & ones
        up, down = minus | (~(d | plus) & ones), plus & d
        if score < best:
            best, end = score, j + 1
    return best, end


class BenchmarkIndex:
    """The items of one block, hashed for search."""

    def __init__(self, items: list[tuple[int, str]], max_edits: float, walks: int, tables: int, samples: int):
        cache = WordHashes()
        self.walks, self.max_edits = walks, max_edits
        self.items = [(i, cache.of(t.encode().lower().split())) for i, t in items]
        self.short: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        for at, (_, h) in enumerate(self.items):
            if 0 < len(h) < EDITED_WORDS:
                self.short[len(h)][int(window_hashes(h, len(h))[0])].append(at)
        plain, self.items = self.items, [(i, h) for i, h in self.items if len(h) >= EDITED_WORDS]
        self.plain = plain
        self.pairs = np.unique(np.concatenate([mixed(h[:-1], h[1:]) for _, h in self.items])) if self.items else np.zeros(0, np.uint64)
        rng = np.random.default_rng(20_240_601)
        longest = max((len(h) for _, h in self.items), default=1)
        self.seeds = rng.integers(1, 1 << 63, (walks, 2 * longest), dtype=np.uint64)
        self.by_size: dict[int, list[int]] = defaultdict(list)
        for at, (_, h) in enumerate(self.items):
            self.by_size[len(h)].append(at)
        self.pairs_of = {
            n: np.isin(self.pairs, np.concatenate([mixed(h[:-1], h[1:]) for h in (self.items[m][1] for m in members)]))
            for n, members in self.by_size.items()
        }
        self.steps = {n: np.sort(rng.integers(0, max(1, n + n // 4), (walks, tables, samples)), axis=2) for n in self.by_size}
        self.tables: dict[int, dict[int, list[int]]] = {}
        for n, members in self.by_size.items():
            words = np.concatenate([self.items[m][1] for m in members])
            starts = np.arange(len(members)) * n
            found: dict[int, list[int]] = defaultdict(list)
            for keys in self.keys(words, starts, starts + n, n):
                for key, m in zip(keys.tolist(), members):
                    found[key].append(m)
            self.tables[n] = found
        self.known = {n: np.array(sorted(t), np.uint64) for n, t in self.tables.items()}

    def edits(self, n: int) -> int:
        return int(self.max_edits * n)

    def keys(self, words: np.ndarray, starts: np.ndarray, ends: np.ndarray, n: int) -> Iterator[np.ndarray]:
        """One key per window for each table of each walk."""
        steps = self.steps[n]
        at, ends = np.tile(starts, (self.walks, 1)), ends[None, :]
        sampled, seen = set(steps.ravel().tolist()), {}
        for j in range(int(steps.max()) + 1):
            inside = at < ends
            word = np.where(inside, words[np.minimum(at, len(words) - 1)], _END)
            if j in sampled:
                seen[j] = word
            at += inside & (mixed(word, self.seeds[:, j : j + 1]) >> np.uint64(63)).astype(bool)
        for number, sample in enumerate(steps.reshape(-1, steps.shape[2]).tolist()):
            key = np.full(len(starts), number, np.uint64)
            for j in sample:
                key = mixed(key, seen[j][number // steps.shape[1]])
            yield key

    def search(self, texts: list[bytes], cache: WordHashes) -> Iterator[tuple[int, int, int, int, int, int]]:
        """(text, item, its words, start, stop, edits) for each item within its edits of a run of a text."""
        if not self.plain or not texts:
            return
        hashes = [cache.of(t.lower().split()) for t in texts]
        size = np.fromiter(map(len, hashes), np.int64, len(hashes))
        if not size.sum():
            return
        words = np.concatenate(hashes)
        last = np.cumsum(size)
        of_text = np.repeat(np.arange(len(texts)), size)
        yield from self._search_short(words, of_text, last - size)
        if not self.items or len(words) < 2:
            return
        pair = mixed(words[:-1], words[1:])
        where = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        hit = (self.pairs[where] == pair) & (of_text[1:] == of_text[:-1])
        hits = np.flatnonzero(hit)
        near: dict[tuple[int, int], list[int]] = defaultdict(list)
        for n in self.by_size:
            need = max(1, n - 1 - 2 * self.edits(n))
            own = hits[self.pairs_of[n][where[hits]]]
            if len(own) < need:
                continue
            seen = np.r_[0, np.cumsum(np.bincount(own, minlength=len(pair)))]
            stop = np.minimum(np.arange(len(words)) + n, last[of_text])
            starts = np.flatnonzero(seen[np.maximum(stop - 1, 0)] - seen[: len(words)] >= need)
            if not len(starts):
                continue
            for part in np.split(starts, range(_WINDOWS, len(starts), _WINDOWS)):
                for keys in self.keys(words, part, stop[part], n):
                    place = np.minimum(np.searchsorted(self.known[n], keys), len(self.known[n]) - 1)
                    for w in np.flatnonzero(self.known[n][place] == keys):
                        for item in self.tables[n][int(keys[w])]:
                            near[int(of_text[part[w]]), item].append(int(part[w]))
        for (text, item), starts in near.items():
            yield from self._verified(text, item, sorted(set(starts)), words, int(last[text] - size[text]), int(last[text]))

    def _search_short(self, words: np.ndarray, of_text: np.ndarray, first: np.ndarray) -> Iterator[tuple]:
        """Places of the short items, leftmost first and without overlap."""
        for n, known in self.short.items():
            found = window_hashes(words, n)
            wanted = np.fromiter(known, np.uint64, len(known))
            ends: dict[tuple[int, int], int] = {}
            for at in np.flatnonzero(np.isin(found, wanted)).tolist():
                text = int(of_text[at])
                if of_text[at + n - 1] != text:
                    continue
                for item in known[int(found[at])]:
                    if at >= ends.get((text, item), 0) and np.array_equal(words[at : at + n], self.plain[item][1]):
                        ends[text, item] = at + n
                        start = at - int(first[text])
                        yield text, self.plain[item][0], n, start, start + n, 0

    def _verified(self, text: int, item: int, starts: list[int], words: np.ndarray, low: int, high: int) -> Iterator[tuple]:
        """Windows of one item that lie close together are verified as one stretch of text, and what lies beside a place again."""
        sought = self.items[item][1].tolist()
        n, k = len(sought), self.edits(len(sought))
        at = 0
        while at < len(starts):
            first = at
            while at + 1 < len(starts) and starts[at + 1] - starts[at] <= n:
                at += 1
            open_ = [(max(low, starts[first] - k), min(high, starts[at] + n + k))]
            while open_:
                a, b = open_.pop()
                if b - a < n - k:
                    continue
                stretch = words[a:b].tolist()
                edits, end = infix_edits(sought, stretch)
                if edits <= k:
                    _, back = infix_edits(sought[::-1], stretch[:end][::-1])
                    start, stop = a + end - back, a + end
                    yield text, self.items[item][0], n, start - low, stop - low, edits
                    open_ += [(a, start), (stop, b)]
            at += 1


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of a batch, cut where about ``_SLICE_BYTES`` of text are full; a longer text stands alone."""
    filled = np.cumsum(pc.binary_length(batch["text"]).to_numpy(zero_copy_only=False)) // _SLICE_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(filled)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)


def _search(index: BenchmarkIndex, carried: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in (part for whole_batch in batches for part in _slices(whole_batch)):
            texts = batch["text"].to_pylist()
            found = [(t, i, a, b, e, 1 - e / n) for t, i, n, a, b, e in index.search(texts, cache)]
            if found:
                of_text, *columns = zip(*found)
                rows = batch.select(carried).take(pa.array(of_text))
                kinds = [pa.int64()] * 4 + [pa.float64()]
                made = [pa.array(c, k) for c, k in zip(columns, kinds)]
                yield pa.RecordBatch.from_arrays([*rows.columns, *made], names=[*carried, *PLACE])

    return run


def item_blocks(benchmark: DataFrame, block_words: int) -> Iterator[list[tuple[int, str]]]:
    """The benchmark in blocks of about ``block_words`` words, one held at a time."""
    block, words = [], 0
    for row in benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select("item_id", "text").toLocalIterator():
        block.append((row["item_id"], row["text"]))
        words += row["text"].count(" ") + 1
        if words >= block_words:
            yield block
            block, words = [], 0
    if block:
        yield block


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, max_edits: float = MAX_EDITS, walks: int = WALKS, tables: int = TABLES,
    samples: int = SAMPLES, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``doc_id, item_id, start, stop, edits, similarity``: items that occur in documents, up to edits.

    One row per document, item and place: the words [start, stop) of the text are
    ``edits`` word edits from the item, at most ``max_edits`` of its words. Words are
    compared with A-Z lower-cased. The benchmark is the stated query set: it is taken
    in blocks of a bounded number of words, each searched in all documents. Places of an
    item do not overlap. Items of fewer than 6 words are sought without edits; items
    without a word, null items and null ids of items are skipped. Null texts are empty. Repeated ids give their own rows.
    Empty tables give no row; other columns are not read.
    """
    settings = (max_edits, walks, tables, samples)
    return _found(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), _text()), benchmark, ["doc_id"], settings, block_words)


def _text() -> Column:
    return whole("text").cast("binary").alias("text")


def _found(texts: DataFrame, benchmark: DataFrame, carried: list[str], settings: tuple, block_words: int) -> DataFrame:
    """The places found in ``texts``, with the bigint columns ``carried`` from their rows."""
    schema = ", ".join(f"{c} bigint" for c in [*carried, *PLACE[:-1]]) + ", similarity double"
    found = [
        texts.mapInArrow(_search(BenchmarkIndex(block, *settings), carried), schema)
        for block in item_blocks(benchmark, block_words)
    ]
    return reduce(DataFrame.unionByName, found) if found else texts.sparkSession.createDataFrame([], schema)


def drop_leaked(
    docs: DataFrame, benchmark: DataFrame, max_edits: float = MAX_EDITS, walks: int = WALKS, tables: int = TABLES,
    samples: int = SAMPLES, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all columns.

    Each is judged by its own whole text, whatever its id: repeated rows stay or go
    together, null ids count like others, and null or empty texts stay. An empty table or
    an empty benchmark drops no row; columns may have any names.
    """
    key = ["_text_1", "_text_2"]
    hashes = [part.alias(name) for part, name in zip(hash_pair(whole("text")), key)]
    leaked = _found(docs.select(*hashes, _text()), benchmark, key, (max_edits, walks, tables, samples), block_words).select(key).distinct()
    return docs.select(F.struct("*").alias("row"), *hashes).join(leaked, key, "left_anti").select("row.*")
