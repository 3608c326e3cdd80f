"""Ranked lexical search: exact inner products by sparse ball trees.

A document is a sparse vector with one integer per term, an item the vector of its
terms' weights, and a score their inner product. Documents are indexed in blocks: a
block keeps its distinct terms and, for each document, which of them it holds how
often. For the terms that items name, the documents of a block form a ball tree. A
node knows the centroid of its documents, the radius around it that holds them all,
and that radius along every single term. No document below it scores more than the
centroid does, plus the radius times the norm of the item over the terms that occur
below the node, nor more than the centroid plus the radii of the item's terms. Bounds
are floating-point and rounded up, so that they never fall below a score; leaves are
scored in 64-bit integers. Each item descends best-first, and a subtree is left out
once its bound is below the item's last place so far.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import LAST_ID, lower_ascii, scratch, stored, whole

# Fixed value: what terms are made of, digits, letters and all that is not ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# Bytes of text in a block of the index, terms of items that are searched at once, cells of a tree's matrix, documents of a leaf.
BLOCK_BYTES, BLOCK_TERMS, CELLS, LEAF = 4 << 20, 16_384, 3 << 20, 16

_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_INDEX = "doc_id array<bigint>, n array<bigint>, n_distinct array<bigint>, n_docs bigint, n_terms bigint, term array<binary>, docs array<bigint>, place binary, times binary"


def terms_of(text: Column) -> Column:
    """The terms of a text that is not null, with repeats."""
    return F.regexp_extract_all(lower_ascii(text), F.lit(TERM), F.lit(0))


class _Numbers(dict):
    """Numbers terms in the order they come."""

    def __missing__(self, term: bytes) -> int:
        self[term] = number = len(self)
        return number


def _packed(values: np.ndarray) -> bytes:
    return pa.compress(values.astype("<i4").tobytes(), "zstd", asbytes=True)


def _unpacked(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, 4 * n, "zstd", asbytes=True), "<i4").astype(np.int64)


def _block(ids: list[int | None], texts: list[list[bytes]]) -> pa.RecordBatch:
    numbers = _Numbers()
    n = np.fromiter(map(len, texts), np.int64, len(texts))
    term = np.fromiter((numbers[t] for words in texts for t in words), np.int64, int(n.sum()))
    code = np.sort((np.repeat(np.arange(len(texts)), n) << 32) | term)
    first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
    place = code[first] & 0xFFFFFFFF
    lists = {
        "doc_id": (ids, pa.int64()), "n": (n, pa.int64()), "n_distinct": (np.bincount(code[first] >> 32, minlength=len(texts)), pa.int64()),
        "term": (list(numbers), pa.binary()), "docs": (np.bincount(place, minlength=len(numbers)), pa.int64()),
    }
    columns = {c: pa.array([v], pa.list_(k)) for c, (v, k) in lists.items()}
    columns |= {"n_docs": pa.array([len(texts)], pa.int64()), "n_terms": pa.array([int(n.sum())], pa.int64())}
    columns |= {"place": pa.array([_packed(np.diff(place, prepend=0))], pa.binary()), "times": pa.array([_packed(np.diff(np.r_[first, len(code)]))], pa.binary())}
    names = [c.split()[0] for c in _INDEX.split(", ")]
    return pa.RecordBatch.from_arrays([columns[c] for c in names], names=names)


def _index(block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                text = text.as_py()
                if ids and size + len(text) > block_bytes:
                    yield _block(ids, texts)
                    ids, texts, size = [], [], 0
                if words := text.translate(_BYTES).split():
                    ids.append(doc_id)
                    texts.append(words)
                    size += len(text)
        if ids:
            yield _block(ids, texts)

    return run


def index_documents(docs: DataFrame, path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The index of every row of ``docs`` that holds a term, stored below ``path``: one row per block."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole("text").cast("binary").alias("text"))
    return stored(texts.mapInArrow(_index(block_bytes), _INDEX), path)


class Tree(NamedTuple):
    """Nodes in the order they were split: documents [start, end) of ``order``; the children of an inner node are ``below`` and the next."""

    order: np.ndarray
    start: np.ndarray
    end: np.ndarray
    below: np.ndarray
    centroid: np.ndarray
    radius: np.ndarray
    reach: np.ndarray


def ball_tree(x: np.ndarray, leaf: int = LEAF) -> Tree:
    """A tree over the rows of ``x``. A node is halved along the line between two far rows; ``reach`` is centroid plus radius of each column."""
    order = np.arange(len(x))
    start, end, below = [0], [len(x)], [0]
    centroid, radius, reach = [], [], []
    node = 0
    while node < len(start):
        a, b = start[node], end[node]
        rows = x[order[a:b]]
        centre = rows.mean(axis=0)
        far = np.square(rows - centre).sum(axis=1)
        centroid.append(centre)
        # the sums round by less than a part in 1e9 for any number of columns that fits a tree
        radius.append(np.sqrt(far.max()) * (1 + 1e-9))
        reach.append(rows.max(axis=0))
        if b - a > leaf:
            one = rows[far.argmax()]
            two = rows[np.square(rows - one).sum(axis=1).argmax()]
            half = (b - a) // 2
            order[a:b] = order[a:b][np.argpartition(rows @ (two - one), half)]
            below[node] = len(start)
            start += [a, a + half]
            end += [a + half, b]
            below += [0, 0]
        node += 1
    return Tree(order, np.array(start), np.array(end), np.array(below), np.array(centroid), np.array(radius), np.array(reach))


def bounds(tree: Tree, items: np.ndarray) -> np.ndarray:
    """The most that documents below each node (rows) can score for each item (columns of ``items``), rounded up."""
    by_ball = tree.centroid @ items + tree.radius[:, None] * np.sqrt((tree.reach > 0).astype(np.float64) @ np.square(items))
    by_term = tree.reach @ items
    return np.ceil(np.minimum(by_ball, by_term) * (1 + 1e-9) + 1)


class Ranking:
    """The best documents of one item so far."""

    def __init__(self, k: int) -> None:
        self.k, self.best = k, []

    @property
    def least(self) -> int:
        """What a document must score to get in, or tie."""
        return self.best[0][0] if len(self.best) == self.k else 1

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        for i in np.flatnonzero(scores >= self.least).tolist():
            entry = (int(scores[i]), -int(ids[i]))
            if len(self.best) < self.k:
                heapq.heappush(self.best, entry)
            elif entry > self.best[0]:
                heapq.heapreplace(self.best, entry)


def search_tree(tree: Tree, x: np.ndarray, ids: np.ndarray, item: tuple[np.ndarray, np.ndarray], bound: np.ndarray, ranking: Ranking) -> int:
    """Offers the documents of a tree to the ranking, best nodes first; how many were scored. ``x`` and ``ids`` stand in the tree's order."""
    columns, weights = item
    scored = 0
    heap = [(-bound[0], 0)]
    while heap and -heap[0][0] >= ranking.least:
        node = heapq.heappop(heap)[1]
        if child := tree.below[node]:
            for c in (child, child + 1):
                if bound[c] >= ranking.least:
                    heapq.heappush(heap, (-bound[c], c))
        else:
            a, b = tree.start[node], tree.end[node]
            ranking.offer(x[a:b][:, columns] @ weights, ids[a:b])
            scored += b - a
    return scored


def impacts(times: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What a term adds per unit of weight: it grows with its occurrences, and less in long documents."""
    m = 50 + (50 * n * n_docs) // n_terms
    return (1_000_000_000 * times) // (1000 * times + 20 * m)


def _search(items, n_docs: int, n_terms: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, wanted = items.value
        known = pa.array(vocabulary, pa.binary())
        rankings = {key: Ranking(k) for key, _, _ in wanted}
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.array([LAST_ID if i is None else i for i in row["doc_id"]], np.int64)
                per_doc = np.array(row["n_distinct"], np.int64)
                total = int(per_doc.sum())
                column = pc.fill_null(pc.index_in(pa.array(row["term"], pa.binary()), known), -1).to_numpy()
                column = column[np.cumsum(_unpacked(row["place"], total))]
                doc, n = np.repeat(np.arange(len(ids)), per_doc), np.array(row["n"], np.int64)
                named = np.flatnonzero(column >= 0)
                doc, column = doc[named], column[named]
                value = impacts(_unpacked(row["times"], total)[named], n[doc], n_docs, n_terms)
                _search_block(ids, doc, column, value, wanted, rankings)
        for key, ranking in rankings.items():
            if ranking.best:
                score, minus = zip(*ranking.best)
                ids = pa.array([None if i == -LAST_ID else -i for i in minus], pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([key] * len(score), pa.int64()), ids, pa.array(score, pa.int64())], names=["item", "doc_id", "score"])

    return run


def _search_block(ids: np.ndarray, doc: np.ndarray, column: np.ndarray, value: np.ndarray, wanted: list, rankings: dict) -> None:
    """Searches the documents of a block, in trees whose matrix has at most ``CELLS`` cells (or one leaf)."""
    used, column = np.unique(column, return_inverse=True)
    if not len(used):
        return
    tree_docs = max(LEAF, CELLS // len(used))
    weight = np.zeros((len(used), len(wanted)))
    asked = []
    for i, (key, columns, weights) in enumerate(wanted):
        at = np.minimum(np.searchsorted(used, columns), len(used) - 1)
        here = used[at] == columns
        weight[at[here], i] = weights[here]
        asked.append((at[here], weights[here]))
    for low in range(0, len(ids), tree_docs):
        a, b = np.searchsorted(doc, [low, low + tree_docs])
        x = np.zeros((min(tree_docs, len(ids) - low), len(used)))
        x[doc[a:b] - low, column[a:b]] = value[a:b]
        tree = ball_tree(x)
        exact, own = x[tree.order].astype(np.int64), ids[low : low + tree_docs][tree.order]
        bound = bounds(tree, weight)
        for i, (key, _, _) in enumerate(wanted):
            if len(asked[i][0]):
                search_tree(tree, exact, own, asked[i], bound[:, i], rankings[key])


def _weighed(items: DataFrame, index: DataFrame, n_docs: int) -> DataFrame:
    """``item, term, weight`` of the terms of items that any document holds."""
    asked = items.select("item", F.explode(F.array_distinct(terms_of(whole("text")))).alias("term")).select("item", F.col("term").cast("binary").alias("term"))
    held = index.select(F.explode(F.arrays_zip("term", "docs")).alias("t")).select("t.*")
    held = held.join(asked.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("docs").alias("df"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1)))
    return asked.join(held, "term").select("item", "term", weight.cast("bigint").alias("weight"))


def search(index: DataFrame, items: DataFrame, k: int = 50, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents of an index that score highest for each row of ``items``.

    Items are the stated queries and are taken in blocks of about ``block_terms`` terms,
    each broadcast by itself, searched in the whole index and written. Repeated rows and
    ids of items get a ranking each; an item without terms, or whose terms no document
    holds, gets no row, and a null id stays null. Equal scores stand in the order of
    ascending ``doc_id``, null last; rows that share score and id are alike. A document
    needs a score above 0.
    """
    spark = index.sparkSession
    work = scratch(spark, "ranked")
    n_docs, n_terms = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    found = "item bigint, doc_id bigint, score bigint"
    numbered = stored(items.select("item_id", "text", F.monotonically_increasing_id().alias("item")), f"{work}/items")
    parts = []
    if n_docs:
        weighed = stored(_weighed(numbered, index, n_docs), f"{work}/weights")
        blocks = max(1, -(-weighed.count() // block_terms))
        for number in range(blocks):
            rows = weighed.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == number).orderBy("item", "term").collect()  # about block_terms rows
            vocabulary = sorted({bytes(r["term"]) for r in rows})
            place = {t: i for i, t in enumerate(vocabulary)}
            wanted: dict[int, list] = {}
            for r in rows:
                wanted.setdefault(r["item"], []).append((place[bytes(r["term"])], r["weight"]))
            packed = [(i, *np.array(sorted(w), np.int64).T) for i, w in wanted.items()]
            task = _search(spark.sparkContext.broadcast((vocabulary, packed)), n_docs, n_terms, k)
            parts.append(stored(index.mapInArrow(task, found), f"{work}/found-{number}"))
    rows = spark.createDataFrame([], found)
    for part in parts:
        rows = rows.unionByName(part)
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    best = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.join(numbered.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """Indexes all rows of ``docs`` and searches all rows of ``items``.

    Null texts have no terms. Texts are taken whole, repeated rows are documents of their
    own, empty tables give no row, and other columns are not read.
    """
    return search(index_documents(docs, f"{scratch(docs.sparkSession, 'ranked')}/index"), items, k)


# The same ranking, with every score computed.
RANK_SQL = r"""
WITH d AS (
    SELECT row_number() OVER () AS row, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
), i AS (
    SELECT row_number() OVER () AS item, item_id,
           list_distinct(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS terms
    FROM benchmark
), s AS (
    SELECT count(*)::BIGINT AS docs, sum(len(terms))::BIGINT AS all_terms FROM d WHERE len(terms) > 0
), tf AS (
    SELECT row, term, count(*)::BIGINT AS tf FROM (SELECT row, unnest(terms) AS term FROM d) GROUP BY ALL
), w AS (
    SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
    FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), s
), m AS (
    SELECT row, doc_id, 100 - 50 + ((50 * len(terms)::BIGINT * docs) // all_terms) AS m FROM d, s WHERE len(terms) > 0
), scores AS (
    SELECT item, row, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
    FROM (SELECT item, unnest(terms) AS term FROM i) JOIN tf USING (term) JOIN w USING (term) JOIN m USING (row)
    GROUP BY item, row
), ranked AS (
    SELECT item, doc_id, score, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS r
    FROM scores JOIN m USING (row) WHERE score > 0
)
SELECT item_id, r::INTEGER AS rank, doc_id, score FROM ranked JOIN i USING (item) WHERE r <= 50
"""
