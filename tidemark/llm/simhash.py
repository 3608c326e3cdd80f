"""SimHash near-dedup with a hierarchical index over Gray-ordered fingerprints.

A node of the index is a masked bit pattern that all fingerprints below it share.
Fingerprints that differ in at most d bits agree on one of any d + 1 blocks of
bits, so the nodes of the first level are the values of each block; a pair meets
in at least one of them. A node with many fingerprints is divided again: the bits
it does not share are cut into d + 1 blocks, and each child shares one more. What
is left are leaves of a bounded number of different fingerprints, however skewed
the data are, since a node that shares all but r bits has at most 2^r of them.
Inside a leaf fingerprints stand in order of their Gray rank, which puts those
with common patterns side by side; runs of them carry the pattern they share, and
pairs of runs are dropped as soon as the differences of their patterns, added up
from the upper run to the lower, exceed d.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrays import mixed, signed
from tidemark.llm.common import LAST_ID, hash_pair, scratch, shuffle_partitions, stored, whole
from tidemark.llm.components import components
from tidemark.llm.shingles import mark, near_components

BITS = 64
LEAF = 1024
_RUN = 16
_PAIRWISE = 32
ROW = ["_row_1", "_row_2"]


def fingerprints(text: bytes, shingle_words: int, count: int = 1) -> np.ndarray:
    """``count`` independent SimHashes: the majority of the bits of the shingle hashes; 0 for a text without words."""
    words = text.lower().split()  # bytes: A-Z only
    if not words:
        return np.zeros(count, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    k = min(shingle_words, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[a:b], 42) for a, b in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist())),
        np.uint64, len(words) - k + 1,
    )
    found = np.zeros(count, np.uint64)
    for i in range(count):
        ones = np.zeros(BITS, np.int64)
        for at in range(0, len(hashes), 65_536):
            part = hashes[at : at + 65_536]
            part = mixed(part, np.full(1, i, np.uint64)) if i else part
            bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int64)
        found[i] = np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0]
    return found


MARKED = "doc_id bigint, _row_1 bigint, _row_2 bigint, fps array<bigint>"


def _fingerprints(shingle_words: int, count: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [signed(fingerprints(t, shingle_words, count)).tolist() for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch[ROW[0]], batch[ROW[1]], pa.array(values, pa.list_(pa.int64()))], names=["doc_id", *ROW, "fps"]
            )

    return run


def row_key() -> list[Column]:
    parts = hash_pair(F.isnull("doc_id"), F.col("doc_id"), whole("text"))
    return [part.alias(name) for part, name in zip(parts, ROW)]


def gray_rank(values: np.ndarray) -> np.ndarray:
    """Where a code stands in the Gray sequence."""
    rank = values.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def _shared(values: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Mask and pattern of the bits that runs of ``size`` values share."""
    at = np.arange(0, len(values), size)
    every, some = np.bitwise_and.reduceat(values, at), np.bitwise_or.reduceat(values, at)
    return ~(every ^ some), every


def _close_in_leaf(values: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of positions within ``max_bits``, by descent over runs of Gray-ordered values."""
    upper_mask, upper = _shared(values, _RUN * _RUN)
    mask, pattern = _shared(values, _RUN)
    i, j = np.triu_indices(len(upper))
    common = upper_mask[i] & upper_mask[j]
    apart = np.bitwise_count((upper[i] ^ upper[j]) & common)
    keep = apart <= max_bits
    i, j, common, apart = i[keep], j[keep], common[keep], apart[keep]
    inside = np.arange(_RUN)
    a = (i[:, None, None] * _RUN + inside[None, :, None] + 0 * inside[None, None, :]).ravel()
    b = (j[:, None, None] * _RUN + inside[None, None, :] + 0 * inside[None, :, None]).ravel()
    common, apart = np.repeat(common, _RUN * _RUN), np.repeat(apart, _RUN * _RUN)
    real = (a < len(mask)) & (b < len(mask)) & (a <= b)
    a, b, common, apart = a[real], b[real], common[real], apart[real]
    # what the upper runs share has been counted; add what only the lower ones share
    apart = apart + np.bitwise_count((pattern[a] ^ pattern[b]) & mask[a] & mask[b] & ~common)
    a, b = a[apart <= max_bits], b[apart <= max_bits]
    left = (a[:, None, None] * _RUN + inside[None, :, None] + 0 * inside[None, None, :]).ravel()
    right = (b[:, None, None] * _RUN + inside[None, None, :] + 0 * inside[None, :, None]).ravel()
    real = (left < right) & (right < len(values))
    left, right = left[real], right[real]
    near = np.bitwise_count(values[left] ^ values[right]) <= max_bits
    return left[near], right[near]


def _forest(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest position reachable from each of n positions."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[left], label[right])
        after = label.copy()
        np.minimum.at(after, left, low)
        np.minimum.at(after, right, low)
        after = after[after]
        if np.array_equal(after, label):
            return label
        label = after


def _link_groups(
    group: np.ndarray, values: np.ndarray, codes: np.ndarray, max_bits: int, max_total: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked positions within complete groups; rows of a group are side by side."""

    def near_codes(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return np.bitwise_count(codes[left] ^ codes[right]).sum(axis=1) <= max_total

    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    size = np.diff(np.r_[first, len(group)])
    own = np.repeat(size, size)
    small = own <= _PAIRWISE
    for shift in range(1, int(size[size <= _PAIRWISE].max(initial=1))):
        near = (group[shift:] == group[:-shift]) & small[shift:]
        near &= np.bitwise_count(values[shift:] ^ values[:-shift]) <= max_bits
        left = np.flatnonzero(near)
        left = left[near_codes(left, left + shift)]
        yield left, left + shift
    for at, n in zip(first[size > _PAIRWISE], size[size > _PAIRWISE]):
        order = at + np.argsort(gray_rank(values[at : at + n]))
        left, right = _close_in_leaf(values[order], max_bits)
        good = near_codes(order[left], order[right])
        root = _forest(n, left[good], right[good])
        joined = np.flatnonzero(root != np.arange(n))
        yield order[joined], order[root[joined]]


def _leaf_links(max_bits: int, max_total: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        for batch in _with_end(batches):
            if batch is not None and batch.num_rows:
                codes = np.frombuffer(b"".join(batch["code"].to_pylist()), np.uint64).reshape(batch.num_rows, -1)
                new = [*(batch[c].to_numpy() for c in ("which", "mask", "pattern", "vertex", "fp")), codes]
                held = new if held is None else [np.concatenate(x) for x in zip(held, new)]
            if held is None or not len(held[0]) or (batch is not None and not batch.num_rows):
                continue
            *node, vertex, fp, codes = held
            change = np.r_[True, np.any([part[1:] != part[:-1] for part in node], axis=0)]
            group = np.cumsum(change)
            # the last group may go on in the next batch; leaves are small, so little is held
            done = len(fp) if batch is None else int(np.searchsorted(group, group[-1]))
            held = [x[done:] for x in held]
            if done:
                for left, right in _link_groups(group[:done], fp[:done].view(np.uint64), codes[:done], max_bits, max_total):
                    if len(left):
                        yield pa.RecordBatch.from_arrays([pa.array(vertex[left]), pa.array(vertex[right])], names=["u", "v"])

    return run


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def _children(mask: int, max_bits: int) -> list[int]:
    """Masks that share one more block of the bits ``mask`` leaves open."""
    open_bits = [b for b in range(BITS) if not mask >> b & 1]
    blocks = max_bits + 1
    cuts = [len(open_bits) * i // blocks for i in range(blocks + 1)]
    return [mask | sum(1 << b for b in open_bits[cuts[i] : cuts[i + 1]]) for i in range(blocks)]


def _as_bigint(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprint_links(fps: DataFrame, max_bits: int, work: str, max_total: int | None = None, leaf: int = LEAF) -> DataFrame:
    """``u, v``: links that connect all vertices one of whose ``fps`` is within ``max_bits``.

    ``fps`` has distinct ``vertex``, the array ``fps`` to search by and ``code``, all
    fingerprints as bytes, which must be within ``max_total`` bits as well. Each place of
    the array has an index of its own (``which``), and all are built in the same jobs.
    Small leaves give every link, large ones a forest with the same reach, so links stay
    in proportion to fingerprints. Vertices that share a fingerprint count as one member
    of a node only if their codes are equal, so ``leaf`` bounds texts and not copies.
    """
    spark = fps.sparkSession
    found = []
    node = ["which", "mask", "pattern"]
    rows = fps.select("vertex", F.posexplode("fps").alias("which", "fp"), "code").withColumn("mask", F.lit(0).cast("bigint"))
    level, masks = 0, {0}
    parts = shuffle_partitions(spark)
    while True:
        level += 1
        below = {m: sorted(set(_children(m, max_bits)) - {m}) for m in masks}
        children = F.create_map(*[x for m, c in below.items() for x in (F.lit(_as_bigint(m)), F.array(*[F.lit(_as_bigint(k)) for k in c]))])
        masks = {k for c in below.values() for k in c}
        rows = rows.select("which", F.explode(F.element_at(children, F.col("mask"))).alias("mask"), "vertex", "fp", "code")
        rows = rows.distinct() if level > 1 else rows
        rows = rows.withColumn("pattern", F.col("fp").bitwiseAND(F.col("mask")))
        counts = rows.groupBy(node).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        members = stored(rows.join(counts, node), f"{work}/level-{level}")
        full = F.lit(_as_bigint((1 << BITS) - 1))
        ready = members.where((F.col("n") <= leaf) | (F.col("mask") == full)).select(*node, "vertex", "fp", "code")
        ready = ready.repartition(parts, *node).sortWithinPartitions(*node, "fp")
        links = ready.mapInArrow(_leaf_links(max_bits, BITS * 64 if max_total is None else max_total), "u bigint, v bigint")
        found.append(stored(links, f"{work}/links-{level}"))
        rows = members.where((F.col("n") > leaf) & (F.col("mask") != full)).select("which", "mask", "vertex", "fp", "code")
        if rows.isEmpty():
            return reduce(DataFrame.unionByName, found)


def near_duplicates(
    docs: DataFrame, shingle_words: int = 3, max_bits: int = 2, fingerprint_count: int = 1, max_total: int | None = None
) -> DataFrame:
    """``doc_id, fingerprint, component_id, _row_1, _row_2`` of every row of ``docs``.

    Documents link if one of their fingerprints differs in at most ``max_bits`` bits
    and, where ``max_total`` is given, all together in at most that many.
    ``component_id`` is the smallest id that links reach. Null and empty texts have
    fingerprint 0, which links like any other. Texts with equal fingerprints are one
    vertex. Repeated ids keep their rows; a null id never names a component unless
    all of it are null. An empty table gives no row; other columns are not read.
    """
    work = scratch(docs.sparkSession, "simhash")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), *row_key(), whole("text").cast("binary").alias("text"))
    marked = stored(texts.mapInArrow(_fingerprints(shingle_words, fingerprint_count), MARKED), f"{work}/fingerprints")
    # one fingerprint names its vertex itself, several do by their hash
    vertex = F.col("fps")[0] if fingerprint_count == 1 else F.xxhash64("fps")
    classes = marked.groupBy("fps").agg(F.coalesce(F.min("doc_id"), F.lit(LAST_ID)).alias("first"))
    code = F.concat(*[F.unhex(F.lpad(F.hex(F.col("fps")[i]), 16, "0")) for i in range(fingerprint_count)])
    classes = stored(classes.select(vertex.alias("vertex"), "fps", "first", code.alias("code")), f"{work}/classes")
    stars = components(fingerprint_links(classes.select("vertex", "fps", "code"), max_bits, work, max_total), work)
    rooted = classes.join(stars.withColumnRenamed("u", "vertex"), "vertex", "left").select("vertex", "first", F.coalesce("v", "vertex").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(lowest, "root").select("vertex", F.when(F.col("component_id") != LAST_ID, F.col("component_id")).alias("component_id"))
    return marked.withColumn("vertex", vertex).join(stored(named, f"{work}/components"), "vertex").select(
        "doc_id", F.lower(F.lpad(F.hex(F.col("fps")[0]), 16, "0")).alias("fingerprint"), "component_id", *ROW
    )


def _fingerprint(shingle_words: int):
    def run(text: bytes) -> int:
        return int(signed(fingerprints(text, shingle_words))[0])

    return run


def index_pairs(marked: DataFrame, max_bits: int, work: str) -> DataFrame:
    """``u, v``: distinct pairs of vertices that the index of their fingerprints ``fp`` names, one for each vertex at most.

    Each fingerprint has a pivot, its smallest vertex. Pairs are the pivots of a
    fingerprint and of the nearest one it is linked to, and a pivot with every other vertex
    of its fingerprint. Sets without shingles are one vertex, and are left out.
    """
    held = marked.where("size > 0").select("fp", "vertex").distinct()
    classes = stored(held.groupBy("fp").agg(F.min("vertex").alias("pivot")), f"{work}/classes")
    code = F.unhex(F.lpad(F.hex("fp"), 16, "0")).alias("code")
    links = fingerprint_links(classes.select(F.col("fp").alias("vertex"), F.array("fp").alias("fps"), code), max_bits, work)
    near = F.struct(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))).alias("bits"), "v")
    nearest = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))).groupBy("u").agg(F.min(near).alias("near"))
    first, second = (classes.select(F.col("fp").alias(c), F.col("pivot").alias(f"of_{c}")) for c in ("u", "v"))
    between = nearest.select("u", "near.v").join(first, "u").join(second, "v").select("of_u", "of_v")
    within = held.join(classes, "fp").select(F.col("pivot").alias("of_u"), F.col("vertex").alias("of_v"))
    pairs = between.unionByName(within).where("of_u <> of_v").select(F.least("of_u", "of_v").alias("u"), F.greatest("of_u", "of_v").alias("v"))
    return stored(pairs.distinct(), f"{work}/pairs")


def drop_near_duplicates(
    docs: DataFrame, shingle_words: int = 5, similarity: float = 0.8, fingerprint_words: int = 3, max_bits: int = 2
) -> DataFrame:
    """One row of each component, with all columns: the one with the smallest id (by hash among equals).

    Rows link if the Jaccard similarity of their sets of shingles is ``similarity`` or
    more. The index of ``near_duplicates``, with its fingerprints of ``fingerprint_words``
    words and its ``max_bits``, names candidates first; for pairs whose fingerprints are
    farther apart, the keys of ``shingles`` do, which miss a pair at 0.8 with a chance
    of 0.0004 and fewer above. No pair below links. Texts without words are alike.
    Rows with equal ids and texts are copies of one another; null ids come last.
    """
    work = scratch(docs.sparkSession, "near")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), *row_key(), whole("text").cast("binary").alias("text"))
    marked = stored(mark(texts, shingle_words, ["doc_id", *ROW], _fingerprint(fingerprint_words)), f"{work}/marked")
    candidates = index_pairs(marked, max_bits, f"{work}/index")
    stars = near_components(marked, texts, ROW, shingle_words, similarity, work, candidates)
    order = F.struct(F.coalesce("doc_id", F.lit(LAST_ID)), *ROW)
    first = marked.groupBy("vertex").agg(F.min(order).alias("best"))
    rooted = first.join(stars.withColumnRenamed("u", "vertex"), "vertex", "left").groupBy(F.coalesce("v", "vertex").alias("root"))
    best = rooted.agg(F.min("best").alias("best")).select("best._row_1", "best._row_2")
    keyed = docs.select(F.struct("*").alias("row"), *row_key())
    return keyed.join(best, ROW, "left_semi").dropDuplicates(ROW).select("row.*")


def near_digest(docs: DataFrame) -> DataFrame:
    """The columns the SimHash query returns."""
    return near_duplicates(docs).select("doc_id", "fingerprint", "component_id")
