"""Near copies by the exact Jaccard similarity of their sets of shingles.

Candidates may be named from outside (``simhash`` names those of its index), and are
settled first. Min-hash keys name the rest: each key joins a few smallest hashes of the set,
and two sets share one of the keys nearly always from the sought similarity on (at
0.8 the 20 keys of 5 hashes miss one pair in 2,700). Every link is then a pair whose
sets were intersected, so keys that meet by chance link nothing. First a set is
compared with one other, the pivot that most of its keys name, which settles large
groups of copies with as many pairs as members. What is still apart within a key is dealt into
tiles of bounded size, and a task intersects all sets of a pair of tiles at once, as a
product of two 0/1 matrices. It returns no more links than join its members into one,
so a group of texts that lie below the similarity, such as pages of one template,
costs products inside tasks and no rows. Pairs that links join already need no
comparison, so the components are those of all similar pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrays import WordHashes, mixed, signed, window_hashes
from tidemark.llm.common import shuffle_partitions, stored
from tidemark.llm.components import components
from tidemark.sources.files import delete_folder

KEYS, HASHES = 20, 5
# Members of a tile, bytes of their sets, and columns of a matrix that are multiplied at once.
TILE, TILE_BYTES, _SHARED = 512, 8 << 20, 4096
# Pairs of one vertex that a task verifies in a row, and bytes of sets in a batch.
_SHARE, _BYTES, _COLUMNS = 500, 8 << 20, 1024
_RNG = np.random.default_rng(20_240_602)
_FLIPS = _RNG.integers(1, 1 << 63, (KEYS * HASHES, 1), dtype=np.uint64)
_FACTORS = _RNG.integers(1, 1 << 63, (KEYS * HASHES, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_set(text: bytes, shingle_words: int, cache: WordHashes) -> np.ndarray:
    """Sorted hashes of the distinct shingles; a shorter text is one shingle, one without words has none."""
    words = cache.of(text.lower().split())  # bytes: A-Z only
    return np.unique(window_hashes(words, min(shingle_words, len(words)))) if len(words) else words


def min_hash_keys(shingles: np.ndarray) -> np.ndarray:
    if not len(shingles):
        return np.zeros(0, np.uint64)
    low = np.full(KEYS * HASHES, ~np.uint64(0))
    for at in range(0, len(shingles), _COLUMNS):
        np.minimum(low, ((shingles[None, at : at + _COLUMNS] ^ _FLIPS) * _FACTORS).min(axis=1), out=low)
    keys = np.arange(KEYS, dtype=np.uint64)
    for column in low.reshape(KEYS, HASHES).T:
        keys = mixed(keys, column)
    return keys


def vertex_of(shingles: np.ndarray) -> int:
    value = xxhash.xxh64_intdigest(shingles.tobytes(), 7)
    return value - (1 << 64) if value >> 63 else value


def mark(texts: DataFrame, shingle_words: int, carried: list[str], fingerprint: Callable[[bytes], int]) -> DataFrame:
    """The ``carried`` bigint columns with ``vertex``, which names the set, ``size``, ``keys`` and the text's ``fp``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in batches:
            sets = ((t, shingle_set(t, shingle_words, cache)) for t in batch["text"].to_pylist())
            rows = [(vertex_of(s), len(s), fingerprint(t), signed(min_hash_keys(s)).tolist()) for t, s in sets]
            vertex, size, fp, keys = zip(*rows) if rows else ([], [], [], [])
            made = [*(pa.array(c, pa.int64()) for c in (vertex, size, fp)), pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in carried), *made], names=[*carried, "vertex", "size", "fp", "keys"])

    return texts.mapInArrow(run, ", ".join(f"{c} bigint" for c in [*carried, "vertex", "size", "fp"]) + ", keys array<bigint>")


def _sets(texts: DataFrame, shingle_words: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()

        def made(rows: list[np.ndarray]) -> pa.RecordBatch:
            columns = [pa.array(map(vertex_of, rows), pa.int64()), pa.array([s.tobytes() for s in rows], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["vertex", "shingles"])

        for batch in batches:
            rows, size = [], 0
            for text in batch["text"]:
                rows.append(shingle_set(text.as_py(), shingle_words, cache))
                size += rows[-1].nbytes
                if size >= _BYTES:
                    yield made(rows)
                    rows, size = [], 0
            yield made(rows)

    return texts.mapInArrow(run, "vertex bigint, shingles binary").dropDuplicates(["vertex"])


def _similar(similarity: float):
    """``u, v`` whose sets are similar, from rows in order of ``u`` and ``salt``: the set of ``u`` itself, then those of each ``v``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(0, np.uint64)
        for batch in batches:
            found = []
            for u, v, is_other, data in zip(*(batch[c] for c in ("u", "v", "is_other", "shingles"))):
                shingles = np.frombuffer(data.as_buffer(), np.uint64)
                if not is_other.as_py():
                    own = shingles.copy()
                    continue
                place = np.minimum(np.searchsorted(own, shingles), len(own) - 1)
                both = int(np.count_nonzero(own[place] == shingles))
                if both >= similarity * (len(own) + len(shingles) - both) - 1e-9:
                    found.append((u.as_py(), v.as_py()))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["u", "v"])

    return run


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The distinct ``pairs`` that are similar; those of a vertex with many are dealt over several tasks."""
    many = pairs.groupBy("u").agg(F.ceil(F.count(F.lit(1)) / _SHARE).alias("shares"))
    dealt = pairs.join(many, "u").select("u", "v", F.expr("pmod(xxhash64(v), shares)").alias("salt"))
    other = dealt.join(sets.withColumnRenamed("vertex", "v"), "v").select("u", "salt", "v", F.lit(1).alias("is_other"), "shingles")
    own = many.select("u", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("shares") - 1)).alias("salt"))
    own = own.join(sets.withColumnRenamed("vertex", "u"), "u").select("u", "salt", F.col("u").alias("v"), F.lit(0).alias("is_other"), "shingles")
    rows = own.unionByName(other).repartition(shuffle_partitions(pairs.sparkSession), "u", "salt")
    return rows.sortWithinPartitions("u", "salt", "is_other").mapInArrow(_similar(similarity), "u bigint, v bigint")


def _forest(n: int, pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Those pairs, in their order, that join what earlier ones have not."""
    root, kept = list(range(n)), []

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        if x != y:
            root[x] = y
            kept.append((a, b))
    return kept


def _in_both(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many values each set of the one list shares with each of the other."""
    found = []
    for sets in (left, right):
        sizes = np.fromiter(map(len, sets), np.int64, len(sets))
        found.append((np.concatenate(sets) if sets else np.zeros(0, np.uint64), np.repeat(np.arange(len(sets)), sizes)))
    common = np.intersect1d(*(np.unique(values) for values, _ in found), assume_unique=True)
    entries = []
    for values, of in found:
        at = np.minimum(np.searchsorted(common, values), max(len(common) - 1, 0))
        held = common[at] == values if len(common) else np.zeros(len(values), bool)
        order = np.argsort(at[held], kind="stable")
        entries.append((at[held][order], of[held][order]))
    both = np.zeros((len(left), len(right)), np.int64)
    for low in range(0, len(common), _SHARED):
        width = min(_SHARED, len(common) - low)
        matrices = []
        for sets, (at, of) in zip((left, right), entries):
            a, b = np.searchsorted(at, [low, low + width])
            matrix = np.zeros((len(sets), width), np.float32)
            matrix[of[a:b], at[a:b] - low] = 1
            matrices.append(matrix)
        both += (matrices[0] @ matrices[1].T).astype(np.int64)
    return both


def tile_links(tile: dict[str, np.ndarray], sets: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """Links that join all similar members of a pair of tiles whose labels differ."""
    left, right = np.flatnonzero(tile["is_other"]), np.flatnonzero(tile["is_other"] == 0)
    both = _in_both([sets[i] for i in left], [sets[i] for i in right])
    total = tile["size"][left][:, None] + tile["size"][right] - both
    good = (both >= similarity * total - 1e-9) & (tile["label"][left][:, None] != tile["label"][right])
    _, label = np.unique(tile["label"], return_inverse=True)
    a, b = (x.tolist() for x in np.nonzero(good))
    pair = {}
    for i, j in zip(left[a].tolist(), right[b].tolist()):
        pair.setdefault((int(label[i]), int(label[j])), (i, j))
    return [(int(tile["vertex"][i]), int(tile["vertex"][j])) for i, j in map(pair.__getitem__, _forest(len(label), list(pair)))]


def _compare_tiles(similarity: float):
    names = ("vertex", "label", "size", "is_other")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in _with_end(batches):
            found = []
            if batch is None:
                pieces = [(last, None)]
            else:
                tile = np.stack([batch[c].to_numpy() for c in ("key", "tile_a", "tile_b")], axis=1)
                cuts = np.flatnonzero((tile[1:] != tile[:-1]).any(axis=1)) + 1
                pieces = [(tuple(tile[a]), batch.slice(a, b - a)) for a, b in zip([0, *cuts], [*cuts, batch.num_rows])] if len(tile) else []
            for name, rows in pieces:
                # rows of a pair of tiles stand together, over as many batches as they fill
                if held and (rows is None or name != last):
                    part = pa.Table.from_batches(held)
                    sets = [np.frombuffer(x.as_buffer(), np.uint64) for c in part["shingles"].chunks for x in c]
                    found += tile_links({c: part[c].to_numpy() for c in names}, sets, similarity)
                    held = []
                if rows is not None:
                    held.append(rows)
                    last = name
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["u", "v"])

    return run


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def _linked(apart: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """``u, v``: links that join all similar members of a key.

    Of each key, the members outside its main label meet all members. Both sides are
    dealt into tiles by a hash, and every tile of the one meets every tile of the other.
    """

    def tiles(members, sizes):
        return F.greatest(F.ceil(members / TILE), F.ceil(sizes * 8 / TILE_BYTES), F.lit(1)).cast("int")

    n_a = tiles(F.col("all") - F.col("n"), F.col("all_size") - F.col("n_size"))
    n_b = tiles(F.col("all"), F.col("all_size"))
    own = F.xxhash64("vertex", "key")
    columns = ["key", "vertex", "label", "size"]

    def every(n):
        return F.explode(F.sequence(F.lit(0), n - 1))

    others = apart.where("label != main").select(*columns, F.lit(1).alias("is_other"), F.pmod(own, n_a).cast("int").alias("tile_a"), every(n_b).alias("tile_b"))
    members = apart.select(*columns, F.lit(0).alias("is_other"), every(n_a).alias("tile_a"), F.pmod(own, n_b).cast("int").alias("tile_b"))
    place = ["key", "tile_a", "tile_b"]
    dealt = others.unionByName(members).join(sets, "vertex").repartition(shuffle_partitions(apart.sparkSession), *place)
    return dealt.sortWithinPartitions(*place).mapInArrow(_compare_tiles(similarity), "u bigint, v bigint").distinct()


def near_components(
    marked: DataFrame, texts: DataFrame, row: list[str], shingle_words: int, similarity: float, work: str, candidates: DataFrame
) -> DataFrame:
    """``u, v``: each vertex that similar pairs join to a smaller one, with the smallest.

    ``marked`` is what ``mark`` made of ``texts``, stored; ``row`` are the columns that name a row in both.
    ``candidates`` are distinct pairs ``u, v`` of vertices with shingles, stored; those that are similar
    are links, and keys then search only what these leave apart.
    """
    spark = marked.sparkSession
    rows = marked.select("vertex", "size", "keys").dropDuplicates(["vertex"]).select("vertex", "size", F.explode("keys").alias("key"))
    shared = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    members = stored(rows.join(shared, "key"), f"{work}/members")
    named = members.select("vertex").union(candidates.select("u")).union(candidates.select("v")).distinct()
    chosen = marked.join(named, "vertex", "left_semi").groupBy("vertex").agg(F.min(F.struct(*row)).alias("r"))
    sets = stored(_sets(texts.join(chosen.select("r.*"), row, "left_semi"), shingle_words), f"{work}/sets")
    links = stored(_verified(candidates, sets, similarity), f"{work}/links-0")
    stars = components(links, f"{work}/round-0")
    apart = stored(_apart(members, stars), f"{work}/apart-0")
    named = apart.where("label != main").groupBy("vertex", "pivot").agg(F.count(F.lit(1)).alias("times"))
    best = named.groupBy("vertex").agg(F.max(F.struct("times", "pivot")).alias("best"))
    pairs = stored(best.select(F.col("best.pivot").alias("u"), F.col("vertex").alias("v")), f"{work}/pairs")
    links = stars.unionByName(stored(_verified(pairs, sets, similarity), f"{work}/links-1"))
    stars = components(links, f"{work}/round-1")
    apart = stored(_apart(members, stars), f"{work}/apart-1")
    links = links.unionByName(stored(_linked(apart, sets, similarity), f"{work}/links-2"))
    stars = components(links, f"{work}/round-2")
    for done in ("apart-0", "apart-1", "pairs", "round-0", "round-1", "members", "sets"):
        delete_folder(spark, f"{work}/{done}")
    return stars


def _apart(members: DataFrame, stars: DataFrame) -> DataFrame:
    """The members of keys that hold more than one label, with the main label of the key and its smallest vertex, and counts of members and shingles of all and of the main label."""
    labelled = members.join(stars.withColumnRenamed("u", "vertex"), "vertex", "left").select("key", "vertex", "size", F.coalesce("v", "vertex").alias("label"))
    parts = labelled.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("n_size"), F.min("vertex").alias("pivot"))
    top = F.max(F.struct("n", F.xxhash64("label").alias("h"), F.col("label").alias("main"), "pivot", "n_size")).alias("top")
    largest = parts.groupBy("key").agg(top, F.sum("n").alias("all"), F.sum("n_size").alias("all_size")).where("all > top.n")
    return labelled.join(largest.select("key", "top.main", "top.pivot", "top.n", "top.n_size", "all", "all_size"), "key")
