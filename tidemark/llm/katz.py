"""Katz backoff language model over packed blocks of documents.

Documents are packed into *blocks* of about a million tokens: word ids local to the
block, and the hash of each word. What a block needs from the corpus (counts, sums
over contexts) it asks for by key. Keys are 64-bit hashes; each *bucket* is a range
of them and one reducer's work. A block sends each bucket its sorted distinct keys,
the bucket adds up over blocks and answers in the same order. A key occurs once
per block at most, so no word, however frequent, weighs on a bucket. Sums over
contexts travel as whole numbers by class of count, which deflate far better than
masses do, and a backoff weight goes only to blocks that back off from its context.

Level 1 is a Good-Turing unigram model whose left-over mass is the one unknown
word's. At level 2, P(w|h) = d(c) c(h,w) / c(h) for pairs kept in the model and
a(h) P(w) else, with a(h) = (mass the kept pairs of h leave) / (P mass of all
words that are not kept after h), so every context sums to one. Pairs seen less
than ``min_count`` times are counted, and then left to backoff.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrays import WordHashes, mixed
from tidemark.llm.common import scratch, shuffle_partitions, stored, whole

# Good-Turing discounts apply to counts up to this one, as is usual for Katz models.
GT_MAX = 5
MIN_COUNT = 1
BLOCK_TOKENS = 600_000
BUCKET_KEYS = 1_000_000
# Tasks over blocks per shuffle partition: a task holds its blocks' answers at once.
SPREAD = 4
END = b"\n"  # no word holds white space
_START = np.uint64(0x5EED_0F_5E17E9CE)

BLOCK = "blk bigint, n_tokens bigint, n_types bigint, doc_ids array<bigint>, held binary, lengths binary, ids binary, words binary"
ASK = "level int, bucket int, blk bigint, keys binary, counts array<binary>"
ANSWER = "kind string, level int, bucket int, blk bigint, a binary, b binary, stats array<bigint>"


def _planes(values: np.ndarray) -> bytes:
    """The bytes of numbers plane by plane, which compresses far better than in order."""
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes() if len(values) else b""


def _unplanes(data: bytes, dtype: type) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(dtype).ravel()


def packed(values: np.ndarray) -> bytes:
    """Counts and sums, most of them small or zero, are deflated at once."""
    return zlib.compress(_planes(values), 1)


def unpacked(data: bytes, dtype: type) -> np.ndarray:
    return _unplanes(zlib.decompress(data), dtype)


def _packed_keys(keys: np.ndarray) -> bytes:
    return _planes(np.diff(keys, prepend=np.uint64(0)))


def _unpacked_keys(data: bytes) -> np.ndarray:
    return np.cumsum(_unplanes(data, np.uint64), dtype=np.uint64)


def _pack_blocks(block_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, number = WordHashes(), TaskContext.get().partitionId() << 24
        docs: list[int | None] = []
        held: list[bool] = []
        hashes: list[np.ndarray] = []
        lengths: list[int] = []

        def block() -> pa.RecordBatch:
            words, ids = np.unique(np.concatenate(hashes), return_inverse=True)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()), pa.array([len(ids)], pa.int64()), pa.array([len(words)], pa.int64()),
                    pa.array([docs], pa.list_(pa.int64())), pa.array([np.array(held, np.uint8).tobytes()]),
                    pa.array([np.array(lengths, np.uint32).tobytes()]), pa.array([_planes(ids.astype(np.uint32))]), pa.array([_packed_keys(words)]),
                ],
                names=["blk", "n_tokens", "n_types", "doc_ids", "held", "lengths", "ids", "words"],
            )

        size = 0
        for batch in batches:
            for doc, text, out in zip(*(batch[c].to_pylist() for c in ("doc_id", "text", "held_out"))):
                h = cache.of([*text.lower().split(), END])  # bytes: A-Z only
                docs.append(doc)
                held.append(out)
                hashes.append(h)
                lengths.append(len(h))
                size += len(h)
                if size >= block_tokens:
                    yield block()
                    number += 1
                    docs, held, hashes, lengths, size = [], [], [], [], 0
        if docs:
            yield block()

    return run


class _Block:
    """A block's tokens and its distinct pairs, the same each time it is read."""

    def __init__(self, row: dict):
        self.number = row["blk"]
        self.doc_ids = row["doc_ids"]
        self.held = np.frombuffer(row["held"], np.uint8).astype(bool)
        self.lengths = np.frombuffer(row["lengths"], np.uint32).astype(np.int64)
        self.ids = _unplanes(row["ids"], np.uint32).astype(np.int32)
        self.words = _unpacked_keys(row["words"])
        self.train = np.repeat(~self.held, self.lengths)

    def pairs(self) -> None:
        """Distinct (context, word) pairs in order of their keys; ``of_token`` names each token's."""
        n = len(self.words)
        context = np.r_[np.int32(n), self.ids[:-1]].astype(np.int64)
        context[np.r_[0, np.cumsum(self.lengths)[:-1]]] = n  # texts begin after the start mark
        local, of_token = np.unique(context * (n + 1) + self.ids, return_inverse=True)
        left, right = (local // (n + 1)).astype(np.int32), (local % (n + 1)).astype(np.int32)
        self.contexts = np.r_[self.words, _START]  # hashes of contexts
        keys = mixed(self.contexts[left], self.words[right])
        order = np.argsort(keys)
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        self.pair_keys, self.left, self.right, self.of_token = keys[order], left[order], right[order], rank[of_token]
        self.pair_counts = np.bincount(self.of_token[self.train], minlength=len(order))

    def word_counts(self) -> np.ndarray:
        return np.bincount(self.ids[self.train], minlength=len(self.words))


def _asks(level: int, number: int, keys: np.ndarray, columns: list[np.ndarray], buckets: int) -> Iterator[tuple]:
    """Sorted keys and their values, or rows of values, cut into bucket ranges."""
    step = (1 << 64) // buckets + 1
    edges = np.searchsorted(keys, np.array([min(step * i, (1 << 64) - 1) for i in range(1, buckets)], np.uint64))
    for bucket, (a, b) in enumerate(zip(np.r_[0, edges], np.r_[edges, len(keys)])):
        if a < b:
            yield level, bucket, number, _packed_keys(keys[a:b]), [packed(c[..., a:b].ravel()) for c in columns]


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64()), "array<binary>": pa.list_(pa.binary())}
    fields = [f.strip().split(" ") for f in schema.split(",")]
    columns = list(zip(*rows)) if rows else [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields])


def _ask_counts(buckets: tuple[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block = _Block(batch.slice(i, 1).to_pylist()[0])
                rows = list(_asks(1, block.number, block.words, [block.word_counts().astype(np.uint32)], buckets[0]))
                block.pairs()
                rows += _asks(2, block.number, block.pair_keys, [block.pair_counts.astype(np.uint32)], buckets[1])
                yield _batch(rows, ASK)

    return run


def _parts(table: pa.Table) -> list[dict]:
    return sorted(table.to_pylist(), key=lambda r: r["blk"])


def _add_counts(min_count: int):
    def run(table: pa.Table) -> pa.Table:
        parts = _parts(table)
        level, bucket = parts[0]["level"], parts[0]["bucket"]
        keys = [_unpacked_keys(p["keys"]) for p in parts]
        distinct, first, where = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
        counts = np.bincount(where, weights=np.concatenate([unpacked(p["counts"][0], np.uint32) for p in parts])).astype(np.uint32)
        owned = np.zeros(len(where), np.uint8)
        owned[first] = 1  # one block speaks for each key
        rows, at = [], 0
        for p, k in zip(parts, keys):
            here = slice(at, at + len(k))
            rows.append(("answer", level, bucket, p["blk"], packed(counts[where[here]]), np.packbits(owned[here]).tobytes(), None))
            at += len(k)
        kept = counts >= (min_count if level > 1 else 1)
        rows.append(("model", level, bucket, None, _packed_keys(distinct[kept]), packed(counts[kept]), None))
        seen = np.bincount(np.minimum(counts, GT_MAX + 2), minlength=GT_MAX + 3)
        stats = [int(counts.sum(dtype=np.int64)), int((counts > 0).sum()), *map(int, seen[1 : GT_MAX + 2])]
        rows.append(("stats", level, bucket, None, None, None, stats))
        return pa.Table.from_batches([_batch(rows, ANSWER)])

    return run


def discounts(seen: list[int]) -> np.ndarray:
    """Katz's Good-Turing discount for counts 0 to GT_MAX; 1 where the counts of counts allow none."""
    d = np.ones(GT_MAX + 1)
    if seen[0]:
        cut = (GT_MAX + 1) * seen[GT_MAX] / seen[0]
        for r in range(1, GT_MAX + 1):
            if seen[r - 1] and cut < 1:
                value = ((r + 1) * seen[r] / seen[r - 1] / r - cut) / (1 - cut)
                d[r] = value if 0 < value < 1 else 1.0
    return d


class _Model:
    """What all blocks know: sizes, discounts and the unigram probabilities by count."""

    def __init__(self, stats: dict[int, list[int]], min_count: int):
        self.tokens, self.types, *seen = stats[1]
        self.min_count = min_count
        self.d1, self.d2 = discounts(seen), discounts(stats[2][2:])
        kept = self.tokens - sum((1 - self.d1[r]) * r * n for r, n in enumerate(seen[:GT_MAX], 1))
        self.all = self.tokens if kept < self.tokens else self.tokens + 1
        self.unknown = 1 - kept / self.all

    @staticmethod
    def _discounted(counts: np.ndarray, d: np.ndarray) -> np.ndarray:
        return counts * np.where(counts <= GT_MAX, d[np.minimum(counts, GT_MAX)], 1.0)

    def unigram(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts > 0, self._discounted(counts, self.d1) / self.all, self.unknown)

    def pair_mass(self, counts: np.ndarray) -> np.ndarray:
        """Discounted counts of pairs; 0 for those left to backoff."""
        return np.where(counts >= self.min_count, self._discounted(counts, self.d2), 0.0)

    def backs_off(self, block: _Block, pairs: np.ndarray) -> np.ndarray:
        """Whether a block has a pair that is left to backoff, by context."""
        return np.bincount(block.left[self.pair_mass(pairs) <= 0], minlength=len(block.contexts)) > 0

    def base(self, counts: np.ndarray) -> np.ndarray:
        return (counts + 0.5) / (self.tokens + 0.5 * (self.types + 1))


def _answers(rows: list[dict], level: int) -> tuple[np.ndarray, np.ndarray]:
    rows = sorted((r for r in rows if r["level"] == level), key=lambda r: r["bucket"])
    counts = [unpacked(r["a"], np.uint32) for r in rows]
    owned = [np.unpackbits(np.frombuffer(r["b"], np.uint8))[: len(c)] for r, c in zip(rows, counts)]
    return np.concatenate(counts).astype(np.int64), np.concatenate(owned).astype(bool)


def _counted(row: dict) -> tuple[_Block, np.ndarray, np.ndarray, np.ndarray]:
    block = _Block(row)
    words, _ = _answers(row["answers"], 1)
    block.pairs()
    pairs, owned = _answers(row["answers"], 2)
    return block, words, pairs, owned


def _by_class(context: np.ndarray, counts: np.ndarray, n: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Per context, how many of its counts are 1 to GT_MAX each, and the sum of the higher ones."""
    few = [np.bincount(context[counts == r], minlength=n) for r in range(1, GT_MAX + 1)]
    many = counts > GT_MAX
    return few, np.bincount(context[many], weights=counts[many], minlength=n)


def _ask_contexts(model: _Model, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block, words, pairs, owned = _counted(batch.slice(i, 1).to_pylist()[0])
                n = len(block.contexts)
                total = np.bincount(block.left, weights=block.pair_counts, minlength=n)
                kept = owned & (model.pair_mass(pairs) > 0)
                few_pairs, many_pairs = _by_class(block.left[kept], pairs[kept], n)
                few_words, many_words = _by_class(block.left[kept], words[block.right[kept]], n)
                order = np.argsort(block.contexts)
                values = [
                    np.stack([total, *few_pairs, *few_words]).astype(np.uint32)[:, order],
                    np.stack([many_pairs, many_words]).astype(np.uint64)[:, order],
                    model.backs_off(block, pairs).astype(np.uint8)[order],
                ]
                yield _batch(list(_asks(3, block.number, block.contexts[order], values, buckets)), ASK)

    return run


def _add_contexts(model: _Model):
    def run(table: pa.Table) -> pa.Table:
        parts = _parts(table)
        keys = [_unpacked_keys(p["keys"]) for p in parts]
        distinct, where = np.unique(np.concatenate(keys), return_inverse=True)

        total, kept, lower = np.zeros((3, len(distinct)))
        classes, at = np.arange(1, GT_MAX + 1), 0
        for p, k in zip(parts, keys):
            here = where[at : at + len(k)]  # a block names a key once
            few, many = (unpacked(c, t).reshape(-1, len(k)) for c, t in zip(p["counts"], (np.uint32, np.uint64)))
            total[here] += few[0]
            kept[here] += (model.d2[1:] * classes) @ few[1 : GT_MAX + 1] + many[0]
            lower[here] += (model.d1[1:] * classes) @ few[GT_MAX + 1 :] + many[1]
            at += len(k)
        lower /= model.all
        # a context whose kept pairs leave nothing gives up one count
        whole_ = np.where(kept >= total, total + 1, total)
        whole_ = np.where(total == 0, 1.0, whole_)
        backoff = np.where(total == 0, 1.0, (1 - kept / whole_) / (1 - lower))
        rows, at = [], 0
        for p, k in zip(parts, keys):
            here = where[at : at + len(k)]
            asked = unpacked(p["counts"][2], np.uint8).astype(bool)
            rows.append(("answer", 3, p["bucket"], p["blk"], packed(whole_[here].astype(np.uint64)), packed(backoff[here[asked]]), None))
            at += len(k)
        chosen = kept > 0
        rows.append(("model", 3, parts[0]["bucket"], None, _packed_keys(distinct[chosen]), packed(backoff[chosen]), None))
        return pa.Table.from_batches([_batch(rows, ANSWER)])

    return run


def _score(model: _Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                block, words, pairs, _ = _counted(row)
                rows = sorted(row["contexts"], key=lambda r: r["bucket"])
                order = np.argsort(block.contexts)
                whole_, backoff = np.empty(len(order)), np.ones(len(order))
                whole_[order] = np.concatenate([unpacked(r["a"], np.uint64) for r in rows])
                asked = order[model.backs_off(block, pairs)[order]]
                backoff[asked] = np.concatenate([unpacked(r["b"], np.float64) for r in rows])
                mass = model.pair_mass(pairs)
                p = np.where(mass > 0, mass / whole_[block.left], backoff[block.left] * model.unigram(words)[block.right])
                starts = np.r_[0, np.cumsum(block.lengths)[:-1]]
                known = np.add.reduceat((words > 0)[block.ids].astype(np.int64), starts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(block.doc_ids, pa.int64()), pa.array(block.held), pa.array(block.lengths), pa.array(known),
                        pa.array(np.full(len(starts), model.tokens, np.int64)),
                        pa.array(np.add.reduceat(np.log10(model.base(words))[block.ids], starts)),
                        pa.array(np.add.reduceat(np.log10(p)[block.of_token], starts)),
                    ],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    return run


SCORES = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


def fifth(doc_id: str = "doc_id") -> Column:
    """Whether a document is held out: one in five, by a checksum of its id; null ids are not."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 1, F.lit(False))


def katz_scores(
    docs: DataFrame, held_out: Column | None = None, min_count: int = MIN_COUNT, block_tokens: int = BLOCK_TOKENS
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row of ``docs``.

    The model learns from the rows that ``held_out`` (one in five by default) does
    not mark, and scores all. Tokens are the words with A-Z lower-cased and one end
    token, so null and empty texts have one token. Ids are carried as they are, null
    and repeated ones too; other columns are not read. An empty table gives no row.
    Without training rows every token is the unknown one, with probability 1.
    """
    spark = docs.sparkSession
    work = scratch(spark, "katz")
    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), whole("text").cast("binary").alias("text"),
        (fifth() if held_out is None else F.coalesce(held_out, F.lit(False))).alias("held_out"),
    )
    # Blocks are bucketed by number, so that the joins below move answers and not blocks.
    table = f"katz_{uuid.uuid4().hex}"
    packed = texts.mapInArrow(_pack_blocks(block_tokens), BLOCK)
    spread = SPREAD * shuffle_partitions(spark)
    packed.write.format("parquet").bucketBy(spread, "blk").option("path", f"{work}/blocks").option("compression", "zstd").saveAsTable(table)
    blocks = spark.table(table)
    # The catalog entry is needed to resolve the table, not to read it.
    spark.sql(f"DROP TABLE {table}")
    n_tokens, n_types = blocks.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)), F.coalesce(F.sum("n_types"), F.lit(0))).first()
    buckets = tuple(max(1, -(-n // BUCKET_KEYS)) for n in (n_types, n_tokens))

    asked = blocks.mapInArrow(_ask_counts(buckets), ASK)
    answers = stored(asked.groupBy("level", "bucket").applyInArrow(_add_counts(min_count), ANSWER), f"{work}/counts", "kind")
    sums = [F.coalesce(F.sum(F.col("stats")[i]), F.lit(0)).alias(f"s{i}") for i in range(GT_MAX + 3)]
    found = {r["level"]: list(r)[1:] for r in answers.where("kind = 'stats'").groupBy("level").agg(*sums).collect()}  # two rows
    empty = [0] * (GT_MAX + 3)
    model = _Model({1: found.get(1, empty), 2: found.get(2, empty)}, min_count)

    def per_block(of: DataFrame, name: str) -> DataFrame:
        replies = of.where("kind = 'answer'").repartition(spread, "blk").groupBy("blk")
        return replies.agg(F.collect_list(F.struct("level", "bucket", "a", "b")).alias(name))

    counted = blocks.join(per_block(answers, "answers").hint("shuffle_merge"), "blk")
    contexts = counted.mapInArrow(_ask_contexts(model, buckets[0]), ASK).groupBy("level", "bucket").applyInArrow(_add_contexts(model), ANSWER)
    contexts = stored(contexts, f"{work}/contexts", "kind")
    known = counted.join(per_block(contexts, "contexts").hint("shuffle_merge"), "blk")
    return known.mapInArrow(_score(model), SCORES)
