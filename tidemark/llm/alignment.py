"""Alignment of the tokens of two vocabularies, by lockstep merging.

A batch of documents is tokenised twice, and one state vector holds, for every
document of the batch, the next token of A and of B and where its open group began.
Each step compares the byte ends the two pointers stand at, for all documents at
once, advances the pointer that is behind (both where they meet), and where they
meet emits the cut and the group of tokens that it closes: all pairs of the group
are links. Finished documents leave the vector. A long document enters as several
lanes, cut behind words where both vocabularies end a token in any case, so that no
single document keeps a nearly empty vector going.

How many documents hold a pair linked is summed in Spark. A block of documents sends
each of its pairs once, whatever its documents; the sums come back to the block that
sent them, so nothing of the size of the corpus meets in one task.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from tidemark.errors import ConfigurationError
from tidemark.llm.common import scratch, stored, whole

FOLDER = "/opt/tokenizers"
BYTE_BPE, PIECE_BPE = "byte_bpe_50k.json", "piece_bpe_32k.model"
# Bytes of text whose tokens a task holds at once; a longer text stands alone.
BLOCK_BYTES = 4 << 20
_CACHED, _CACHED_LENGTH = 400_000, 64
# Tokens of A after which a document goes on in another lane.
_LANE = 512

# A word with the white space before it. Pieces of B hold spaces only in front and tokens
# of A white space only in front, so both vocabularies split a text here in any case.
_SEGMENT = re.compile(r"\s*\S+(?:[^\S \n]\s*\S+)*(?:\s+\Z)?|\s+")
# Where this is not found, spaces and line feeds stand alone and segments start at each.
_RUN = re.compile(r"\s[ \n]|\s\Z")

_BLOCK = (
    "block bigint, doc_id array<bigint>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, n_links array<bigint>, "
    "sha array<string>, groups array<string>, n_pairs array<bigint>, a array<int>, b array<int>, docs array<bigint>, place binary, times binary"
)
_ANSWER = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string, groups string"


def byte_level() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones for themselves, others from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


# Fixed value: how byte-level vocabularies of this kind cut a text before they merge bytes.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _flat(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, rows), np.int64, len(rows))
    return np.fromiter(chain.from_iterable(rows), np.int64, int(sizes.sum())), sizes


class Vocabularies:
    """Both tokenizers, with the bytes of every token."""

    def __init__(self, a_model: bytes, b_model: bytes) -> None:
        import tiktoken
        from sentencepiece import SentencePieceProcessor

        model = json.loads(a_model)
        of, special = byte_level(), {x["content"] for x in model["added_tokens"]}
        ranks = {bytes(map(of.__getitem__, t)): i for t, i in model["model"]["vocab"].items() if t not in special}
        merged = ["".join(x.split(" ") if isinstance(x, str) else x) for x in model["model"]["merges"]]
        ids = [model["model"]["vocab"][t] for t in merged]
        if ids != sorted(ids) or model["pre_tokenizer"]["type"] != "ByteLevel" or model["pre_tokenizer"]["add_prefix_space"] or model["normalizer"]:
            raise ConfigurationError("Vocabulary A must be a plain byte-level one whose ids stand in the order of its merges.")
        # special tokens are left out, so their strings in texts are plain text
        self.a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = SentencePieceProcessor(model_proto=b_model)
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.a_bytes[i] = token
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.b_bytes.append(bytes([int(piece[3:-1], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        self.a_length, self.b_length = (np.fromiter(map(len, x), np.int64, len(x)) for x in (self.a_bytes, self.b_bytes))
        self.a_bits, self.b_bits = (len(x).bit_length() for x in (self.a_bytes, self.b_bytes))
        # a piece that reached over the start of a segment would join two
        self.separable = not any(re.search(r"\S[ \n]", x.decode()) for i, x in enumerate(self.b_bytes) if not self.b.is_byte(i))

    def segments(self, text: str) -> list[str]:
        """The segments of a space and the text; a single space in front of one is left out."""
        spaced = " " + text
        if not self.separable:
            return [spaced]
        if not _RUN.search(spaced):
            return text.replace("\n", " \n").split(" ")
        return [s[1:] if s[0] == " " and not s[1:2].isspace() and s != " " else s for s in _SEGMENT.findall(spaced)]

    def _of_a(self, segments: list[str], raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Segments are encoded as one text, and the tokens dealt out by their bytes; white space at an end would run into the next."""
        if not self.separable or any(s[-1].isspace() for s in segments):
            return _flat([self.a.encode_ordinary(s) for s in segments])
        ids = np.array(self.a.encode_ordinary("".join(segments)), np.int64)
        ends = np.cumsum(self.a_length[ids])
        stop = np.searchsorted(ends, np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw))), "right")
        return ids, np.diff(stop, prepend=0)

    def encode(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of A and tokens in each segment, the same of B, and whether both give the bytes of a segment back."""
        segments = [s if s[0] in " \n" else " " + s for s in segments]
        raw = [s.encode() for s in segments]
        a, in_a = self._of_a(segments, raw)
        # B puts a space in front by itself: it replaces that of the segment, or is taken off again
        rows = self.b.encode([s.removeprefix(" ") for s in segments], num_threads=1)
        space = [self.b.piece_to_id("▁")]
        b, in_b = _flat([x[1:] if s[:1] != " " and x[:1] == space else x for s, x in zip(segments, rows)])
        whole_text, good = b"".join(raw), np.ones(len(segments), bool)
        for ids, sizes, known in ((a, in_a, self.a_bytes), (b, in_b, self.b_bytes)):
            tokens = [known[i] for i in ids.tolist()]
            if b"".join(tokens) != whole_text or np.any(self._bytes(ids, sizes, known) != np.fromiter(map(len, raw), np.int64, len(raw))):
                stop = np.cumsum(sizes)
                good &= [b"".join(tokens[i:j]) == r for i, j, r in zip((stop - sizes).tolist(), stop.tolist(), raw)]
        return a, in_a, b, in_b, good

    def _bytes(self, ids: np.ndarray, sizes: np.ndarray, known: list[bytes]) -> np.ndarray:
        length = self.a_length if known is self.a_bytes else self.b_length
        total = np.r_[0, np.cumsum(length[ids])]
        stop = np.cumsum(sizes)
        return total[stop] - total[stop - sizes]


class _Ragged:
    """Rows of integers in one array."""

    def __init__(self) -> None:
        self.values, self.starts = np.zeros(0, np.int64), np.zeros(1, np.int64)

    def add(self, values: np.ndarray, sizes: np.ndarray) -> None:
        self.values = np.concatenate([self.values, values])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows one after the other, and the size of each."""
        size = self.starts[rows + 1] - self.starts[rows]
        return self.values[_repeated(self.starts[rows], size)], size


class Tokens:
    """Ids of texts in both vocabularies; those of short segments are kept for later texts."""

    def __init__(self, words: Vocabularies) -> None:
        self.words = words
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.a, self.b, self.good = _Ragged(), _Ragged(), np.zeros(0, bool)

    def of(self, texts: list[str]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """``[ids of A, tokens of A in each segment, ids of B, tokens of B in each segment]``, the text of each segment, and whether a text has tokens."""
        parts = [self.words.segments(t) if t else [] for t in texts]
        new = set(chain.from_iterable(parts)).difference(self.place)
        open_end = [s for s in new if s[-1].isspace()]
        for part in filter(None, (list(new.difference(open_end)), open_end)):
            a, in_a, b, in_b, good = self.words.encode(part)
            self.place.update(zip(part, range(len(self.place), len(self.place) + len(part))))
            self.a.add(a, in_a)
            self.b.add(b, in_b)
            self.good = np.r_[self.good, good]
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        row = np.fromiter(map(self.place.__getitem__, chain.from_iterable(parts)), np.int64, int(sizes.sum()))
        text = np.repeat(np.arange(len(texts)), sizes)
        good = (np.bincount(text, ~self.good[row], len(texts)) == 0) & (sizes > 0)
        kept = good[text]
        row, text = row[kept], text[kept]
        found = []
        for table in (self.a, self.b):
            found += table.take(row)
        if len(self.place) > _CACHED or any(len(s) > _CACHED_LENGTH for s in new):
            self.clear()
        return found, text, good


def lockstep(a_ends: np.ndarray, b_ends: np.ndarray, a_sizes: np.ndarray, b_sizes: np.ndarray) -> np.ndarray:
    """Groups of tokens between common ends, in order: rows ``first of A, end of A, first of B, end of B``.

    ``a_ends`` and ``b_ends`` are the byte ends of the tokens of all lanes, one after the
    other; ``a_sizes`` and ``b_sizes`` are the tokens of each lane. In every lane the last
    tokens of A and of B end at the same byte.
    """
    a_stop, b_stop = np.cumsum(a_sizes), np.cumsum(b_sizes)
    live = a_sizes > 0
    first_a, first_b = (a_stop - a_sizes)[live], (b_stop - b_sizes)[live]
    # next token of A and of B, first token of the open group in A and in B, end of the lane in A
    state = np.stack([first_a, first_b, first_a, first_b, a_stop[live]]).astype(np.int64)
    out = np.empty((4, min(len(a_ends), len(b_ends))), np.int64)
    n = 0
    while state.shape[1]:
        x, y = a_ends[state[0]], b_ends[state[1]]
        state[0] += x <= y
        state[1] += y <= x
        met = np.flatnonzero(x == y)
        if len(met):
            closed = state[:, met]
            out[:, n : n + len(met)] = closed[[2, 0, 3, 1]]
            n += len(met)
            state[2:4, met] = closed[:2]
            over = closed[0] == closed[4]
            if over.any():
                state = np.delete(state, met[over], axis=1)
    # emitted step by step over all lanes: put into the order of the tokens
    at = np.full(len(a_ends), -1, np.int64)
    at[out[0, :n]] = np.arange(n)
    return out[:, at[at >= 0]]


def _repeated(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``first, first + 1, ...`` of each row, one after the other."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - ends + size, size)


def links(groups: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``group, token of A, token of B`` of every link."""
    a, a_end, b, b_end = groups
    by_a = np.repeat(np.arange(len(a)), a_end - a)
    token_a = _repeated(a, a_end - a)
    many = (b_end - b)[by_a]
    return np.repeat(by_a, many), np.repeat(token_a, many), _repeated(b[by_a], many)


@functools.lru_cache(maxsize=2)
def _written(n: int) -> pa.Array:
    """Each id below n with each of the signs that may follow it."""
    return pa.array([f"{i}{sign}" for sign in (",", "|", ";", "") for i in range(n)])


def written_groups(groups: np.ndarray, a_ids: np.ndarray, b_ids: np.ndarray, a_sizes: np.ndarray, b_sizes: np.ndarray, n: int) -> list[memoryview]:
    """``a1,a2|b1;a3|b2,b3`` of each document."""
    a, a_end, b, b_end = groups
    out = np.empty(len(a_ids) + len(b_ids), np.int64)
    sign = np.zeros(len(a_ids), np.int64)
    sign[a_end - 1] = 1
    out[np.arange(len(a_ids)) + np.repeat(b, a_end - a)] = sign * n + a_ids
    sign = np.zeros(len(b_ids), np.int64)
    sign[b_end - 1] = 2
    sign[(np.cumsum(b_sizes) - 1)[b_sizes > 0]] = 3
    out[np.arange(len(b_ids)) + np.repeat(a_end, b_end - b)] = sign * n + b_ids
    text = _written(n).take(pa.array(out))
    offsets, data = (np.frombuffer(x, t) if x is not None else np.zeros(1, t) for x, t in zip(text.buffers()[1:], (np.int32, np.uint8)))
    stop = np.r_[0, np.cumsum(a_sizes + b_sizes)]
    return [memoryview(data)[offsets[i] : offsets[j]] for i, j in zip(stop, stop[1:])]


def lanes(text: np.ndarray, a_sizes: np.ndarray, lane: int = _LANE) -> np.ndarray:
    """The lane of each segment: a new one for each text, and within it after every ``lane`` tokens of A."""
    if not len(text):
        return text
    before = np.cumsum(a_sizes) - a_sizes
    first = np.r_[True, text[1:] != text[:-1]]
    part = (before - np.maximum.accumulate(np.where(first, before, 0))) // lane
    return np.cumsum(first | np.r_[True, part[1:] != part[:-1]]) - 1


def _packed(values: np.ndarray) -> bytes:
    return pa.compress(values.astype("<i4").tobytes(), "zstd", asbytes=True)


def _unpacked(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, 4 * n, "zstd", asbytes=True), "<i4").astype(np.int64)


def _aligned(tokens: Tokens, texts: list[str], with_groups: bool) -> dict:
    words = tokens.words
    (a_ids, in_a, b_ids, in_b), text, good = tokens.of(texts)
    n_a, n_b = (np.bincount(text, x, len(texts)).astype(np.int64) for x in (in_a, in_b))
    lane = lanes(text, in_a)
    sizes = (np.bincount(lane, x).astype(np.int64) for x in (in_a, in_b))
    groups = lockstep(np.cumsum(words.a_length[a_ids]), np.cumsum(words.b_length[b_ids]), *sizes)
    doc_of_a = np.repeat(np.arange(len(texts)), n_a)
    n_groups = np.bincount(doc_of_a[groups[0]], minlength=len(texts))
    written = written_groups(groups, a_ids, b_ids, n_a, n_b, max(len(words.a_bytes), len(words.b_bytes)))
    group, x, y = links(groups)
    doc = doc_of_a[x]
    n_links = np.bincount(doc, minlength=len(texts))
    code = np.sort((doc << words.a_bits + words.b_bits) | (a_ids[x] << words.b_bits) | b_ids[y])
    first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]]) if len(code) else np.zeros(0, np.int64)
    times = np.diff(np.r_[first, len(code)])
    code = code[first]
    pair = code & ((1 << words.a_bits + words.b_bits) - 1)
    own, place, docs = np.unique(pair, return_inverse=True, return_counts=True)
    return {
        "n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links,
        "sha": [hashlib.sha256(w).hexdigest() if g else "" for w, g in zip(written, good)],
        "groups": [bytes(w).decode() if with_groups else None for w in written],
        "n_pairs": np.bincount(code >> words.a_bits + words.b_bits, minlength=len(texts)),
        "a": own >> words.b_bits, "b": own & ((1 << words.b_bits) - 1), "docs": docs,
        "place": _packed(np.diff(place, prepend=0)), "times": _packed(times),
    }


def _blocks(batches: Iterator[pa.RecordBatch], block_bytes: int) -> Iterator[tuple[pa.Array, list[str]]]:
    """Ids and texts of about ``block_bytes`` at a time."""
    ids, texts, size = [], [], 0
    for batch in batches:
        length = pc.binary_length(batch["text"]).to_pylist()
        for i, text, n in zip(batch["doc_id"].to_pylist(), batch["text"], length):
            if texts and size + n > block_bytes:
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(i)
            texts.append(text.as_py())
            size += n
    if texts:
        yield ids, texts


def _align(a_model, b_model, with_groups: bool, block_bytes: int):
    kinds = {
        "doc_id": pa.int64(), "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(), "sha": pa.string(),
        "groups": pa.string(), "n_pairs": pa.int64(), "a": pa.int32(), "b": pa.int32(), "docs": pa.int64(),
    }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = None
        # the table of blocks is written once: tasks tried again number theirs alike
        number = TaskContext.get().partitionId() << 32
        for ids, texts in _blocks(batches, block_bytes):
            tokens = tokens or Tokens(Vocabularies(a_model.value, b_model.value))
            row = {"doc_id": ids, **_aligned(tokens, texts, with_groups)}
            columns = {"block": pa.array([number], pa.int64())}
            columns |= {c: pa.array([row[c]], pa.list_(k)) for c, k in kinds.items()}
            columns |= {c: pa.array([row[c]], pa.binary()) for c in ("place", "times")}
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
            number += 1

    return run


def _answered(blocks: pa.Table, answers: pa.Table) -> pa.Table:
    """The rows of a block, with the corpus-wide counts of its pairs."""
    row = {c: blocks[c][0].as_py() if c in ("place", "times") else blocks[c].combine_chunks().flatten() for c in blocks.column_names if c != "block"}
    order = np.argsort(answers["pos"].to_numpy())
    count, best = (answers[c].to_numpy()[order].astype(np.int64) for c in ("n", "best"))
    per_doc = row["n_pairs"].to_numpy()
    total = int(per_doc.sum())
    place, times = np.cumsum(_unpacked(row["place"], total)), _unpacked(row["times"], total)
    stop = np.cumsum(per_doc)
    summed = [np.r_[0, np.cumsum(times * of[place])] for of in (best, count)]
    n_best, count_sum = (s[stop] - s[stop - per_doc] for s in summed)
    columns = [row[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
    columns += [pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64()), row["sha"], row["groups"]]
    return pa.table(columns, names=[c.split()[0] for c in _ANSWER.split(", ")])


def pair_counts(pairs: DataFrame) -> DataFrame:
    """``a, b, n, best``: documents that hold a pair, and whether no pair of the same ``a`` is in more (1 or 0)."""
    counts = pairs.groupBy("a", "b").agg(F.sum("docs").alias("n"))
    highest = F.max("n").over(Window.partitionBy("a"))
    return counts.select("a", "b", "n", (F.col("n") == highest).cast("int").alias("best"))


def align_tokens(
    docs: DataFrame, folder: str = FOLDER, a_name: str = BYTE_BPE, b_name: str = PIECE_BPE, with_groups: bool = False, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, groups`` of every row of ``docs``.

    A is a byte-level vocabulary (of the tokenizers library) over a space and the text, B
    a sentencepiece model over the text. A null or empty text, and one that either
    vocabulary does not give back byte by byte, has no tokens: zeros and an empty string.
    Every row counts as a document, so repeated rows and ids each count; a null id stays
    null. Texts are taken whole, whatever their length. ``groups`` (``a1,a2|b1;a3|b2``)
    is null unless asked for. An empty table gives no row; other columns are not read.
    """
    spark = docs.sparkSession
    models = []
    for name in (a_name, b_name):
        with open(os.path.join(folder, name), "rb") as file:
            models.append(spark.sparkContext.broadcast(file.read()))  # the two vocabulary files: of fixed size
    work = scratch(spark, "align")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole("text").alias("text"))
    made = texts.mapInArrow(_align(*models, with_groups, block_bytes), _BLOCK)
    blocks = stored(made, f"{work}/blocks")
    pairs = blocks.select("block", F.posexplode(F.arrays_zip("a", "b", "docs")).alias("pos", "pair")).select("block", "pos", "pair.*")
    counts = stored(pair_counts(pairs), f"{work}/counts")
    answers = pairs.join(counts, ["a", "b"]).select(F.col("block").alias("of_block"), "pos", "n", "best")
    # a block whose documents have no tokens gets no answer, and goes on without
    rows = blocks.drop("a", "b", "docs").groupBy("block").cogroup(answers.groupBy("of_block"))
    return rows.applyInArrow(_answered, _ANSWER)


def align_digest(docs: DataFrame, folder: str = FOLDER) -> DataFrame:
    """The columns the alignment query returns."""
    return align_tokens(docs, folder).drop("groups")
