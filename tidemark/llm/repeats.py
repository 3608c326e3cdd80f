"""Substring dedup by seed and extend: winnowed anchors seed, spans and windows extend.

A window is ``length`` words. Of the ``width`` short word runs in it the one with
the smallest hash is its *anchor* (the last one on ties), so equal windows have
equal anchors at equal offsets. The neighbouring windows that share an anchor form
its *unit*, the longest text the anchor can vouch for. Units whose whole text
repeats are settled by one row each. Only where one anchor has several different
units, at the ends of maximal repeats, are single windows compared, one text of
each distinct unit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrays import WordHashes, mixed, rightmost_minima, signed, window_hashes
from tidemark.llm.common import LAST_ID, scratch, stored, whole

LENGTH = 50
SEED_WORDS = 16


def owner() -> Column:
    return F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST_ID))


class _Units:
    """Units of one text: first and last window, anchor and hash of each; hash of each window."""

    def __init__(self, h: np.ndarray, length: int, seed_words: int):
        grams = window_hashes(h, seed_words)
        at = rightmost_minima(grams, length - seed_words + 1)
        self.windows = window_hashes(h, length)
        self.first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        self.last = np.r_[self.first[1:] - 1, len(at) - 1]
        self.anchor = grams[at[self.first]]
        span = (self.last - self.first).astype(np.uint64)
        self.unit = mixed(mixed(self.windows[self.first], self.windows[self.last]), span)


def _seed(length: int, seed_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in batches:
            owners, anchors, units = [], [], []
            for doc, text in zip(batch["owner"].to_pylist(), batch["text"].to_pylist()):
                words = text.split()
                if len(words) >= length:
                    u = _Units(cache.of(words), length, seed_words)
                    owners.append(np.full(len(u.first), doc, np.int64))
                    anchors.append(u.anchor)
                    units.append(u.unit)
            if owners:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(owners)), pa.array(signed(np.concatenate(anchors))), pa.array(signed(np.concatenate(units)))],
                    names=["owner", "anchor", "unit"],
                )

    return run


def _extend(length: int, seed_words: int):
    """Windows of the units that must be compared window by window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in batches:
            owners, anchors, windows = [], [], []
            for doc, text, wanted in zip(*(batch[c].to_pylist() for c in ("owner", "text", "partial"))):
                u = _Units(cache.of(text.split()), length, seed_words) if len(text.split()) >= length else None
                chosen = np.flatnonzero(np.isin(signed(u.unit), np.array(wanted, np.int64))) if u else []
                for i in chosen:
                    found = u.windows[u.first[i] : u.last[i] + 1]
                    owners.append(np.full(len(found), doc, np.int64))
                    anchors.append(np.full(len(found), u.anchor[i], np.uint64))
                    windows.append(found)
            if owners:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(owners)), pa.array(signed(np.concatenate(anchors))), pa.array(signed(np.concatenate(windows)))],
                    names=["owner", "anchor", "window"],
                )

    return run


def _covered(h: np.ndarray, length: int, seed_words: int, units: list[int], windows: list[int]) -> np.ndarray:
    """Which words lie in a window that an earlier document holds."""
    u = _Units(h, length, seed_words)
    starts = np.isin(signed(u.windows), np.array(windows, np.int64))
    edge = np.zeros(len(h) + 1, np.int64)
    for i in np.flatnonzero(np.isin(signed(u.unit), np.array(units, np.int64))):
        starts[u.first[i] : u.last[i] + 1] = True
    hits = np.flatnonzero(starts)
    edge[hits] += 1
    edge[hits + length] -= 1
    return np.cumsum(edge[:-1]) > 0


def _remove(length: int, seed_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in batches:
            n_words, n_removed, kept_texts, spans = [], [], [], []
            for text, units, windows in zip(*(batch[c].to_pylist() for c in ("text", "units", "windows"))):
                words = text.split()
                gone = np.zeros(len(words), bool)
                if (units or windows) and len(words) >= length:
                    gone = _covered(cache.of(words), length, seed_words, units or [], windows or [])
                    words_kept = [w for w, g in zip(words, gone.tolist()) if not g]
                else:
                    words_kept = words
                ends = np.flatnonzero(np.diff(np.r_[0, gone.astype(np.int8), 0]))
                n_words.append(len(words))
                n_removed.append(len(words) - len(words_kept))
                kept_texts.append(b" ".join(words_kept))
                spans.append(ends.reshape(-1, 2).tolist())
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"], pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                    pa.array(spans, pa.list_(pa.list_(pa.int64()))), pa.array(kept_texts, pa.binary()).cast(pa.string()),
                    pa.array([hashlib.sha256(t).hexdigest() for t in kept_texts], pa.string()),
                ],
                names=["doc_id", "n_words", "n_removed", "spans", "kept_text", "kept_sha256"],
            )

    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, seed_words: int = SEED_WORDS) -> DataFrame:
    """``doc_id, n_words, n_removed, spans, kept_text, kept_sha256`` of every row of ``docs``.

    A word goes if a window of ``length`` words that covers it also starts in a
    document with a smaller id. ``spans`` are the maximal removed runs of words
    [start, end); the kept words are joined by single spaces. Null text has no
    words; texts shorter than a window stay whole. Rows that share an id are one
    document and do not remove from each other; null ids count as one document
    after all others. An empty table gives no row; other columns are not read.

    Memory per task is one Arrow batch; the number of anchors is about
    2 / (length - seed_words + 2) of the words.
    """
    if not 0 < seed_words < length:
        raise ValueError("seed_words must lie between 0 and length.")
    work = scratch(docs.sparkSession, "repeats")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), owner().alias("owner"), whole("text").cast("binary").alias("text"))
    seeds = texts.select("owner", "text").mapInArrow(_seed(length, seed_words), "owner bigint, anchor bigint, unit bigint")
    seeds = stored(seeds, f"{work}/seeds")
    units = seeds.groupBy("anchor", "unit").agg(F.min("owner").alias("first"), F.max("owner").alias("last"))
    # One anchor with several units: repeats may share a part of them only.
    contested = units.groupBy("anchor").agg((F.count(F.lit(1)) > 1).alias("contested"))
    units = units.join(contested, "anchor").where(F.col("contested") | (F.col("first") < F.col("last")))
    lists = seeds.join(units.drop("last"), ["anchor", "unit"]).where(F.col("contested") | (F.col("first") < F.col("owner")))
    repeated = F.col("first") < F.col("owner")
    lists = lists.groupBy("owner").agg(
        F.collect_set(F.when(repeated, F.col("unit"))).alias("units"), F.collect_set(F.when(~repeated, F.col("unit"))).alias("partial")
    )
    lists = stored(lists, f"{work}/units")

    open_texts = texts.select("owner", "text").join(lists.where(F.size("partial") > 0).select("owner", "partial"), "owner")
    windows = open_texts.mapInArrow(_extend(length, seed_words), "owner bigint, anchor bigint, window bigint")
    windows = stored(windows, f"{work}/windows")
    firsts = windows.groupBy("anchor", "window").agg(F.min("owner").alias("first"), F.max("owner").alias("last")).where("first < last").drop("last")
    ends = windows.join(firsts, ["anchor", "window"]).where(F.col("first") < F.col("owner"))
    ends = ends.groupBy("owner").agg(F.collect_set("window").alias("windows"))

    removals = lists.where(F.size("units") > 0).select("owner", "units").join(ends, "owner", "full")
    marked = texts.join(stored(removals, f"{work}/removals"), "owner", "left").select("doc_id", "text", "units", "windows")
    return marked.mapInArrow(
        _remove(length, seed_words),
        "doc_id bigint, n_words bigint, n_removed bigint, spans array<array<bigint>>, kept_text string, kept_sha256 string",
    )


def repeat_digest(docs: DataFrame) -> DataFrame:
    """The columns the substring-dedup query returns."""
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")


REPEAT_SQL = r"""
WITH texts AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), windows AS (
    SELECT doc_id, i, sha256(array_to_string(ws[i:i + 49], ' ')) AS g
    FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM texts WHERE len(ws) >= 50)
), firsts AS (
    SELECT g, min(doc_id) AS first FROM windows GROUP BY g
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM windows JOIN firsts USING (g) WHERE first < doc_id
), words AS (
    SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS p FROM texts
), kept AS (
    SELECT doc_id, string_agg(w, ' ' ORDER BY p) AS t, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (doc_id)
"""
