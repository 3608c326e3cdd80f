"""Quality classifier: cumulative-link regression on graded ratings of hashed text.

All grades share one score s, a sum of weights of hashed features; ordered
thresholds cut it: P(grade > j) = sigmoid(s - t_j). That gives the expected grade
and the tail probability by which documents are selected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import whole

BUCKETS = 1 << 18
# Labelled rows the model learns from: the bound of what reaches the driver.
TRAIN_ROWS = 6_000
MIN_DOCS = 3
_PUNCTUATION = b".,;:!?\"'()[]{}*#%&$|<>-"


class _Features(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word, 7) % BUCKETS
        self[word] = value
        return value


def _level(share: float) -> int:
    """A share as a coarse step."""
    return int(np.searchsorted([0.001, 0.01, 0.05, 0.1, 0.2, 0.4, 0.7], share))


def features(text: bytes, cache: _Features) -> np.ndarray:
    """Distinct words without marks, and a few traits of style."""
    if len(cache) > 400_000:
        cache.clear()
    words = text.split()
    n = max(len(words), 1)
    plain = {w.strip(_PUNCTUATION) for w in set(text.lower().split())}
    distinct = set(words)
    marked = sum(w[-1:] in b"*#%&$|<>" or w[-2:] == b"!!" for w in words)
    style = {
        b"marks": _level(marked / n),
        b"capitals": _level(sum(len(w) > 1 and w.isupper() for w in words) / n),
        b"again": _level(sum(a == b for a, b in zip(words, words[1:])) / n),
        b"distinct": int(8 * len(distinct) / n),
        b"length": int(np.log2(n)),
    }
    named = [b"\x00%s %d" % x for x in style.items()]
    return np.unique(np.fromiter(map(cache.__getitem__, [*plain, *named]), np.int64))


@dataclass(frozen=True)
class OrdinalModel:
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > j) for each threshold."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - scores[:, None], -40, 40)))


def fit(rows: list[np.ndarray], grades: np.ndarray, n_grades: int, rounds: int = 200, l2: float = 2e-3, rate: float = 0.05) -> OrdinalModel:
    """Maximum likelihood with a ridge, by Adam; features of fewer than MIN_DOCS rows get no weight."""
    if not len(rows):
        return OrdinalModel(np.zeros(BUCKETS, np.float32), np.linspace(-1, 1, n_grades - 1) if n_grades > 2 else np.zeros(n_grades - 1))
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    index = np.concatenate(rows)
    common = np.bincount(index, minlength=BUCKETS) >= MIN_DOCS
    owner, index = owner[common[index]], index[common[index]]
    used, at = np.unique(index, return_inverse=True)
    n, cuts = len(rows), n_grades - 1
    share = np.clip(np.array([(grades > j).mean() for j in range(cuts)]), 0.01, 0.99)
    start = -np.log(share / (1 - share))
    # free parameters: weights, first threshold, logarithms of the gaps
    free = np.r_[np.zeros(len(used)), start[0], np.log(np.maximum(np.diff(start), 0.1))]
    first, second = np.zeros_like(free), np.zeros_like(free)
    padded = np.arange(n)
    for step in range(1, rounds + 1):
        w, gaps = free[: len(used)], np.exp(free[len(used) + 1 :])
        t = free[len(used)] + np.r_[0.0, np.cumsum(gaps)]
        s = np.bincount(owner, weights=w[at], minlength=n)
        above = 1 / (1 + np.exp(np.clip(t[None, :] - s[:, None], -40, 40)))  # P(grade > j)
        edge = np.c_[np.ones(n), above, np.zeros(n)]
        slope = np.c_[np.zeros(n), above * (1 - above), np.zeros(n)]
        p = np.maximum(edge[padded, grades] - edge[padded, grades + 1], 1e-9)
        ds = (slope[padded, grades] - slope[padded, grades + 1]) / p / n
        dt = np.zeros(cuts + 2)
        np.add.at(dt, grades, -slope[padded, grades] / p / n)
        np.add.at(dt, grades + 1, slope[padded, grades + 1] / p / n)
        dt = dt[1:-1]
        gradient = np.r_[
            np.bincount(at, weights=ds[owner], minlength=len(used)) - l2 * w / 10,
            dt.sum(), [gaps[i] * dt[i + 1 :].sum() for i in range(cuts - 1)],
        ]
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        free = free + rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    weights = np.zeros(BUCKETS, np.float32)
    weights[used] = free[: len(used)]
    return OrdinalModel(weights, free[len(used)] + np.r_[0.0, np.cumsum(np.exp(free[len(used) + 1 :]))])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cache = _Features()
    for batch in batches:
        found = [features(t, cache).tolist() for t in batch["text"].to_pylist()]
        yield pa.RecordBatch.from_arrays([batch["grade"], pa.array(found, pa.list_(pa.int64()))], names=["grade", "features"])


def train(docs: DataFrame, ratings: DataFrame, n_grades: int, train_rows: int = TRAIN_ROWS) -> OrdinalModel:
    """Fit on at most ``train_rows`` rated documents, taken in the order of a hash of their ids.

    ``ratings`` has (doc_id, grade), grades 0 to ``n_grades`` - 1; a document with
    several has the lowest, null ids and grades are left out. Texts of a repeated id
    are all taken.
    """
    graded = ratings.where("doc_id IS NOT NULL AND grade BETWEEN 0 AND %d" % (n_grades - 1)).groupBy("doc_id").agg(F.min("grade").cast("int").alias("grade"))
    sample = graded.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows)
    # at most train_rows ids and grades
    texts = docs.select("doc_id", whole("text").cast("binary").alias("text")).join(F.broadcast(sample), "doc_id")
    rows = texts.select("grade", "text").mapInArrow(_extract, "grade int, features array<bigint>").limit(2 * train_rows).collect()
    rows = sorted(rows, key=lambda r: (r["grade"], r["features"]))
    return fit([np.array(r["features"], np.int64) for r in rows], np.array([r["grade"] for r in rows], np.int64), n_grades)


def _predict(model: OrdinalModel, keep_at: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _Features()
        for batch in batches:
            scores = np.array([model.weights[features(t, cache)].sum() for t in batch["text"].to_pylist()], np.float64)
            tails = model.tails(scores)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(tails.sum(axis=1)), pa.array(tails[:, 0]), pa.array(tails[:, -1]), pa.array(tails[:, -1] >= keep_at)],
                names=["doc_id", "expected_grade", "p_above_lowest", "p_highest", "kept"],
            )

    return run


def classify(docs: DataFrame, model: OrdinalModel, keep_at: float = 0.5) -> DataFrame:
    """``doc_id, expected_grade, p_above_lowest, p_highest, kept`` of every row of ``docs``.

    ``kept``: the highest grade has at least the probability ``keep_at``. Null texts
    are empty and judged by their style alone. Ids are carried as they are; other
    columns are not read; an empty table gives no row.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole("text").cast("binary").alias("text"))
    return texts.mapInArrow(_predict(model, keep_at), "doc_id bigint, expected_grade double, p_above_lowest double, p_highest double, kept boolean")


def graded(labels: DataFrame) -> DataFrame:
    """Ratings from labels: 0 not usable as text, 1 usable but toxic, 2 good."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when(F.col("quality").isNotNull(), 2)
    return labels.select("doc_id", grade.alias("grade"))


def classify_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return classify(docs, train(docs, graded(labels), 3))
