"""The near-dedup stage against all pairs: every pair from the similarity on is found, none below."""

import numpy as np

from tidemark.llm import simhash

SCHEMA = "doc_id bigint, text string"


def shingles(text):
    w = text.split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def kept(spark, rows):
    return {r["text"] for r in simhash.drop_near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}


def test_pairs_link_from_the_similarity_on_and_not_below(spark):
    rng = np.random.default_rng(23)
    rows, similar = [], {}
    for d in range(600):
        text = rng.choice([f"v{i}" for i in range(3000)], 204)
        copy = text.copy()
        # 15 to 26 of 200 shingles change: similarities just above and below 0.8, which is 22
        copy[10 + 20 * np.arange(3)] = "other"
        copy[150 : 150 + d % 8] = "other"
        a, b = " ".join(text), " ".join(copy)
        rows += [(2 * d, a), (2 * d + 1, b)]
        similar[b] = len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b))
    assert sum(0.8 <= j < 0.83 for j in similar.values()) > 200 < sum(0.76 < j < 0.8 for j in similar.values())
    left = kept(spark, rows)
    assert all(text in left for _, text in rows[::2])
    assert {b for b, j in similar.items() if j < 0.8} <= left
    above = [b not in left for b, j in similar.items() if j >= 0.8]
    assert np.mean(above) >= 0.99


def test_linked_rows_with_null_ids_leave_one_and_others_stay(spark):
    rng = np.random.default_rng(29)
    text = rng.choice([f"v{i}" for i in range(3000)], 300)
    other = rng.choice([f"v{i}" for i in range(3000)], 300)
    copies = []
    for i in range(6):
        copy = text.copy()
        copy[20 * i : 20 * i + 2] = "other"
        copies.append(" ".join(copy))
    left = kept(spark, [(None, t) for t in [*copies, " ".join(other)]])
    assert " ".join(other) in left and len(left) == 2
