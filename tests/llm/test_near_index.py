"""The near-dedup stage goes through the SimHash index: what it names is verified, and it names pairs by itself."""

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import simhash

SCHEMA = "doc_id bigint, text string"


def bits_apart(a, b):
    return int(np.bitwise_count(simhash.fingerprints(a.encode(), 3) ^ simhash.fingerprints(b.encode(), 3))[0])


def test_index_alone_finds_close_copies_and_the_exact_check_follows(spark, monkeypatch):
    def without_keys(*args, of=simhash.mark):
        return of(*args).withColumn("keys", F.array().cast("array<bigint>"))

    monkeypatch.setattr(simhash, "mark", without_keys)
    rng = np.random.default_rng(61)
    rows, apart = [], {}
    for d in range(40):
        text = rng.choice([f"v{i}" for i in range(3000)], 400)
        copy = text.copy()
        copy[-1 - d % 3] = "other"
        a, b = " ".join(text), " ".join(copy)
        rows += [(2 * d, a), (2 * d + 1, b)]
        apart[2 * d + 1] = bits_apart(a, b)
    # equal fingerprints, from shingles that come many times, of sets that have little in common
    for d in range(100, 104):
        rows.append((d, "x y z " * 100 + " ".join(f"own{d}_{i}" for i in range(60))))
    assert bits_apart(rows[-1][1], rows[-2][1]) == 0
    kept = {r["doc_id"] for r in simhash.drop_near_duplicates(spark.createDataFrame([*rows, (200, ""), (201, None)], SCHEMA)).collect()}
    assert sum(n <= 2 for n in apart.values()) > 20
    assert {b for b, n in apart.items() if n <= 2}.isdisjoint(kept) and {b for b, n in apart.items() if n > 2} <= kept
    assert {2 * d for d in range(40)} | {100, 101, 102, 103, 200} <= kept and 201 not in kept
