"""Pairs seen once stay in the Katz model with their Good-Turing discount."""

import collections
import math

import pytest
from pyspark.sql import functions as F

from tidemark.llm import katz


def test_pairs_seen_once_are_scored_by_their_own_mass(spark):
    texts = ["a b c d", "a b d c", "c a d b a b", "e f g h", "b c h g a b"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = {r["doc_id"]: r["score"] for r in katz.katz_scores(docs, held_out=F.lit(False)).collect()}
    tokens = [[*t.split(), "\n"] for t in texts]
    count = collections.Counter(w for t in tokens for w in t)
    pairs = collections.Counter(p for t in tokens for p in zip([None, *t], t))
    heads = collections.Counter(h for t in tokens for h in [None, *t[:-1]])
    of = lambda c: [sum(v == r for v in c.values()) for r in range(1, 7)]
    d2 = katz.discounts(of(pairs))
    assert 1 in pairs.values()
    for i, t in enumerate(tokens):
        score = 0.0
        for h, w in zip([None, *t], t):
            mass = {x: c * (d2[c] if c <= 5 else 1) for (g, x), c in pairs.items() if g == h}
            size = heads[h] if sum(mass.values()) < heads[h] else heads[h] + 1
            score += math.log10(mass[w] / size)
        assert rows[i] == pytest.approx(score)
