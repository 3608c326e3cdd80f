"""Ranked search against every score computed, and the bounds of its trees."""

import collections
import math
import re

import numpy as np
import pytest

from test_llm_operators import A_LONG, DOCS, clashing, lowered, odd_rows
from tidemark.llm import balltree

ITEMS = "item_id bigint, text string"


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered(text))


def brute(docs, items, k):
    found = [(doc_id, collections.Counter(terms(text))) for doc_id, text in docs if terms(text)]
    n_docs, all_terms = len(found), sum(sum(c.values()) for _, c in found)
    df = collections.Counter(t for _, c in found for t in c)
    rows = []
    for item_id, text in items:
        scores = []
        for doc_id, c in found:
            m = 50 + 50 * sum(c.values()) * n_docs // all_terms
            w = lambda t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
            score = sum(w(t) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in set(terms(text)) if t in c)
            if score > 0:
                scores.append((-score, doc_id is None, doc_id))
        rows += [(item_id, rank, doc_id, -score) for rank, (score, _, doc_id) in enumerate(sorted(scores)[:k], 1)]
    return sorted(map(repr, rows))


@pytest.mark.parametrize("settings", [{}, {"CELLS": 600, "LEAF": 3}])
def test_search_equals_every_score_computed(spark, tmp_path, monkeypatch, settings):
    for name, value in settings.items():
        monkeypatch.setattr(balltree, name, value)
    rng = np.random.default_rng(31)
    words = np.array([f"w{i}" for i in range(300)] + ["Été", "x-y", "日本", "a1B"])
    p = 1 / np.arange(1, len(words) + 1)
    text = lambda n: " ".join(rng.choice(words, n, p=p / p.sum()))
    docs = [(i, text(int(rng.integers(1, 80)))) for i in range(700)]
    # copies tie, repeated ids count by themselves, and null ids come last among equals
    docs += [(1000 + i, docs[5][1]) for i in range(80)] + [(5, docs[5][1]), (None, docs[5][1]), (2000, None), (2001, "?!"), (2002, A_LONG)]
    items = [(i, text(12)) for i in range(15)] + [(3, docs[5][1]), (3, docs[5][1]), (None, "w0 w1"), (90, None), (91, ""), (92, "nowhere"), (93, "W0, w0; W0")]
    index = balltree.index_documents(spark.createDataFrame(docs, "doc_id bigint, text string"), str(tmp_path / "index"), block_bytes=6_000)
    for k, block_terms in ((50, 100_000), (7, 40)):
        got = balltree.search(index, spark.createDataFrame(items, ITEMS), k, block_terms).collect()
        assert sorted(map(repr, map(tuple, got))) == brute(docs, items, k)


def test_bounds_hold_and_leave_subtrees_out():
    rng = np.random.default_rng(37)
    centres = rng.integers(0, 2, (8, 120)) * rng.integers(1, 10**6, (8, 120))
    x = (centres[rng.integers(0, 8, 1500)] * (rng.random((1500, 120)) < 0.9)).astype(np.float64)
    items = np.where(rng.random((120, 30)) < 0.2, rng.integers(1, 9000, (120, 30)), 0)
    tree = balltree.ball_tree(x)
    bound, scores = balltree.bounds(tree, items.astype(np.float64)), (x.astype(np.int64) @ items)[tree.order]
    for node, (a, b) in enumerate(zip(tree.start, tree.end)):
        assert (scores[a:b].max(axis=0) <= bound[node]).all()
    scored = 0
    for i in range(30):
        ranking, columns = balltree.Ranking(10), np.flatnonzero(items[:, i])
        scored += balltree.search_tree(tree, x[tree.order].astype(np.int64), tree.order, (columns, items[columns, i]), bound[:, i], ranking)
        want = sorted(((int(s), -int(d)) for s, d in zip(scores[:, i], tree.order)), reverse=True)[:10]
        assert sorted(ranking.best, reverse=True) == want
    assert scored < 0.5 * 30 * len(x)


def test_odd_tables(spark):
    odd = spark.createDataFrame(odd_rows(), DOCS)
    items = spark.createDataFrame([(1, "Nothing else"), (2, None)], ITEMS)
    rows = sorted(map(repr, balltree.ranked_search(odd, items).collect()))
    assert rows and sorted(map(repr, balltree.ranked_search(clashing(odd).selectExpr("*", "1 AS item", "'x' AS term"), items.selectExpr("*", "'x' AS item", "1 AS rank")).collect())) == rows
    assert balltree.ranked_search(odd.limit(0), items).collect() == [] == balltree.ranked_search(odd, items.limit(0)).collect()
