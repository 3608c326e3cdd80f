"""Near-dedup where many texts share a template: pairs grow with the members, and no link is lost."""

import numpy as np
import pytest

from tidemark.llm import shingles, simhash
from tidemark.llm.arrays import WordHashes


def template(n, seed):
    """Texts of 200 words that differ in 4, so that nearly all pairs lie under 0.8; every tenth has a close copy."""
    rng = np.random.default_rng(seed)
    base = rng.choice([f"t{i}" for i in range(4000)], 200)
    texts = []
    for d in range(n):
        text = base.copy()
        text[rng.choice(200, 4, replace=False)] = [f"own{d}_{i}" for i in range(4)]
        texts.append(text)
        if d % 10 == 0:
            copy = text.copy()
            copy[rng.integers(200)] = f"copy{d}"
            texts.append(copy)
    return [" ".join(t) for t in texts]


def sets_of(texts):
    cache = WordHashes()
    return [shingles.shingle_set(t.encode(), 5, cache) for t in texts]


def similar_pairs(texts):
    sets = [set(s.tolist()) for s in sets_of(texts)]
    return {
        (i, j) for i in range(len(sets)) for j in range(i + 1, len(sets))
        if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9
    }


@pytest.fixture
def counted(monkeypatch):
    """Pairs that were intersected as rows, and links that tiles returned."""
    seen = []
    for name in ("_verified", "_linked"):
        def count(rows, *others, of=getattr(shingles, name), name=name):
            found = of(rows, *others)
            seen.append(rows.count() if name == "_verified" else found.count())
            return found

        monkeypatch.setattr(shingles, name, count)
    return seen


def test_pairs_grow_with_the_members_and_links_are_found(spark, counted):
    for n in (100, 600):
        counted.clear()
        texts = template(n, n)
        kept = simhash.drop_near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))
        left = {r["doc_id"] for r in kept.collect()}
        root = list(range(len(texts)))
        for i, j in sorted(similar_pairs(texts)):
            a, b = root[i], root[j]
            root = [min(a, b) if r in (a, b) else r for r in root]
        want = {i for i, r in enumerate(root) if r == i}
        assert want <= left and len(left - want) <= 0.01 * len(texts)
        assert sum(counted) <= 2 * len(texts)


def test_intersections_and_links_of_tiles(monkeypatch):
    monkeypatch.setattr(shingles, "_SHARED", 7)
    rng = np.random.default_rng(53)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 50), dtype=np.uint64)) for _ in range(30)]
    both = shingles._in_both(sets[:12], sets[12:])
    assert both.tolist() == [[len(np.intersect1d(a, b)) for b in sets[12:]] for a in sets[:12]]
    assert shingles._in_both([], sets).shape == (0, 30) and (shingles._in_both(sets[:1], [sets[0] + np.uint64(100)]) == 0).all()
    assert shingles._forest(4, [(0, 1), (1, 0), (2, 3), (0, 2), (1, 3)]) == [(0, 1), (2, 3), (0, 2)]
    whole = np.arange(10, dtype=np.uint64)
    tile = {"vertex": np.array([5, 6, 5, 6, 1]), "label": np.array([5, 6, 5, 6, 1]), "size": np.array([10, 9, 10, 9, 3]), "is_other": np.array([1, 1, 0, 0, 0])}
    assert shingles.tile_links(tile, [whole, whole[:9], whole, whole[:9], whole[:3]], 0.8) == [(5, 6)]
    assert shingles.tile_links(tile, [whole, whole[:9], whole, whole[:9], whole[:3]], 0.95) == []


def test_tiles_of_any_size_give_the_same_components(spark, monkeypatch):
    texts = template(60, 5) + ["", "", "one", "one two three four five six " * 3]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    plain = sorted(r["doc_id"] for r in simhash.drop_near_duplicates(docs).collect())
    monkeypatch.setattr(shingles, "TILE", 9)
    assert sorted(r["doc_id"] for r in simhash.drop_near_duplicates(docs).collect()) == plain
