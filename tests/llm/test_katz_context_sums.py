"""What blocks and buckets of the Katz model tell each other about contexts is small, and backoff weights go where they are used."""

import collections
import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm import katz


def corpus(documents=150):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(400)]
    weights = [1 / (i + 1) for i in range(len(words))]
    return [" ".join(rng.choices(words, weights, k=rng.randrange(0, 40))) for _ in range(documents)]


def answers(spark, monkeypatch, folder, held_out):
    monkeypatch.setattr(katz, "scratch", lambda *_: str(folder))
    docs = spark.createDataFrame(list(enumerate(corpus())), "doc_id bigint, text string")
    rows = {r["doc_id"]: r for r in katz.katz_scores(docs, held_out, block_tokens=300).collect()}
    return rows, spark.read.parquet(f"{folder}/contexts").where("kind = 'answer'").collect()


def test_no_backoff_weight_is_sent_where_no_pair_is_left_to_backoff(spark, monkeypatch, tmp_path):
    _, sent = answers(spark, monkeypatch, tmp_path / "work", F.lit(False))
    assert len(sent) > 5
    assert sum(len(katz.unpacked(r["b"], "f8")) for r in sent) == 0


def test_sums_of_many_blocks_score_as_one_model(spark, monkeypatch, tmp_path):
    rows, sent = answers(spark, monkeypatch, tmp_path / "work", F.col("doc_id") % 3 == 1)
    weights = sum(len(katz.unpacked(r["b"], "f8")) for r in sent)
    assert 0 < weights < sum(len(katz.unpacked(r["a"], "u8")) for r in sent)
    texts = [[*t.split(), "\n"] for t in corpus()]
    train = [t for i, t in enumerate(texts) if i % 3 != 1]
    words = collections.Counter(w for t in train for w in t)
    pairs = collections.Counter(p for t in train for p in zip([None, *t], t))
    heads = collections.Counter(h for t in train for h in [None, *t[:-1]])
    d1, d2 = (katz.discounts([sum(v == r for v in c.values()) for r in range(1, 7)]) for c in (words, pairs))
    mass = lambda c, d: c * (d[c] if c <= 5 else 1)
    tokens = sum(words.values())
    kept = sum(mass(c, d1) for c in words.values())
    size = tokens if kept < tokens else tokens + 1
    unigram = lambda w: mass(words[w], d1) / size if w in words else 1 - kept / size
    after = collections.defaultdict(dict)
    for (h, w), c in pairs.items():
        after[h][w] = mass(c, d2)
    assert any(p not in pairs for t in texts for p in zip([None, *t], t))
    for i, t in enumerate(texts):
        score = 0.0
        for h, w in zip([None, *t], t):
            spent = sum(after[h].values()) if h in after else 0.0
            whole = 1 if h not in heads else heads[h] if spent < heads[h] else heads[h] + 1
            left = (1 - spent / whole) / (1 - sum(map(unigram, after[h]))) if h in heads else 1.0
            score += math.log10(after[h][w] / whole if w in after[h] else left * unigram(w))
        assert rows[i]["score"] == pytest.approx(score)
