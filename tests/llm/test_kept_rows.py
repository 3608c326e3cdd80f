"""Stages keep every column whatever its name, rows without ids, and all places of an item."""

import collections

import numpy as np
import pytest

import corpus_pipeline
from tidemark.llm import leaks, lines, mixing, quality, simhash

NAMES = ["_stratum", "_source", "_row_1", "_row_2", "_drop", "_text_1", "_row", "_text", "row", "_docs", "h1", "_passes", "_share", "key", "vertex", "size_"]
PROSE = "the small boat left the harbour early and came back late with a good catch of fish for the market"
ITEMS = "item_id bigint, text string"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, f"{PROSE} on day {i}. " * 3, "en", f"s{i % 2}", 1) for i in range(8)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")


def test_columns_of_any_name_pass_through(spark, docs):
    named = docs.selectExpr("*", *[f"concat('{n}', doc_id) AS `{n}`" for n in NAMES])
    items = spark.createDataFrame([(1, "nowhere to be found in any of these")], ITEMS)
    stages = {
        "quality": quality.keep_good, "lines": lines.dedup_lines, "near": simhash.drop_near_duplicates,
        "leaks": lambda d: leaks.drop_leaked(d, items), "mix": mixing.mix,
    }
    for name, stage in stages.items():
        for r in stage(named).collect():
            assert all(r[n] == f"{n}{r['doc_id']}" for n in NAMES), name


def test_mix_deals_rows_without_ids_over_all_strata(spark, monkeypatch):
    monkeypatch.setattr(mixing, "STRATUM_ROWS", 500)
    rows = [(None if i % 3 == 0 else i, f"word{i} " * (1 + i % 5), "a") for i in range(6000)] + [(9000 + i, "w", "b") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    done = mixing.mix(docs).collect()
    taken = collections.Counter()
    for r in done:
        taken[r["source"]] += r["taken"]
    target = {r["source"]: r["target"] for r in done}
    assert all(abs(taken[s] - target[s]) <= 100 for s in target)
    # each stratum is a window of its own: rows without ids fall into all of them
    plan = mixing.mix(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "text" in plan.split("_stratum")[0]


def test_every_place_and_short_items(spark):
    item = "one two three four five six seven eight"
    texts = [f"{item} {item}", f"x {item} y {item.replace('four', 'vier')} {item} z", "alpha Beta gamma beta gamma", "beta", "beta gam ma", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    items = spark.createDataFrame([(1, item), (2, "beta gamma"), (3, "beta"), (4, ""), (5, None)], ITEMS)
    got = sorted((r["doc_id"], r["item_id"], r["start"], r["stop"], r["edits"]) for r in leaks.find_leaks(docs, items).collect())
    assert got == [
        (0, 1, 0, 8, 0), (0, 1, 8, 16, 0), (1, 1, 1, 9, 0), (1, 1, 10, 18, 1), (1, 1, 18, 26, 0),
        (2, 2, 1, 3, 0), (2, 2, 3, 5, 0), (2, 3, 1, 2, 0), (2, 3, 3, 4, 0), (3, 3, 0, 1, 0), (4, 3, 0, 1, 0),
    ]
    kept = leaks.drop_leaked(docs, items.where("item_id IN (2, 4, 5)")).collect()
    assert sorted(r["doc_id"] for r in kept) == [0, 1, 3, 4, 5]


def test_pipeline_runs_its_stages_in_order(spark, tmp_path):
    """Each planted row goes in the stage that is to remove it, and clean rows reach the mixture."""
    def prose(i):
        rng = np.random.default_rng(i)
        words = ["the", "and", "of", "to", "that", "with", "river", "walked", "morning", "stone", "green", "silent", "window", "letter", "harbour", "answer", "slowly", "garden", "winter", "music"]
        return " ".join("The " + " ".join([f"{rng.choice(words)}{'' if rng.random() < 0.4 else rng.choice(words)}" for _ in range(14)]) + "." for _ in range(8))

    clean = [(i, prose(i), "en", f"s{i % 2}") for i in range(12)]
    copy = (20, prose(3).replace("The ", "A ", 1), "en", "s0")
    leaked = (21, prose(40) + " which of these answers is the right one for a question that was asked in secret", "en", "s1")
    junk = (22, "# # $ % & | <", "en", "s1")
    folder = str(tmp_path)
    schema = "doc_id bigint, text string, lang string, source string"
    spark.createDataFrame([*clean, copy, leaked, junk], schema).selectExpr("*", "cast(length(text) AS bigint) AS n_chars").write.parquet(f"{folder}/documents.parquet")
    item = "which of these answers is the right one for a question that was asked in secret"
    spark.createDataFrame([(1, item)], ITEMS).write.parquet(f"{folder}/benchmark.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    left = [{r["doc_id"] for r in docs.collect()}]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
        left.append({r["doc_id"] for r in docs.collect()})
    gone = [a - b for a, b in zip(left, left[1:])]
    assert gone[0] == {22} and gone[1] == set() and gone[2] == {20} and gone[3] == {21}
    result = corpus_pipeline.run(spark, folder)
    assert {r["doc_id"] for r in result.collect()} == left[-1] and result.where("copies < 1").count() == 0
    assert {"doc_id", "text", "lang", "source", "n_chars", "copies"} <= set(result.columns)
