import random

import pytest
from pyspark.sql import functions as F

from tidemark.errors import DuplicateKeyError
from tidemark.operators import (
    action_counters,
    after_merge,
    changes,
    classify,
    delete_report,
    duplicate_counts,
    first_per_key,
    flag_eligible,
    high_water_check,
    high_water_mark,
    keep_with_parents,
    not_staged,
    orphan_report,
    orphan_rows,
    orphan_values,
    require_unique,
    row_counts,
    staged_only,
    upsert,
)
from tidemark.plans.sync import eligible_source
from tidemark.plans.tables import ITEM, ITEM_TABLES

ITEMS = "Id int, CategoryId int, Name string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def items(spark, *values):
    return spark.createDataFrame(list(values), ITEMS)


def test_first_per_key_is_deterministic(spark):
    values = [(1, 5, "b"), (1, 5, "a"), (1, 4, None), (2, 1, None), (2, 1, "z"), (3, 1, "only")]
    expected = [(1, 4, None), (2, 1, "z"), (3, 1, "only")]
    for seed in range(3):
        random.Random(seed).shuffle(values)
        assert rows(first_per_key(items(spark, *values).repartition(3), "Id")) == sorted(expected, key=repr)
    latest = first_per_key(items(spark, *values), "Id", [F.col("Name").desc_nulls_last()])
    assert rows(latest)[0] == (1, 5, "b")
    assert rows(first_per_key(items(spark, *values).select("Id"), "Id")) == [(1,), (2,), (3,)]


def test_duplicates_are_reduced_before_the_shuffle(spark):
    plan = first_per_key(items(spark, (1, 1, "a")), "Id")._jdf.queryExecution().executedPlan().toString()
    before = plan[plan.index("Exchange hashpartitioning(Id"):]
    assert "WindowGroupLimit" in before and "Partial" in before


def test_duplicate_counts_and_unique(spark):
    df = items(spark, (1, 1, "a"), (1, 2, "b"), (1, 3, "c"), (2, 1, "d"))
    assert rows(duplicate_counts(df, "Id")) == [(1, 2)]
    with pytest.raises(DuplicateKeyError, match="Things holds the key 1"):
        require_unique(df, "Id", "Things")
    assert require_unique(df.where("Id = 2"), "Id", "Things").count() == 1


def test_parents(spark):
    df = items(spark, (1, 10, "a"), (2, 11, "b"), (3, None, "c"), (4, 10, "d"))
    parent = spark.createDataFrame([(10,), (12,), (None,)], "Id int")
    assert [r[0] for r in rows(keep_with_parents(df, [("CategoryId", parent, "Id")]))] == [1, 4]
    assert [r[0] for r in rows(orphan_rows(df, "CategoryId", parent, "Id"))] == [2, 3]
    orphans = orphan_values(df, "CategoryId", parent, "Id")
    assert rows(orphans) == [(11,), (None,)]
    flagged = flag_eligible(df, [("CategoryId", orphans)])
    assert [(r["Id"], r["_eligible"]) for r in flagged.orderBy("Id").collect()] == [
        (1, True), (2, False), (3, False), (4, True),
    ]
    assert flag_eligible(df, []).where("_eligible").count() == 4


def test_survivor_is_chosen_before_parents(spark):
    # The first duplicate of key 1 is an orphan, the second is not: the key is lost.
    df = items(spark, (1, 5, "a"), (1, 10, "b"), (2, 10, "c"))
    parent = spark.createDataFrame([(10,)], "Id int")
    source = eligible_source(df, ITEM, [("CategoryId", orphan_values(df, "CategoryId", parent, "Id"))])
    assert rows(source.where("_eligible").drop("_eligible")) == [(2, 10, "c")]
    assert rows(keep_with_parents(first_per_key(df, "Id"), [("CategoryId", parent, "Id")])) == [(2, 10, "c")]


def test_actions(spark):
    source = items(spark, (1, 1, "new"), (2, 1, "changed"), (3, 1, "same"), (5, 1, None), (6, 1, "v"), (7, 1, None))
    target = items(spark, (2, 1, "old"), (3, 1, "same"), (4, 1, "kept"), (5, 1, None), (6, 1, None), (7, 1, "v"))
    acted = {r["Id"]: (r["_action"], r["Name"]) for r in classify(source, target, "Id", ["CategoryId", "Name"]).collect()}
    assert acted == {
        1: ("INSERT", "new"), 2: ("UPDATE", "changed"), 3: ("UNCHANGED", "same"), 4: ("KEEP", "kept"),
        5: ("UNCHANGED", None), 6: ("UPDATE", "v"), 7: ("UPDATE", None),
    }
    merged = upsert(source, target, "Id", ["CategoryId", "Name"])
    again = classify(source, merged, "Id", ["CategoryId", "Name"]).agg(*action_counters()).first()
    assert (again["insert"], again["update"], again["unchanged"], again["keep"]) == (0, 0, 6, 1)
    changed = changes(source, target, "Id", ["CategoryId", "Name"])
    assert {(r["_action"], r["Id"]) for r in changed.collect()} == {
        ("INSERT", 1), ("UPDATE", 2), ("UPDATE", 6), ("UPDATE", 7),
    }
    pruned = upsert(source, target, "Id", ["CategoryId", "Name"], prune=True)
    assert [r[0] for r in rows(pruned)] == [1, 2, 3, 5, 6, 7]


def test_ineligible_rows_are_neither_merged_nor_pruned(spark):
    source = items(spark, (1, 9, "orphan, new"), (2, 9, "orphan, known"), (3, 1, "fine")).withColumn(
        "_eligible", F.col("CategoryId") != 9
    )
    target = items(spark, (2, 1, "known"), (4, 1, "gone"))
    acted = {r["Id"]: (r["_action"], r["Name"]) for r in classify(source, target, "Id", ["CategoryId", "Name"], prune=True).collect()}
    assert acted == {
        1: ("REJECT", None), 2: ("KEEP", "known"), 3: ("INSERT", "fine"), 4: ("DELETE", "gone"),
    }


def test_collation_decides_equality_per_column(spark):
    source, target = items(spark, (1, 1, "ABC")), items(spark, (1, 1, "abc"))
    values = ["CategoryId", "Name"]
    assert classify(source, target, "Id", values).first()["_action"] == "UPDATE"
    same = classify(source, target, "Id", values, collations={"Name": "UTF8_LCASE"}).first()
    assert (same["_action"], same["Name"]) == ("UNCHANGED", "abc")


def test_key_only_tables_merge(spark):
    acted = classify(spark.range(3), spark.range(1, 5), "id", [])
    assert rows(acted.groupBy("_action").count()) == [("INSERT", 1), ("KEEP", 2), ("UNCHANGED", 2)]


@pytest.mark.parametrize("seed", range(4))
def test_merge_against_brute_force(spark, seed):
    rng = random.Random(seed)

    def some(n, keys):
        return [(rng.randint(1, keys), rng.randint(1, 6), rng.choice([None, "a", "b", "c"])) for _ in range(n)]

    staged, parents = some(60, 30), {1, 2, 4}
    target = {k: (c, n) for k, c, n in some(40, 40)}
    prune = seed % 2 == 0

    def order(value):
        return (value is None, value or "")

    first = {}
    for key, category, name in sorted(staged, key=lambda r: (r[0], r[1], order(r[2]))):
        first.setdefault(key, (category, name))
    eligible = {k: v for k, v in first.items() if v[0] in parents}
    expected = {k: v for k, v in target.items() if not prune or k in first} | eligible

    df = items(spark, *staged).repartition(rng.randint(1, 5))
    parent = spark.createDataFrame([(p,) for p in parents], "Id int")
    source = eligible_source(df, ITEM, [("CategoryId", orphan_values(df, "CategoryId", parent, "Id"))])
    old = items(spark, *[(k, *v) for k, v in target.items()])
    acted = classify(source, old, "Id", ["CategoryId", "Name"], prune=prune)
    assert {r["Id"]: (r["CategoryId"], r["Name"]) for r in after_merge(acted).collect()} == expected
    counts = acted.agg(*action_counters()).first()
    assert counts["insert"] == len(eligible.keys() - target.keys())
    assert counts["update"] == sum(1 for k, v in eligible.items() if k in target and target[k] != v)
    assert counts["insert"] + counts["update"] + counts["unchanged"] == len(eligible)
    assert counts["delete"] == (len(target.keys() - first.keys()) if prune else 0)


def test_prune_operators(spark):
    target = items(spark, (1, 1, "a"), (2, 1, "b"), (3, 1, "c"))
    staged = items(spark, (1, 1, "a"), (1, 1, "dup"), (3, 9, "orphan"))
    assert [r[0] for r in rows(staged_only(target, "Id", staged, "Id"))] == [1, 3]
    assert [r[0] for r in rows(not_staged(target, "Id", staged, "Id"))] == [2]


def test_delete_report(spark):
    target = items(spark, *[(i, 1, "n") for i in range(1, 11)])
    children = spark.createDataFrame([(i, i % 5 + 1, 1) for i in range(20)], "ItemBlobId int, ItemId int, BlobId int")
    ids = spark.createDataFrame([(1,), (2,), (99,)], "Id int")
    assert delete_report(target, "Id", children, "ItemId", ids).first().asDict() == {
        "ItemBlobRowsDeleted": 8, "ItemRowsDeleted": 2, "ItemsRemaining": 8, "StillPresent": 0,
    }
    nothing = delete_report(target.where("Id < 0"), "Id", children.where("ItemId < 0"), "ItemId", ids)
    assert set(nothing.first()) == {0}


def test_checks(spark):
    tables = {
        "ItemCategory": spark.createDataFrame([(1, "c")], "Id int, Descr string"),
        "Blob": spark.createDataFrame([(1, "b")], "BlobId int, Name string"),
        "Item": items(spark, (1, 1, "a"), (2, 7, "orphan")),
        "ItemBlob": spark.createDataFrame([(1, 1, 1), (2, 8, 1), (3, 1, 9)], "ItemBlobId int, ItemId int, BlobId int"),
    }
    assert rows(orphan_report(ITEM_TABLES, tables)) == [
        ("Item -> ItemCategory", 2, 7), ("ItemBlob -> Blob", 3, 9), ("ItemBlob -> Item", 2, 8),
    ]
    assert rows(row_counts(tables)) == [("Blob", 1), ("Item", 2), ("ItemBlob", 3), ("ItemCategory", 1)]
    assert tables["Item"].agg(high_water_mark("Id")).first()[0] == 2
    assert tables["Item"].where("Id < 0").agg(high_water_mark("Id")).first()[0] == 0
    assert tuple(high_water_check(tables["Item"], "Id", F.lit(1)).first()) == (1, 2, False)
    assert tuple(high_water_check(tables["Item"], "Id", F.lit(2)).first()) == (2, 2, True)
    assert tuple(high_water_check(tables["Item"].where("Id < 0"), "Id", F.lit(0)).first()) == (0, None, True)
