"""One key, reference or copy that fills a third of a table must not fill one task."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import (
    first_per_key,
    flag_eligible,
    keep_with_parents,
    not_staged,
    orphan_rows,
    orphan_values,
)


@pytest.fixture
def small_limits(spark):
    """The sizes at which Spark broadcasts and splits, scaled down to the test."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def links(spark, n=200_000):
    """A third of the rows are copies of key 7, another third point at item 42."""
    return spark.range(0, n, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("Id"),
        F.when(F.col("id") % 3 == 1, 42).otherwise(F.col("id")).alias("ItemId"),
        F.xxhash64("id").alias("Value"),
    )


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    rows = df.collect()
    return df._jdf.queryExecution().executedPlan().toString(), rows


@pytest.mark.parametrize("kind", ["semi", "anti", "flag"])
def test_a_hot_reference_is_split(spark, small_limits, kind):
    df = links(spark)
    parents = spark.range(0, 200_000, 2, 8).withColumnRenamed("id", "Id")
    if kind == "semi":
        joined = keep_with_parents(df, [("ItemId", parents, "Id")])
    elif kind == "anti":
        joined = orphan_rows(df, "ItemId", spark.range(1, 200_000, 2, 8), "id")
    else:
        joined = flag_eligible(df, [("ItemId", spark.range(1, 200_000, 2, 8).withColumnRenamed("id", "ItemId"))])
        joined = joined.where("_eligible").drop("_eligible")
    plan, rows = final_plan(joined)
    assert "skew=true" in plan
    expected = sum(1 for i in range(200_000) if i % 3 == 1 or i % 2 == 0)
    assert len(rows) == expected


def shuffled_rows(df):
    """Rows written by the exchanges of a plan that has run, largest first."""
    df.collect()
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        else:
            if kind == "ShuffleExchangeExec":
                found.append(node.metrics().apply("shuffleRecordsWritten").value())
            children = node.children()
            todo += [children.apply(i) for i in range(children.size())]
    return sorted(found, reverse=True)


def test_a_hot_key_is_reduced_before_the_shuffle(spark, small_limits):
    # 66,667 copies of key 7 leave at most one row per input task.
    n = 200_000
    unique = n - len(range(0, n, 3))
    assert unique <= max(shuffled_rows(first_per_key(links(spark), "Id"))) <= unique + 8


def test_hot_references_and_staged_keys_are_reduced_before_the_shuffle(spark, small_limits):
    n = 200_000
    distinct = n - len(range(1, n, 3))
    parents = spark.range(0, 10, 1, 1)
    sizes = shuffled_rows(orphan_values(links(spark), "ItemId", parents, "id"))
    assert distinct - 10 <= sizes[0] <= distinct + 8
    target = spark.range(0, 1000, 1, 2)
    sizes = shuffled_rows(not_staged(target, "id", links(spark), "Id"))
    assert sizes[0] <= n - len(range(0, n, 3)) + 8
