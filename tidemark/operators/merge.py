"""Upsert as one full outer join on the key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.parents import ELIGIBLE

ACTION = "_action"

INSERT = "INSERT"
UPDATE = "UPDATE"
UNCHANGED = "UNCHANGED"
KEEP = "KEEP"
REJECT = "REJECT"
DELETE = "DELETE"


def differs(
    values: Sequence[str], left: str, right: str, collations: Mapping[str, str] | None = None
) -> Column:
    """NULL-safe "any value differs" between two prefixed sets of columns.

    Text compares by bytes unless a collation is named for the column.
    """

    def side(prefix: str, name: str) -> Column:
        column = F.col(prefix + name)
        collation = (collations or {}).get(name)
        return F.collate(column, collation) if collation else column

    equal = [side(left, name).eqNullSafe(side(right, name)) for name in values]
    return ~reduce(lambda a, b: a & b, equal) if equal else F.lit(False)


def classify(
    source: DataFrame,
    target: DataFrame,
    key: str,
    values: Sequence[str],
    *,
    prune: bool = False,
    collations: Mapping[str, str] | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Pair source and target rows and name what happens to each.

    ``source`` holds one row per key; if it has an ``_eligible`` flag, rows
    without it are not merged. Such a row still counts as present at the
    source, so pruning leaves its target row alone. The result has one row per
    key with the values after the merge:

    INSERT, UPDATE, UNCHANGED -- eligible source rows,
    REJECT -- a source row that is not eligible and has no target row,
    DELETE -- a target row without a source row, if ``prune``,
    KEEP -- every other target row.

    The columns to ``carry`` are the source's, NULL where it has no row.
    """
    eligible = F.col(ELIGIBLE) if ELIGIBLE in source.columns else F.lit(True)
    left = source.select(
        F.col(key).alias("_s_key"),
        *[F.col(v).alias(f"_s_{v}") for v in values],
        eligible.alias("_s_eligible"),
        *[F.col(name).alias(f"_c_{name}") for name in carry],
    )
    right = target.select(
        F.col(key).alias("_t_key"), *[F.col(v).alias(f"_t_{v}") for v in values]
    )
    in_source = F.col("_s_key").isNotNull()
    in_target = F.col("_t_key").isNotNull()
    merged = in_source & F.col("_s_eligible")
    action = (
        F.when(merged & ~in_target, INSERT)
        .when(merged & differs(values, "_s_", "_t_", collations), UPDATE)
        .when(merged, UNCHANGED)
        .when(in_source & ~in_target, REJECT)
        .when(~in_source, DELETE if prune else KEEP)
        .otherwise(KEEP)
    )
    taken = F.col(ACTION).isin(INSERT, UPDATE)
    return (
        left.join(right, F.col("_s_key") == F.col("_t_key"), "full_outer")
        .withColumn(ACTION, action)
        .select(
            ACTION,
            F.coalesce("_s_key", "_t_key").alias(key),
            *[F.when(taken, F.col(f"_s_{v}")).otherwise(F.col(f"_t_{v}")).alias(v) for v in values],
            *[F.col(f"_c_{name}").alias(name) for name in carry],
        )
    )


def changes(
    source: DataFrame,
    target: DataFrame,
    key: str,
    values: Sequence[str],
    collations: Mapping[str, str] | None = None,
) -> DataFrame:
    """Only the rows to insert or update, for a target that is kept elsewhere."""
    right = target.select(
        F.col(key).alias("_t_key"), *[F.col(v).alias(f"_t_{v}") for v in values]
    )
    left = source.select(F.col(key).alias("_s_key"), *[F.col(v).alias(f"_s_{v}") for v in values])
    action = F.when(F.col("_t_key").isNull(), INSERT).when(
        differs(values, "_s_", "_t_", collations), UPDATE
    )
    return (
        left.join(right, F.col("_s_key") == F.col("_t_key"), "left")
        .withColumn(ACTION, action)
        .where(F.col(ACTION).isNotNull())
        .select(ACTION, F.col("_s_key").alias(key), *[F.col(f"_s_{v}").alias(v) for v in values])
    )


def stays() -> Column:
    """Whether a classified row is in the target once the actions are applied."""
    return ~F.col(ACTION).isin(REJECT, DELETE)


def after_merge(classified: DataFrame) -> DataFrame:
    """The rows of the target once the actions are applied."""
    return classified.where(stays()).drop(ACTION)


def action_counters() -> list[Column]:
    """One count per action, over classified rows."""
    return [
        F.count_if(F.col(ACTION) == name).alias(name.lower())
        for name in (INSERT, UPDATE, UNCHANGED, KEEP, REJECT, DELETE)
    ]


def upsert(
    source: DataFrame,
    target: DataFrame,
    key: str,
    values: Sequence[str],
    *,
    prune: bool = False,
    collations: Mapping[str, str] | None = None,
) -> DataFrame:
    return after_merge(
        classify(source, target, key, values, prune=prune, collations=collations)
    )
