"""Deleting target rows: those missing from the staged set, or those listed.

A staged set may hold a key many times, so its keys are made distinct, per
task first, on the way into the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def staged_only(target: DataFrame, column: str, staged: DataFrame, staged_key: str) -> DataFrame:
    """Target rows whose ``column`` occurs among the staged keys."""
    keys = staged.select(F.col(staged_key).alias("_staged_key")).distinct()
    return target.join(keys, F.col(column) == F.col("_staged_key"), "left_semi")


def not_staged(target: DataFrame, column: str, staged: DataFrame, staged_key: str) -> DataFrame:
    """Target rows whose ``column`` does not occur among the staged keys."""
    keys = staged.select(F.col(staged_key).alias("_staged_key")).distinct()
    return target.join(keys, F.col(column) == F.col("_staged_key"), "left_anti")


def listed(target: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """Target rows whose ``column`` is among the ids."""
    keys = ids.select(F.col(ids.columns[0]).alias("_listed_id"))
    return target.join(keys, F.col(column) == F.col("_listed_id"), "left_semi")


def not_listed(target: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    keys = ids.select(F.col(ids.columns[0]).alias("_listed_id"))
    return target.join(keys, F.col(column) == F.col("_listed_id"), "left_anti")


def delete_report(
    items: DataFrame, item_key: str, children: DataFrame, child_column: str, ids: DataFrame
) -> DataFrame:
    """One row: children and items that a delete by list removes, and what is left.

    ``ids`` holds each id once. Each table is scanned once, apart from the
    last count, which is a check of its own on the surviving rows.
    """
    keys = ids.select(F.col(ids.columns[0]).alias("_listed_id"))
    gone = F.col("_listed_id").isNotNull()
    item_counts = items.join(keys, F.col(item_key) == F.col("_listed_id"), "left").agg(
        F.count_if(gone).alias("ItemRowsDeleted"), F.count_if(~gone).alias("ItemsRemaining")
    )
    child_counts = listed(children, child_column, ids).agg(
        F.count(F.lit(1)).alias("ItemBlobRowsDeleted")
    )
    still = listed(not_listed(items, item_key, ids), item_key, ids).agg(
        F.count(F.lit(1)).alias("StillPresent")
    )
    names = ["ItemBlobRowsDeleted", "ItemRowsDeleted", "ItemsRemaining", "StillPresent"]
    parts = child_counts.unionByName(item_counts, allowMissingColumns=True).unionByName(
        still, allowMissingColumns=True
    )
    return parts.agg(*[F.max(name).alias(name) for name in names])
