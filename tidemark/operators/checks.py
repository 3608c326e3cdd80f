"""Checks on the loaded tables: row counts, orphans, high-water marks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.parents import orphan_values
from tidemark.spec import TableSpec


def high_water_mark(key: str) -> Column:
    """Highest key, or 0 for an empty table."""
    return F.coalesce(F.max(key), F.lit(0))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return reduce(
        DataFrame.unionByName,
        [
            df.agg(F.count(F.lit(1)).alias("Rows")).select(F.lit(name).alias("TableName"), "Rows")
            for name, df in tables.items()
        ],
    )


def orphan_report(specs: Sequence[TableSpec], tables: Mapping[str, DataFrame]) -> DataFrame:
    """Every row that points at a missing parent; empty when the load is sound.

    Distinct references are compared with the keys, and the few that miss are
    joined back to the rows, which need not be shuffled for it.
    """
    keys = {s.name: s.key for s in specs}

    def orphans(spec: TableSpec, column: str, parent: str) -> DataFrame:
        rows = tables[spec.name]
        missing = orphan_values(rows, column, tables[parent], keys[parent]).select(F.col(column).alias("_missing"))
        return rows.join(missing, F.col(column).eqNullSafe(F.col("_missing")), "left_semi")

    parts = [
        orphans(spec, parent.column, parent.table).select(
            F.lit(f"{spec.name} -> {parent.table}").alias("Relationship"),
            F.col(spec.key).cast("bigint").alias("Id"),
            F.col(parent.column).cast("bigint").alias("ParentId"),
        )
        for spec in specs
        for parent in spec.parents
    ]
    return reduce(DataFrame.unionByName, parts)


def high_water_check(table: DataFrame, key: str, current: Column) -> DataFrame:
    """The stored mark beside the highest key; ``Ok`` when the mark is not below it."""
    highest = F.max(key).cast("bigint")
    return table.agg(
        current.cast("bigint").alias("CurrentIdentity"),
        highest.alias("MaxId"),
        (current >= F.coalesce(highest, F.lit(0))).alias("Ok"),
    )
