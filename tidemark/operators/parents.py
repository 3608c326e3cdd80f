"""Rows whose parents exist."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ELIGIBLE = "_eligible"


def keep_with_parents(
    df: DataFrame, parents: Sequence[tuple[str, DataFrame, str]]
) -> DataFrame:
    """Rows for which every ``(column, parent, parent_key)`` finds a parent."""
    for column, parent, parent_key in parents:
        keys = parent.select(F.col(parent_key).alias("_parent_key"))
        df = df.join(keys, F.col(column) == F.col("_parent_key"), "left_semi")
    return df


def orphan_rows(df: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose parent is missing; a NULL reference is an orphan."""
    keys = parent.select(F.col(parent_key).alias("_parent_key"))
    return df.join(keys, F.col(column) == F.col("_parent_key"), "left_anti")


def orphan_values(df: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """The distinct references that have no parent.

    Only distinct reference values are shuffled, reduced per task first, so
    the rows themselves stay where they are and a hot reference costs nothing.
    """
    return orphan_rows(df.select(column).distinct(), column, parent, parent_key)


def flag_eligible(
    df: DataFrame, orphans: Sequence[tuple[str, DataFrame]], first: str | None = None
) -> DataFrame:
    """Add ``_eligible``: false where any reference is among the orphan values.

    ``first``, if given, names a column for the place in ``orphans`` of the first such
    reference, NULL if there is none.

    Orphan values are few where data is sound, so Spark broadcasts them if
    their files are small and falls back to a shuffle join if they are not.
    """
    flags = []
    for position, (column, values) in enumerate(orphans):
        name = f"_orphan_{position}"
        marked = values.select(F.col(column).alias(f"{name}_value"), F.lit(True).alias(name))
        df = df.join(marked, F.col(column).eqNullSafe(F.col(f"{name}_value")), "left").drop(
            f"{name}_value"
        )
        flags.append(name)
    eligible = reduce(lambda a, b: a & b, [F.col(f).isNull() for f in flags], F.lit(True))
    if first is not None:
        found = [F.when(F.col(f), F.lit(i)) for i, f in enumerate(flags)]
        df = df.withColumn(first, F.coalesce(*found, F.lit(None).cast("int")))
    return df.withColumn(ELIGIBLE, eligible).drop(*flags)
