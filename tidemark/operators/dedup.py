"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.errors import DuplicateKeyError

_RANK = "_duplicate_rank"


def _columns(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _ranked(df: DataFrame, key: str | Sequence[str], order_by: Sequence[Column] | None) -> DataFrame:
    keys = _columns(key)
    order = list(order_by or []) or [
        F.col(name).asc_nulls_last() for name in df.columns if name not in keys
    ] or [F.col(name) for name in keys]
    return df.withColumn(_RANK, F.row_number().over(W.partitionBy(*keys).orderBy(*order)))


def first_per_key(
    df: DataFrame, key: str | Sequence[str], order_by: Sequence[Column] | None = None
) -> DataFrame:
    """Keep the first row of every key, by default in order of all other columns.

    The rank filter lets Spark drop later duplicates before the shuffle, so a
    key that fills a third of the table sends one row per input task.
    """
    return _ranked(df, key, order_by).where(F.col(_RANK) == 1).drop(_RANK)


def first_and_count(
    df: DataFrame, key: str, values: Sequence[str], extra_rows: str
) -> DataFrame:
    """The first row of every key, in order of ``values``, and how many rows the key has beyond it.

    Columns that are not among the values must follow from them. Rows are reduced per task
    before the shuffle, so a key that fills a third of the table sends one row per input task.
    """
    others = [name for name in df.columns if name != key and name not in values]
    # a struct orders NULL first, so each value comes after whether it is one
    parts = [c.alias(f"_{i}_{j}") for i, v in enumerate(values) for j, c in enumerate((F.isnull(v), F.col(v)))]
    parts += [F.col(name).alias(f"_other_{i}") for i, name in enumerate(others)]
    first = F.min(F.struct(*(parts or [F.lit(True)]))).alias("_first")
    return df.groupBy(key).agg(first, (F.count(F.lit(1)) - 1).alias(extra_rows)).select(
        key,
        *[F.col(f"_first._{i}_1").alias(v) for i, v in enumerate(values)],
        *[F.col(f"_first._other_{i}").alias(name) for i, name in enumerate(others)],
        extra_rows,
    )


def duplicate_counts(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with the number of rows beyond the first."""
    keys = _columns(key)
    return (
        df.groupBy(*keys)
        .agg((F.count(F.lit(1)) - 1).alias("extra_rows"))
        .where(F.col("extra_rows") > 0)
    )


def require_unique(df: DataFrame, key: str, label: str) -> DataFrame:
    """Fail if a key occurs twice, as a primary key would."""
    twice = duplicate_counts(df, key).limit(1).collect()
    if twice:
        raise DuplicateKeyError(f"{label} holds the key {twice[0][key]} more than once.")
    return df
