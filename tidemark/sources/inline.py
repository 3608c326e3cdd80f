"""Rows given in the program, with the checks of a keyed table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.errors import DuplicateKeyError, MappingError
from tidemark.spec import TableSpec


def _check_keys(keys: list, label: str) -> None:
    if any(k is None for k in keys):
        raise MappingError(f"{label} holds a row without a key.")
    if len(set(keys)) != len(keys):
        raise DuplicateKeyError(f"{label} holds a key more than once.")


def inline_rows(spark: SparkSession, spec: TableSpec, rows: Iterable[tuple]) -> DataFrame:
    """Typed rows for a table; keys must be present and unique."""
    rows = list(rows)
    position = spec.column_names.index(spec.key)
    _check_keys([row[position] for row in rows], spec.name)
    return spark.createDataFrame(rows, spec.schema)


def inline_ids(spark: SparkSession, spec: TableSpec, ids: Iterable[int]) -> DataFrame:
    ids = list(ids)
    _check_keys(ids, f"The id list for {spec.name}")
    field = T.StructField("Id", spec.schema[spec.key].dataType, False)
    return spark.createDataFrame([(i,) for i in ids], T.StructType([field]))
