"""Staged rows to target rows: aliases, conversions, filters, widths, counters."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.functions import convert, fit_width, required, to_boolean, too_wide
from tidemark.operators.columns import find_column, require_column
from tidemark.options import SyncOptions
from tidemark.spec import ColumnSpec, FlagFilter, TableSpec

KEEP = "_keep"
CUT = "_cut"
# Why a row is filtered out, and its key as it is staged.
REASON = "_reason"
KEY_TEXT = "_key_text"


def _flag_drops(df: DataFrame, flag: FlagFilter) -> Column | None:
    name = find_column(df.columns, flag.aliases)
    if name is None:
        return None
    value = to_boolean(F.col(f"`{name}`"), df.schema[name].dataType, name)
    return F.coalesce(value == F.lit(flag.drop_when), F.lit(False))


def _raw_value(df: DataFrame, column: ColumnSpec) -> Column:
    if column.required:
        name = require_column(df.columns, column.aliases)
    else:
        name = find_column(df.columns, column.aliases)
        if name is None:
            return F.lit(None).cast(column.data_type)
    return convert(F.col(f"`{name}`"), df.schema[name].dataType, column.type, name)


def resolve_rows(df: DataFrame, spec: TableSpec, options: SyncOptions) -> DataFrame:
    """Every staged row under its target columns, plus ``_keep``, ``_cut``, ``_reason`` and ``_key_text``.

    The flag filters decide before any value is checked, so a dropped row may
    hold anything. ``_cut`` counts the values shortened in rows that passed
    the flags. Rows are not removed here, so that one pass can count them.
    """
    named = [
        (flag, drop)
        for flag in spec.flags
        if getattr(options, flag.option) and (drop := _flag_drops(df, flag)) is not None
    ]
    drops = [drop for _, drop in named]
    reason = F.lit(None).cast("string")
    key_text = F.lit(None).cast("string")

    def unless_dropped(value: Column) -> Column:
        for drop in reversed(drops):
            value = F.when(drop, F.lit(None)).otherwise(value)
        return value

    values: list[Column] = []
    checked: list[Column] = []
    present: list[Column] = []
    cuts: list[Column] = []
    for column in spec.columns:
        value = _raw_value(df, column)
        if column.required:
            value = required(value, column.aliases[0])
            checked.append(value)
        if column.name == spec.key and (staged_key := find_column(df.columns, column.aliases)):
            key_text = F.col(f"`{staged_key}`").cast("string")
        if column.reject_null:
            present.append(value.isNotNull())
            reason = F.when(value.isNull(), F.lit(f"{column.name} is missing")).otherwise(reason)
        if column.width is not None:
            cuts.append(too_wide(value, column.width).cast("int"))
            value = fit_width(value, column.width)
        values.append(unless_dropped(value).cast(column.data_type).alias(column.name))

    keep = F.lit(True)
    if present:
        # Required values are looked at first: a bad key fails even where the
        # row would be rejected for its NULL.
        keep = reduce(lambda a, b: a & b, present)
        for value in checked:
            keep = F.when(value.isNull(), F.lit(False)).otherwise(keep)
    for drop in reversed(drops):
        keep = F.when(drop, F.lit(False)).otherwise(keep)
    cut = reduce(lambda a, b: a + b, cuts) if cuts else F.lit(0)
    for flag, drop in reversed(named):
        reason = F.when(drop, F.lit(f"filtered by {flag.option}")).otherwise(reason)
    return df.select(
        *values,
        keep.alias(KEEP),
        F.coalesce(unless_dropped(cut), F.lit(0)).alias(CUT),
        reason.alias(REASON),
        key_text.alias(KEY_TEXT),
    )


def kept_rows(resolved: DataFrame, spec: TableSpec) -> DataFrame:
    return resolved.where(F.col(KEEP)).select(*spec.column_names)


def rejected_rows(resolved: DataFrame, spec: TableSpec) -> DataFrame:
    """The rows that were filtered out, for a quarantine table instead of a log line each."""
    return resolved.where(~F.col(KEEP)).select(*spec.column_names)


def counters() -> list[Column]:
    """Aggregates over resolved rows; the identity read = staged + filtered holds."""
    return [
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(~F.col(KEEP)).alias("rows_filtered"),
        F.count_if(F.col(KEEP)).alias("rows_staged"),
        F.coalesce(F.sum(F.col(CUT)), F.lit(0)).cast("bigint").alias("values_truncated"),
    ]


def map_rows(
    frames: DataFrame | Sequence[DataFrame],
    spec: TableSpec,
    options: SyncOptions,
    observation: Observation | None = None,
) -> DataFrame:
    """Map one staged frame, or one per staged schema, to target rows.

    With an ``observation`` the counters are gathered while the rows pass, at
    no extra scan.
    """
    return kept_rows(resolve_all(frames, spec, options, observation), spec)


def resolve_all(
    frames: DataFrame | Sequence[DataFrame],
    spec: TableSpec,
    options: SyncOptions,
    observation: Observation | None = None,
) -> DataFrame:
    """All staged rows, kept or not, as ``resolve_rows`` gives them."""
    if isinstance(frames, DataFrame):
        frames = [frames]
    resolved = reduce(
        DataFrame.unionByName, [resolve_rows(frame, spec, options) for frame in frames]
    )
    return resolved if observation is None else resolved.observe(observation, *counters())
