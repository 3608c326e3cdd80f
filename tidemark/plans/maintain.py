"""Operator jobs outside a pass: seed a table, delete listed rows, verify a load."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.errors import ConfigurationError
from tidemark.functions import required, too_wide
from tidemark.operators.checks import high_water_check, orphan_report, row_counts
from tidemark.operators.dedup import require_unique
from tidemark.operators.parents import flag_eligible
from tidemark.operators.prune import listed
from tidemark.options import SyncOptions
from tidemark.plans.ledger import RunLedger, SyncResult
from tidemark.plans.rewrite import cascade, materialise, remove_rows, sized, work_folder
from tidemark.plans.sync import merge_into
from tidemark.sources.targets import TargetStore
from tidemark.spec import TableSpec, children_of, descendants, load_order


def seed(spark: SparkSession, spec: TableSpec, rows: DataFrame, store: TargetStore) -> DataFrame:
    """Upsert given rows into a table without parents; its rows in key order.

    Keys must be present and unique and text must fit, since these rows are
    written by hand and nothing in them may be dropped or shortened.
    """
    if spec.parents:
        raise ConfigurationError(f"{spec.name} has parents and cannot be seeded.")

    def strict(column):
        value = F.col(column.name).cast(column.data_type)
        if column.required or column.reject_null:
            value = required(value, column.name)
        if column.width is not None:
            problem = F.raise_error(F.lit(f"A value for {spec.name}.{column.name} is too wide."))
            value = F.when(too_wide(value, column.width), problem).otherwise(value)
        return value.alias(column.name)

    with work_folder(spark, store, f"seed-{spec.name}") as work:
        checked, count = materialise(rows.select(*map(strict, spec.columns)), f"{work}/rows")
        require_unique(checked, spec.key, f"The seed of {spec.name}")
        # The rows and the mark become visible together.
        with store.transaction():
            options = SyncOptions(reseed_identity_columns=True)
            flagged = flag_eligible(checked, [])
            merge_into(spec, flagged, store, options, SyncResult(spec.name, rows_staged=count))
    return store.read(spec).orderBy(spec.key)


def delete_ids(
    spark: SparkSession,
    spec: TableSpec,
    ids: DataFrame,
    store: TargetStore,
    specs: Sequence[TableSpec],
) -> DataFrame:
    """Delete the listed rows and all rows that refer to them, through any number of tables; one report row.

    All of it becomes visible at once. For few ids no data is rewritten: only the deleted
    keys are written beside it.
    """
    children = children_of(spec.name, specs)
    with work_folder(spark, store, f"delete-{spec.name}") as work:
        ids, count = materialise(ids.select(F.col(ids.columns[0]).alias("Id")), f"{work}/ids")
        require_unique(ids, "Id", f"The id list for {spec.name}")
        with store.transaction():
            doomed = {(child.name, column): (ids, count) for child, column in children}
            removed = cascade(spark, store, spec, specs, doomed, work)
            below = [s.name for s in reversed(load_order(specs)) if s.name in descendants(spec.name, specs)]
            counts = {f"{name}RowsDeleted": removed.get(name, 0) for name in below}
            counts[f"{spec.name}RowsDeleted"] = remove_rows(store, spec, spec.key, ids, count)
        version = store.current(spec.name)
        counts[f"{spec.name}sRemaining"] = version.rows if version else 0
        counts["StillPresent"] = listed(store.read(spec), spec.key, sized(ids, count)).count()
    schema = ", ".join(f"`{name}` bigint" for name in counts)
    return spark.createDataFrame([tuple(counts.values())], schema)


def verify(
    spark: SparkSession,
    specs: Sequence[TableSpec],
    store: TargetStore,
    ledger: RunLedger,
    run_id: str,
) -> dict[str, DataFrame]:
    """The checks after a load, as DataFrames: ledger, row counts, orphans, high-water."""
    tables = {s.name: store.read(s) for s in specs}
    marks = []
    for spec in specs:
        if spec.identity:
            version = store.current(spec.name)
            mark = version.high_water if version and version.high_water is not None else 0
            marks.append(
                high_water_check(tables[spec.name], spec.key, F.lit(mark)).select(
                    F.lit(spec.name).alias("TableName"), "*"
                )
            )
    checks = {
        "ledger": ledger.report(run_id),
        "row_counts": row_counts(tables),
        "orphans": orphan_report(specs, tables),
    }
    if marks:
        high_water = marks[0]
        for mark in marks[1:]:
            high_water = high_water.unionByName(mark)
        checks["high_water"] = high_water
    return checks
