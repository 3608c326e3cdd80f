"""Shared steps of the jobs that rewrite a target table."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.session import shared_folder
from tidemark.sources.files import delete_folder
from tidemark.sources.targets import TargetStore
from tidemark.spec import TableSpec, load_order

# A side of a join is broadcast only if it was counted and is not larger.
BROADCAST_ROWS = 200_000

# Intermediate copies of whole tables are soon deleted; a denser codec than the tables' saves disk. Not for
# what may be broadcast, as Spark goes by the size of the files.
SCRATCH_CODEC = "zstd"


@contextmanager
def work_folder(spark: SparkSession, store: TargetStore, label: str) -> Iterator[str]:
    """A folder for intermediate tables, removed when the step ends."""
    base = (shared_folder(spark) or f"{store.root}/_work").rstrip("/")
    folder = f"{base}/tidemark-{label}-{uuid.uuid4().hex}"
    try:
        yield folder
    finally:
        delete_folder(spark, folder)


def materialise(df: DataFrame, path: str, codec: str | None = None) -> tuple[DataFrame, int]:
    """Write a table and read it back, with its exact number of rows.

    The count is taken in the tasks that write, so a task that runs twice
    counts once.
    """
    observed = Observation()
    counted = df.observe(observed, F.count(F.lit(1)).alias("rows"))
    (counted.write.option("compression", codec) if codec else counted.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), observed.get["rows"]


def sized(df: DataFrame, rows: int) -> DataFrame:
    """Ask for a broadcast if the counted rows are few; otherwise leave it to Spark."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def remove_rows(
    store: TargetStore, spec: TableSpec, column: str, doomed: DataFrame, doomed_rows: int
) -> int:
    """Delete the rows whose ``column`` is among the doomed values; how many there were."""
    return remove_matching(store, spec, [(column, doomed, doomed_rows)])[0]


def remove_matching(
    store: TargetStore, spec: TableSpec, doomed: Sequence[tuple[str, DataFrame, int]]
) -> tuple[int, DataFrame | None]:
    """Delete the rows that hold a doomed value in any of the given columns; how many, and their keys.

    Nothing is written where there are none, and only keys where they are few.
    """
    previous = store.current(spec.name)
    doomed = [d for d in doomed if d[2]]
    if previous is None or not previous.rows or not doomed:
        return 0, None
    hits = []
    for column, frame, rows in doomed:
        values = frame.select(F.col(frame.columns[0]).alias("_doomed"))
        match = F.col(column).eqNullSafe(F.col("_doomed"))
        hits.append(store.read(spec).join(sized(values, rows), match, "left_semi"))
    found = reduce(DataFrame.unionByName, hits)
    # a row that two columns doom is deleted once
    return store.delete(spec, previous, found.dropDuplicates([spec.key]) if len(hits) > 1 else found)


def cascade(
    spark: SparkSession,
    store: TargetStore,
    spec: TableSpec,
    specs: Sequence[TableSpec],
    doomed: Mapping[tuple[str, str], tuple[DataFrame, int]],
    work: str,
) -> dict[str, int]:
    """Delete all rows that refer, through any number of tables, to doomed rows of ``spec``; how many per table.

    ``doomed`` holds the doomed values of each direct child's column. The keys of the rows
    that go are the frontier: tables come in foreign-key order, so when a table is reached
    all that is doomed in its parents is known. A table that refers to itself is asked
    again until nothing is added. Tables that refer to each other in a cycle are refused.
    """
    removed: dict[str, int] = {}
    frontier: dict[str, tuple[DataFrame, int]] = {}
    for child in load_order(specs):
        if child.name == spec.name or store.current(child.name) is None:
            continue
        asked = [(column, *doomed[child.name, column]) for name, column in doomed if name == child.name]
        asked += [(p.column, *frontier[p.table]) for p in child.parents if p.table in frontier]
        found: list[DataFrame] = []
        while asked:
            count, keys = remove_matching(store, child, asked)
            asked = []
            if count:
                # the keys as they are now, whatever becomes of the folder that lists them
                kept, rows = materialise(keys, f"{work}/gone-{child.name}-{len(found)}")
                found.append(kept)
                removed[child.name] = removed.get(child.name, 0) + count
                asked = [(p.column, kept, rows) for p in child.parents if p.table == child.name]
        if found:
            frontier[child.name] = (reduce(DataFrame.unionByName, found), removed[child.name])
    return removed
