"""Extract source tables into a run folder of Parquet."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.options import SyncOptions, check_no_placeholder
from tidemark.sources.files import COMPLETE_FILE, create_text, delete_folder
from tidemark.sources.jdbc import JdbcSource
from tidemark.spec import TableSpec

Source = Mapping[str, DataFrame] | Callable[[TableSpec], DataFrame] | JdbcSource


def default_run_id(now: datetime | None = None) -> str:
    return f"{(now or datetime.now(timezone.utc)):run_%Y%m%d_001}"


def stage(df: DataFrame, path: str, num_files: int | None = None) -> int:
    """Write one table and count what is really there.

    The count reads footers only. ``num_files`` is for small tables; without
    it the write keeps the parallelism of the read.
    """
    if num_files is not None:
        df = df.coalesce(num_files)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path).count()


def _source_frame(spark: SparkSession, source: Source, spec: TableSpec) -> DataFrame:
    if isinstance(source, JdbcSource):
        return source.read_table(spark, spec)
    df = source[spec.name] if isinstance(source, Mapping) else source(spec)
    return df.select(*spec.extract_columns)


def mark_complete(spark: SparkSession, stage_root: str, run_id: str) -> None:
    """Say that all of a run is staged; streams load it from then on."""
    create_text(spark, f"{stage_root.rstrip('/')}/{run_id}/{COMPLETE_FILE}", run_id)


def extract_run(
    spark: SparkSession,
    specs: Sequence[TableSpec],
    source: Source,
    stage_root: str,
    run_id: str | None = None,
    num_files: Mapping[str, int] | None = None,
    options: SyncOptions | None = None,
    complete: bool = True,
) -> tuple[str, dict[str, int]]:
    """Stage every table below ``<stage_root>/<run_id>``; run id and row counts.

    The run is marked complete at the end. A run that is staged in several calls
    passes ``complete=False`` in all but the last.
    """
    check_no_placeholder(stage_root=stage_root, run_id=run_id or "")
    options = options or SyncOptions()
    run_id = run_id or default_run_id()
    delete_folder(spark, f"{stage_root.rstrip('/')}/{run_id}/{COMPLETE_FILE}")
    counts = {
        spec.name: stage(
            _source_frame(spark, source, spec),
            f"{stage_root.rstrip('/')}/{run_id}/{options.folder_of(spec)}",
            (num_files or {}).get(spec.name),
        )
        for spec in specs
    }
    if complete:
        mark_complete(spark, stage_root, run_id)
    return run_id, counts


def capture_rows(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """All rows of a source table in key order, to seed a table with."""
    return df.select(key, *columns).orderBy(key)


def capture_deleted(df: DataFrame, key: str, columns: Sequence[str] = (), flag: str = "Deleted") -> DataFrame:
    """The rows a source flags as deleted, in key order, to delete by list."""
    return df.where(F.col(flag)).select(key, *columns).orderBy(key)
