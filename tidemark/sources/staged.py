"""Reading staged Parquet folders whose files may differ in column names and types."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import EmptySourceError, MappingError
from tidemark.operators.columns import find_column, flag_warnings
from tidemark.options import SyncOptions
from tidemark.sources.files import DATA_FILE_GLOB, list_data_files
from tidemark.spec import TableSpec

# Files of one Spark write job carry the job's id and share one schema:
# part-00012-<job>-c000.snappy.parquet, part-00012-<job>_00003.c000.snappy.parquet.
_JOB_ID = r"/part-\d+-([0-9a-fA-F-]{36})[^/]*$"


def read_columns(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Read only the named columns, whatever their case; absent names are left out."""
    if not columns:
        raise ValueError("read_columns was given no column names; a scan without columns would return rows of nothing.")
    paths = [path] if isinstance(path, str) else list(path)
    df = _reader(spark).parquet(*paths)
    wanted = {name.lower() for name in columns}
    return df.select(*[f"`{name}`" for name in df.columns if name.lower() in wanted])


def _reader(spark: SparkSession):
    return spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", DATA_FILE_GLOB)


@dataclass(frozen=True)
class StagedScan:
    """One frame per distinct staged schema, and how many files they cover."""

    frames: list[DataFrame]
    file_count: int
    warnings: list[str] = field(default_factory=list)


def _needed_fields(schema: T.StructType, spec: TableSpec) -> T.StructType:
    """The staged fields the mapping reads, under their staged names."""
    picks = [find_column(schema.names, c.aliases) for c in spec.columns]
    picks += [find_column(schema.names, f.aliases) for f in spec.flags]
    return T.StructType([schema[name] for name in dict.fromkeys(p for p in picks if p)])


def _schema_groups(
    spark: SparkSession, files: Sequence[str], spec: TableSpec
) -> list[tuple[T.StructType, list[str]]]:
    """Put files (one per write job) that resolve the same way into one group.

    Each is looked at, however many there are: a column that one job left out
    must be noticed, and a union of schemas would hide it. An extract is
    written by one job per table as a rule.
    """
    settled: dict[str, tuple[T.StructType, list[str]]] = {}
    for file in sorted(files):
        needed = _needed_fields(spark.read.parquet(file).schema, spec)
        settled.setdefault(needed.json().lower(), (needed, []))[1].append(file)
    return list(settled.values())


def scan_files(
    spark: SparkSession, listing: DataFrame, spec: TableSpec, options: SyncOptions,
    folder: str | None = None,
) -> StagedScan:
    """Scan the files of a listing, resolving column names per write job.

    ``folder`` names the folder the listing covers completely; it is then read
    as a whole when one schema fits all files.
    """
    job_id = F.regexp_extract("path", _JOB_ID, 1)
    job = F.when(job_id != "", job_id).otherwise(F.col("path"))
    jobs = (
        listing.groupBy(job.alias("job"))
        .agg(F.min("path").alias("path"), F.count(F.lit(1)).alias("files"))
        .collect()
    )
    file_count = sum(row["files"] for row in jobs)
    if file_count == 0:
        return StagedScan([], 0)
    representatives = sorted(row["path"] for row in jobs)
    groups = _schema_groups(spark, representatives, spec)

    frames, warnings = [], []
    for needed, members in groups:
        if not needed.fields:
            raise MappingError(f"The staged files of {spec.name} hold none of its columns.")
        reader = _reader(spark).schema(needed)
        if len(groups) == 1 and folder is not None:
            frames.append(reader.parquet(folder))
        else:
            job_of = {row["path"]: row["job"] for row in jobs}
            names = [job_of[m] for m in members]
            chosen = listing if len(groups) == 1 else listing.where(job.isin(names))
            paths = [row["path"] for row in chosen.select("path").collect()]
            frames.append(spark.read.schema(needed).parquet(*sorted(paths)))
        warnings += flag_warnings(needed.names, spec, options)
    return StagedScan(frames, file_count, list(dict.fromkeys(warnings)))


def scan_folder(
    spark: SparkSession, folder: str, spec: TableSpec, options: SyncOptions
) -> StagedScan:
    """Scan a staged folder; an empty one is an error unless the options allow it."""
    try:
        listing = list_data_files(spark, folder)
        listing = listing.coalesce(max(64, spark.sparkContext.defaultParallelism))
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            raise EmptySourceError(f"'{folder}' does not exist; the run was staged without it or under another name.") from problem
        raise
    scan = scan_files(spark, listing, spec, options, folder)
    if scan.file_count == 0 and not options.allow_empty_source_folders:
        raise EmptySourceError(
            f"{spec.name} has no data file below '{folder}' and stays as it is. An extract that is "
            "still being written looks the same; for a table that may be empty, turn on "
            "allow_empty_source_folders."
        )
    return scan
