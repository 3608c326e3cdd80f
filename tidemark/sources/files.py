"""Folders and small files, through the Hadoop file system of the session."""

from __future__ import annotations

import threading
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.errors import ConfigurationError

# Fixed value: staged data files end in .parquet, in any case.
DATA_FILE_GLOB = "*.[pP][aA][rR][qQ][uU][eE][tT]"

# Stands in a run folder once all of the run is staged.
COMPLETE_FILE = "run.complete"

_CREATING = threading.Lock()

FILE_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)


def is_data_file(name: str) -> bool:
    """True for data files, false for bookkeeping such as ``_SUCCESS`` and checksums."""
    return name.lower().endswith(".parquet") and not name.startswith(("_", "."))


def list_data_files(spark: SparkSession, folder: str) -> DataFrame:
    """``path`` and ``length`` of all data files below a folder.

    File contents are never opened, and ``k=v`` folder names stay plain names.
    Spark passes over files and folders that start with ``_`` or ``.``.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", DATA_FILE_GLOB)
        .load(folder)
        .select("path", "length")
    )


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(conf), hadoop_path


def list_names(spark: SparkSession, folder: str, *, directories: bool) -> list[str]:
    """Names directly below a folder; an absent folder has none."""
    fs, path = _file_system(spark, folder)
    if not fs.exists(path):
        return []
    return [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory() == directories]


def folder_exists(spark: SparkSession, folder: str) -> bool:
    fs, path = _file_system(spark, folder)
    return fs.exists(path)


def read_text(spark: SparkSession, file: str) -> str:
    fs, path = _file_system(spark, file)
    stream = fs.open(path)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, file: str, text: str) -> bool:
    """Write a new small file; False if it exists already.

    The text goes to a temporary name first and is then renamed, so that a reader
    never sees part of it. Hadoop's rename does not replace a file; that of a local
    file system may, so the writers of one process take turns.
    """
    with _CREATING:
        return _create_text(spark, file, text)


def _create_text(spark: SparkSession, file: str, text: str) -> bool:
    fs, path = _file_system(spark, file)
    if fs.exists(path):
        return False
    temporary = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path.getParent(), f"_{uuid.uuid4().hex}.tmp")
    stream = fs.create(temporary, False)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    if fs.exists(path) or not fs.rename(temporary, path):
        fs.delete(temporary, False)
        return False
    return True


def delete_folder(spark: SparkSession, folder: str) -> None:
    fs, path = _file_system(spark, folder)
    fs.delete(path, True)


def rename(spark: SparkSession, file: str, name: str) -> None:
    fs, path = _file_system(spark, file)
    if not fs.rename(path, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)):
        raise OSError(f"{file} could not be renamed to {name}.")


def delete_file(spark: SparkSession, file: str) -> None:
    fs, path = _file_system(spark, file)
    fs.delete(path, False)


@dataclass(frozen=True)
class Run:
    run_id: str
    path: str


def newest_run(spark: SparkSession, stage_root: str, prefix: str = "run_") -> Run:
    """The last run folder by name; names carry the date, so name order is time order."""
    root = stage_root.rstrip("/")
    names = [
        name
        for name in list_names(spark, root, directories=True)
        if name.lower().startswith(prefix.lower())
    ]
    if not names:
        raise ConfigurationError(
            f"'{root}' holds no run: none of its folders is named {prefix}*. Either nothing was "
            "staged there yet, or run_folder_prefix or run_id has to be set."
        )
    # UTF-16BE bytes sort like UTF-16 code units.
    newest = max(names, key=lambda name: name.encode("utf-16-be"))
    return Run(newest, f"{root}/{newest}")


def resolve_run(
    spark: SparkSession, stage_root: str, run_id: str | None = None, prefix: str = "run_"
) -> Run:
    """The named run, or the newest one when no name is given."""
    if run_id and run_id.strip():
        return Run(run_id, f"{stage_root.rstrip('/')}/{run_id}")
    return newest_run(spark, stage_root, prefix)
