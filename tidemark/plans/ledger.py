"""Run ledger: an append-only event log and its current state."""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import ConfigurationError
from tidemark.sources.files import (
    create_text,
    delete_file,
    delete_folder,
    folder_exists,
    is_data_file,
    list_names,
    read_text,
    rename,
)

# Names of merged event files with their level, and of lists of the files they replace with their time.
_MERGED = re.compile(r"merged-(\d{2})-[0-9a-f]{32}\.parquet$")
_RETIRED = re.compile(r"_retired-(\d+)-[0-9a-f]{32}\.json$")

# The states of a table within a run.
RUNNING = "Running"
SUCCEEDED = "Succeeded"
FAILED = "Failed"

# The counters of the ledger, in report order.
COUNTERS = [
    ("FilesProcessed", T.IntegerType()),
    ("RowsRead", T.LongType()),
    ("RowsStaged", T.LongType()),
    ("RowsInserted", T.LongType()),
    ("RowsUpdated", T.LongType()),
    ("RowsFiltered", T.LongType()),
    ("RowsRejected", T.LongType()),
    ("RowsDeleted", T.LongType()),
    ("ValuesTruncated", T.LongType()),
]
COUNTER_NAMES = [name for name, _ in COUNTERS]

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("RunId", T.StringType()),
        T.StructField("TableName", T.StringType()),
        T.StructField("Status", T.StringType()),
        T.StructField("EventSeq", T.LongType()),
        T.StructField("EventUtc", T.TimestampType()),
        *[T.StructField(name, kind) for name, kind in COUNTERS],
        T.StructField("ErrorMessage", T.StringType()),
    ]
)


@dataclass
class SyncResult:
    """What one pass did to one table."""

    table_name: str
    was_skipped: bool = False
    files_processed: int = 0
    rows_read: int = 0
    rows_filtered: int = 0
    rows_staged: int = 0
    rows_inserted: int = 0
    rows_updated: int = 0
    rows_unchanged: int = 0
    rows_rejected: int = 0
    rows_deleted: int = 0
    child_rows_deleted: int = 0
    values_truncated: int = 0
    warnings: list[str] = field(default_factory=list)


RESULT_SCHEMA = T.StructType(
    [
        T.StructField("TableName", T.StringType()),
        T.StructField("WasSkipped", T.BooleanType()),
        T.StructField("FilesProcessed", T.IntegerType()),
        *[
            T.StructField(name, T.LongType())
            for name in (
                "RowsRead", "RowsFiltered", "RowsStaged", "RowsInserted", "RowsUpdated",
                "RowsUnchanged", "RowsRejected", "RowsDeleted", "ChildRowsDeleted",
                "ValuesTruncated",
            )
        ],
        T.StructField("Warnings", T.ArrayType(T.StringType())),
    ]
)


def results_frame(spark: SparkSession, results: Sequence[SyncResult]) -> DataFrame:
    """The pass report: one row per table."""
    return spark.createDataFrame([tuple(asdict(r).values()) for r in results], RESULT_SCHEMA)


def current_state(events: DataFrame) -> DataFrame:
    """One row per run and table from its events.

    A new attempt clears the completion time and the error; a failure leaves
    the counters of an earlier success in place. The groups are reduced per
    task before the shuffle, so a run with very many events is no burden.
    """
    last = F.max_by(F.struct("Status", "EventUtc", "ErrorMessage"), "EventSeq")
    running = F.col("Status") == RUNNING
    succeeded = F.col("Status") == SUCCEEDED
    counters = F.struct(*COUNTER_NAMES)
    ended = F.col("last.Status") != RUNNING
    return (
        events.groupBy("RunId", "TableName")
        .agg(
            last.alias("last"),
            # by number, as a merge that was cut short leaves events in two files
            F.size(F.collect_set(F.when(running, F.col("EventSeq")))).cast("int").alias("AttemptCount"),
            F.max_by("EventUtc", F.when(running, F.col("EventSeq"))).alias("StartedUtc"),
            F.max_by(counters, F.when(succeeded, F.col("EventSeq"))).alias("counters"),
        )
        .where(F.col("AttemptCount") > 0)
        .select(
            "RunId",
            "TableName",
            F.col("last.Status").alias("Status"),
            "AttemptCount",
            *[F.col(f"counters.{name}").alias(name) for name in COUNTER_NAMES],
            "StartedUtc",
            F.when(ended, F.col("last.EventUtc")).alias("CompletedUtc"),
            F.when(F.col("last.Status") == FAILED, F.col("last.ErrorMessage")).alias("ErrorMessage"),
        )
    )


def run_report(events: DataFrame, run_id: str) -> DataFrame:
    """The recorded outcome of every table of a run, in the order they started."""
    return current_state(events.where(F.col("RunId") == run_id)).drop("RunId").orderBy("StartedUtc")


def pending_tables(events: DataFrame, tables: DataFrame) -> DataFrame:
    """The (RunId, TableName) pairs of ``tables`` that have not succeeded yet."""
    done = current_state(events).where(F.col("Status") == SUCCEEDED)
    return tables.join(done, ["RunId", "TableName"], "left_anti")


class RunLedger:
    """Events below one folder, partitioned by run, in levels of files.

    An event is written as a file of its own. Once a run has ``fan_in`` files of a level,
    they are merged into one of the next, so that a run of n events has some
    ``fan_in * log(n)`` files. The merged file is renamed into place, and the files it
    stands for are listed beside it and deleted by a later merge, ``grace_seconds``
    after, when readers that began before have ended. Events that stand in two files
    count once.
    """

    _last_seq = 0

    def __init__(self, spark: SparkSession, path: str, fan_in: int = 16, grace_seconds: float = 600.0):
        if fan_in < 2:
            raise ConfigurationError("fan_in must be at least 2.")
        self.spark = spark
        self.path = path.rstrip("/")
        self.fan_in = fan_in
        self.grace_seconds = grace_seconds

    def ensure(self) -> None:
        """Create an empty ledger where there is none."""
        if not folder_exists(self.spark, self.path):
            self.spark.createDataFrame([], EVENT_SCHEMA).write.mode("append").partitionBy(
                "RunId"
            ).parquet(self.path)

    def events(self) -> DataFrame:
        """All events; columns that older files lack read as NULL."""
        if not folder_exists(self.spark, self.path):
            return self.spark.createDataFrame([], EVENT_SCHEMA)
        return (
            self.spark.read.schema(EVENT_SCHEMA)
            .option("basePath", self.path)
            .parquet(self.path)
            .select(*EVENT_SCHEMA.names)
        )

    def _append(self, run_id: str, table: str, status: str, **values: object) -> None:
        RunLedger._last_seq = seq = max(RunLedger._last_seq + 1, time.time_ns())
        values.update(RunId=run_id, TableName=table, Status=status, EventSeq=seq)
        row = [
            F.lit(values.get(field.name)).cast(field.dataType).alias(field.name)
            for field in EVENT_SCHEMA
            if field.name != "EventUtc"
        ]
        now = F.date_trunc("millisecond", F.timestamp_micros(F.lit(seq // 1000)))
        self.spark.range(1, numPartitions=1).select(*row, now.alias("EventUtc")).write.mode(
            "append"
        ).partitionBy("RunId").parquet(self.path)
        self.compact(run_id)

    def _folder(self, run_id: str) -> str:
        """The folder of a run; Spark escapes some characters of its name."""
        jvm = self.spark.sparkContext._jvm
        return f"{self.path}/RunId={jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(run_id)}"

    def files(self, run_id: str) -> dict[int, list[str]]:
        """Names of the files of a run by level, without those that a merged file stands for."""
        return self._files(run_id)[0]

    def _files(self, run_id: str) -> tuple[dict[int, list[str]], dict[str, list[str]]]:
        folder = self._folder(run_id)
        names = list_names(self.spark, folder, directories=False)
        merged = {n: json.loads(read_text(self.spark, f"{folder}/{n}")) for n in names if _RETIRED.match(n)}
        gone = {n for listed in merged.values() for n in listed}
        levels: dict[int, list[str]] = {}
        for name in sorted(n for n in names if is_data_file(n) and n not in gone):
            level = _MERGED.match(name)
            levels.setdefault(int(level[1]) if level else 0, []).append(name)
        return levels, merged

    def compact(self, run_id: str) -> None:
        """Merge full levels of a run, and delete what earlier merges replaced."""
        folder = self._folder(run_id)
        levels, merged = self._files(run_id)
        for listing, listed in merged.items():
            if time.time() - int(_RETIRED.match(listing)[1]) / 1e9 >= self.grace_seconds:
                for name in listed:
                    delete_file(self.spark, f"{folder}/{name}")
                delete_file(self.spark, f"{folder}/{listing}")
        schema = T.StructType([f for f in EVENT_SCHEMA if f.name != "RunId"])
        level = 0
        while len(levels.get(level, [])) >= self.fan_in:
            sources = levels.pop(level)
            work = f"{self.path}/_merge-{uuid.uuid4().hex}"
            rows = self.spark.read.schema(schema).parquet(*[f"{folder}/{n}" for n in sources])
            rows.dropDuplicates(["TableName", "EventSeq"]).coalesce(1).write.parquet(work)
            level += 1
            name = f"merged-{level:02d}-{uuid.uuid4().hex}.parquet"
            (part,) = (n for n in list_names(self.spark, work, directories=False) if is_data_file(n))
            # The list comes second: without it events are read twice and count once; alone it would hide them.
            rename(self.spark, f"{work}/{part}", f"{folder}/{name}")
            create_text(self.spark, f"{folder}/_retired-{time.time_ns()}-{uuid.uuid4().hex}.json", json.dumps(sources))
            delete_folder(self.spark, work)
            levels.setdefault(level, []).append(name)

    def mark_running(self, run_id: str, table: str) -> None:
        self._append(run_id, table, RUNNING)

    def mark_succeeded(self, run_id: str, result: SyncResult) -> None:
        self._append(
            run_id,
            result.table_name,
            SUCCEEDED,
            FilesProcessed=result.files_processed,
            RowsRead=result.rows_read,
            RowsStaged=result.rows_staged,
            RowsInserted=result.rows_inserted,
            RowsUpdated=result.rows_updated,
            RowsFiltered=result.rows_filtered,
            RowsRejected=result.rows_rejected,
            RowsDeleted=result.rows_deleted,
            ValuesTruncated=result.values_truncated,
        )

    def mark_failed(self, run_id: str, table: str, message: str) -> None:
        self._append(run_id, table, FAILED, ErrorMessage=message)

    def state(self) -> DataFrame:
        return current_state(self.events())

    def report(self, run_id: str) -> DataFrame:
        return run_report(self.events(), run_id)

    def succeeded_tables(self, run_id: str) -> set[str]:
        """Names of the tables that have succeeded in a run."""
        done = current_state(self.events().where(F.col("RunId") == run_id)).where(
            F.col("Status") == SUCCEEDED
        )
        return {row["TableName"] for row in done.select("TableName").collect()}

    def has_succeeded(self, run_id: str, table: str) -> bool:
        return table in self.succeeded_tables(run_id)
