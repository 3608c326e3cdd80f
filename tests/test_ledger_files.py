"""The files of a ledger: levelled merges leave its state as it is and its files few."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from tidemark.errors import ConfigurationError
from tidemark.plans.ledger import EVENT_SCHEMA, RunLedger, SyncResult, current_state


def state(ledger):
    return sorted(map(tuple, ledger.state().drop("StartedUtc", "CompletedUtc").collect()), key=repr)


def event_files(path):
    return [f for _, _, files in os.walk(path) for f in files if f.endswith(".parquet") and not f.startswith((".", "_"))]


def test_merges_keep_the_state_and_few_files(spark, tmp_path):
    ledger = RunLedger(spark, str(tmp_path / "ledger"), fan_in=3, grace_seconds=0)
    plain = RunLedger(spark, str(tmp_path / "plain"), fan_in=10**9)
    for book in (ledger, plain):
        for attempt in range(5):
            book.mark_running("run 1/a", "Item")
            if attempt % 2:
                book.mark_succeeded("run 1/a", SyncResult("Item", rows_read=attempt))
            else:
                book.mark_failed("run 1/a", "Item", f"broken {attempt}")
        book.mark_running("run 2", "Blob")
    assert state(ledger) == state(plain) and len(state(ledger)) == 2
    assert len(event_files(plain.path)) == 11 and len(event_files(ledger.path)) <= 8
    assert sum(len(v) for v in ledger.files("run 1/a").values()) <= 2 * 3 and max(ledger.files("run 1/a")) == 2
    assert ledger.events().count() >= plain.events().count() and not [f for f in os.listdir(ledger.path) if f.startswith("_merge")]


def test_many_events_come_from_a_bounded_number_of_files(spark, tmp_path):
    path = str(tmp_path / "ledger")
    values = {"RunId": F.lit("r"), "TableName": F.concat(F.lit("t"), F.col("id") % 7), "Status": F.lit("Running"), "EventSeq": F.col("id") + 1}
    columns = [values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in EVENT_SCHEMA]
    spark.range(0, 1000, 1, 1000).select(*columns).write.partitionBy("RunId").parquet(path)
    ledger = RunLedger(spark, path, grace_seconds=0)
    assert len(event_files(path)) == 1000
    before = state(ledger)
    for _ in range(2):  # the second deletes what the first replaced
        ledger.compact("r")
    assert len(event_files(path)) <= 2 and state(ledger) == before


def test_files_in_grace_and_events_in_two_files_count_once(spark, tmp_path):
    ledger = RunLedger(spark, str(tmp_path / "ledger"), fan_in=2)
    for _ in range(3):
        ledger.mark_running("r", "Item")
    # all files are still there for readers that began before the merge
    assert len(event_files(ledger.path)) == 4 and ledger.events().count() > 3
    assert state(ledger)[0][3] == 3 and sum(map(len, ledger.files("r").values())) == 2
    folder = tmp_path / "ledger" / "RunId=r"
    first = next(f for f in os.listdir(folder) if f.startswith("part-"))
    shutil.copy(folder / first, folder / "part-copy.parquet")
    assert current_state(ledger.events()).first()["AttemptCount"] == 3
    with pytest.raises(ConfigurationError):
        RunLedger(spark, "/x", fan_in=1)
