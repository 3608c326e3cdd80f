"""Tables of many slices keep them in the files of a few groups, whatever was written or deleted since."""

import os

import pytest
from pyspark.sql import functions as F

from tidemark.operators.parents import flag_eligible
from tidemark.options import SyncOptions
from tidemark.plans.ledger import SyncResult
from tidemark.plans.maintain import delete_ids
from tidemark.plans.sync import merge_into
from tidemark.sources.targets import GROUPS, TargetStore, slice_of
from tidemark.spec import ColumnSpec, TableSpec

TOP = TableSpec("Top", "Id", (ColumnSpec("Id", ("Id",)), ColumnSpec("Name", ("Name",), "string")), "top", (), identity=True, prunable=True)
ROWS, SLICES = 4_000, 4 * GROUPS


def rows(spark, n=ROWS):
    return spark.range(0, n, 1, 2).select(F.col("id").cast("int").alias("Id"), F.concat(F.lit("n"), "id").alias("Name"))


def merge(store, frame, prune=False):
    result = SyncResult(TOP.name, rows_staged=frame.count())
    merge_into(TOP, flag_eligible(frame, []), store, SyncOptions(), result, prune)
    return result


def contents(frame):
    return sorted(tuple(r) for r in frame.collect())


@pytest.fixture
def store(spark, tmp_path):
    store = TargetStore(spark, str(tmp_path / "target"), slice_rows=-(-ROWS // SLICES))
    merge(store, rows(spark))
    assert store.current("Top").slice_count == SLICES
    return store


def test_many_slices_lie_in_few_folders(spark, store):
    folder = f"{store.root}/Top/{store.current('Top').folder}"
    assert len([n for n in os.listdir(folder) if "=" in n]) <= GROUPS
    assert len(store.read(TOP).inputFiles()) <= GROUPS * 2 and store.read(TOP).columns == ["Id", "Name"]
    number = slice_of("Id", SLICES)
    some = store.read_version(TOP, store.current("Top"), [3, 64])
    assert contents(some) == contents(rows(spark).where(number.isin(3, 64))) and len(some.inputFiles()) <= 4


def test_slices_are_taken_from_the_folder_that_holds_them_now(spark, store):
    number = slice_of("Id", SLICES)
    # slices 8 and 9 share a group with slices that stay where they are
    changed = rows(spark).withColumn("Name", F.when(number.isin(8, 9), F.lit("new")).otherwise(F.col("Name")))
    first = store.current("Top")
    assert merge(store, changed).rows_updated == changed.where("Name = 'new'").count() > 0
    now = store.current("Top")
    assert {k for k in now.slices if now.slices[k] != first.slices[k]} == {8, 9}
    assert contents(store.read(TOP)) == contents(changed)
    assert merge(store, changed, prune=True).rows_unchanged == ROWS and store.current("Top") == now
    # keys are deleted from slices of one group, and some of them come back by a rewrite of their slice alone
    gone = changed.where(number.isin(8, 11)).groupBy(number).agg(F.min("Id").alias("Id")).select("Id")
    keys = [r["Id"] for r in gone.collect()]
    assert delete_ids(spark, TOP, gone, store, [TOP]).first()["TopRowsDeleted"] == 2
    assert contents(store.read(TOP)) == contents(changed.where(~F.col("Id").isin(keys)))
    again = changed.where((F.col("Id") != keys[0]))
    assert merge(store, again, prune=True).rows_inserted == 1
    assert contents(store.read(TOP)) == contents(again) and store.highest_key(TOP, store.current("Top")) == again.agg(F.max("Id")).first()[0]
    # folders that no slice is taken from any more are the only ones dropped
    merge(store, again.withColumn("Name", F.when(number == 40, F.lit("x")).otherwise(F.col("Name"))), prune=True)
    kept = contents(store.read(TOP))
    store.drop_old_versions(TOP, 1)
    assert contents(store.read(TOP)) == kept
    # a table that nothing is left of but one slice
    left = again.where(number == 77)
    assert merge(store, left, prune=True).rows_deleted == len(kept) - left.count() and contents(store.read(TOP)) == contents(left)
