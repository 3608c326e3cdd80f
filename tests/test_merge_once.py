"""A merge into slices joins the staged rows with the target once, whatever it then writes."""

from pyspark.sql import functions as F

from tidemark.operators.parents import flag_eligible
from tidemark.options import SyncOptions
from tidemark.plans import sync
from tidemark.plans.ledger import SyncResult
from tidemark.sources.targets import TargetStore
from tidemark.spec import ColumnSpec, TableSpec

TOP = TableSpec("Top", "Id", (ColumnSpec("Id", ("Id",)), ColumnSpec("Name", ("Name",), "string")), "top", (), identity=True, prunable=True)
ROWS, SLICES = 400, 8


def rows(spark, n=ROWS):
    return spark.range(0, n, 1, 2).select(F.col("id").cast("int").alias("Id"), F.concat(F.lit("n"), "id").alias("Name"))


def merge(store, frame, prune=False):
    result = SyncResult(TOP.name, rows_staged=frame.count())
    sync.merge_into(TOP, flag_eligible(frame, []), store, SyncOptions(), result, prune, staged=frame)
    return result


def test_a_change_is_joined_once_and_written_whole(spark, tmp_path, monkeypatch):
    store = TargetStore(spark, str(tmp_path / "target"), slice_rows=ROWS // SLICES)
    merge(store, rows(spark))
    joins = []

    def counted(*args, of=sync._classified):
        joins.append(args[0].name)
        return of(*args)

    monkeypatch.setattr(sync, "_classified", counted)
    # keys that are gone, changed and new, and some that come twice
    later = rows(spark, ROWS + 10).where("Id % 50 <> 7").withColumn("Name", F.when(F.col("Id") % 40 == 1, F.lit("new")).otherwise(F.col("Name")))
    want = sorted(tuple(r) for r in later.collect())
    result = merge(store, later.unionByName(later.where("Id < 5 AND Id <> 1")), prune=True)
    assert joins == ["Top"]
    assert (result.rows_inserted, result.rows_updated, result.rows_deleted, result.rows_rejected) == (9, 10, 8, 4)
    assert sorted(tuple(r) for r in store.read(TOP).collect()) == want
    version = store.current("Top")
    assert version.rows == len(want) and version.high_water == ROWS + 9
    # the digests name the rows that are there: the same rows again change nothing and are not joined
    assert merge(store, later, prune=True).rows_unchanged == len(want) and joins == ["Top"] and store.current("Top") == version
    # as many rows in each slice, with other values
    assert merge(store, later.withColumn("Name", F.when(F.col("Id") == 3, F.lit("x")).otherwise(F.col("Name")))).rows_updated == 1
    # only deletes
    left = store.read(TOP).where("Id <> 3").localCheckpoint()
    assert merge(store, left, prune=True).rows_deleted == 1 and joins == ["Top"] * 3
    assert sorted(tuple(r) for r in store.read(TOP).collect()) == sorted(tuple(r) for r in left.collect())
