"""Targets in slices: what a change writes, lists of deleted keys, commits of several tables, cascades."""

import os
import threading
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tidemark.errors import CommitConflictError, ConfigurationError
from tidemark.operators.parents import flag_eligible
from tidemark.options import SyncOptions
from tidemark.plans import rewrite
from tidemark.plans.ledger import SyncResult
from tidemark.plans.maintain import delete_ids, seed
from tidemark.plans.sync import merge_into
from tidemark.sources.targets import TargetStore, digest_columns, slice_of
from tidemark.spec import ColumnSpec, ParentRef, TableSpec


def spec(name, *parents):
    columns = [ColumnSpec("Id", ("Id",)), ColumnSpec("Name", ("Name",), "string")]
    columns += [ColumnSpec(c, (c,)) for _, c in parents]
    return TableSpec(name, "Id", tuple(columns), name.lower(), tuple(ParentRef(t, c) for t, c in parents), identity=True, prunable=True)


TOP = spec("Top")
ROWS, SLICES = 8_000, 16


@pytest.fixture(autouse=True)
def interpreted(spark):
    settings = {"spark.sql.codegen.wholeStage": "false", "spark.sql.codegen.factoryMode": "NO_CODEGEN"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name in settings:
        spark.conf.unset(name)


def rows(spark, n=ROWS):
    name = F.sha2(F.col("id").cast("string"), 256)
    return spark.range(0, n, 1, 2).select(F.col("id").cast("int").alias("Id"), name.alias("Name"))


def merge(store, table, frame, prune=False):
    result = SyncResult(table.name, rows_staged=frame.count())
    merge_into(table, flag_eligible(frame, []), store, SyncOptions(), result, prune)
    return result


def written(store, table):
    """Bytes of data by folder."""
    found = {}
    for place, _, files in os.walk(f"{store.root}/{table.name}"):
        folder = os.path.relpath(place, f"{store.root}/{table.name}").split(os.sep)[0]
        found[folder] = found.get(folder, 0) + sum(os.path.getsize(f"{place}/{f}") for f in files if f.endswith(".parquet"))
    return {k: v for k, v in found.items() if k not in (".", "_commits")}


@pytest.fixture
def store(spark, tmp_path):
    store = TargetStore(spark, str(tmp_path / "target"), slice_rows=ROWS // SLICES)
    merge(store, TOP, rows(spark))
    return store


def contents(store, table):
    return sorted(tuple(r) for r in store.read(table).collect())


def test_a_change_in_few_slices_writes_few_bytes(spark, store):
    first, before = store.current("Top"), written(store, TOP)
    assert first.slice_count == SLICES and len(first.slices) == SLICES and first.rows == ROWS
    # 1 % of the keys change, all of them in 2 of the 16 slices
    number = slice_of("Id", SLICES)
    changed = rows(spark).withColumn("Name", F.when(number.isin(3, 7) & (F.col("Id") % 13 == 0), F.lit("new")).otherwise(F.col("Name")))
    result = merge(store, TOP, changed)
    assert result.rows_updated == changed.where("Name = 'new'").count() > 0 and result.rows_unchanged == ROWS - result.rows_updated
    added = {k: v for k, v in written(store, TOP).items() if k not in before}
    assert len(added) == 1 and sum(added.values()) <= 1.5 * 2 / SLICES * sum(before.values())
    now = store.current("Top")
    assert {k for k in now.slices if now.slices[k] != first.slices[k]} == {3, 7}
    assert contents(store, TOP) == sorted(tuple(r) for r in changed.collect())
    # slices that the staged rows leave alone are not opened
    part = store.read_version(TOP, now, [3])
    assert all("slice=3/" in f for f in part.inputFiles())


def test_a_rerun_opens_and_writes_no_data(spark, store, monkeypatch):
    before, version = written(store, TOP), store.current("Top")

    def refuse(*_, **__):
        raise AssertionError("the target was read or written")

    for name in ("read", "read_version", "read_by_key", "write", "delete"):
        monkeypatch.setattr(store, name, refuse)
    for prune in (False, True):
        result = merge(store, TOP, rows(spark), prune)
        assert (result.rows_unchanged, result.rows_inserted, result.rows_updated, result.rows_deleted, result.rows_rejected) == (ROWS, 0, 0, 0, 0)
    assert store.current("Top") == version and written(store, TOP) == before


def test_duplicates_and_rows_only_in_the_target_are_no_change(spark, store):
    twice = rows(spark).unionByName(rows(spark, 50))
    result = merge(store, TOP, twice, prune=True)
    assert (result.rows_unchanged, result.rows_rejected, result.rows_deleted) == (ROWS, 50, 0)
    version = store.current("Top")
    assert version.number == 1 and merge(store, TOP, rows(spark, 20)).rows_unchanged == 20
    assert store.current("Top") == version


def test_few_deletes_write_keys_only(spark, store):
    before = written(store, TOP)
    ids = spark.createDataFrame([(i,) for i in (5, 17, ROWS - 1, 10**6)], "Id int")
    report = delete_ids(spark, TOP, ids, store, [TOP]).first()
    assert (report["TopRowsDeleted"], report["TopsRemaining"], report["StillPresent"]) == (3, ROWS - 3, 0)
    added = [k for k in written(store, TOP) if k not in before]
    assert added and all(k.startswith("deletes-") for k in added)
    assert store.read(TOP).count() == ROWS - 3 and store.highest_key(TOP, store.current("Top")) == ROWS - 2
    # what is left has the digest of what is left: a pass over it changes nothing
    left = rows(spark).where("Id NOT IN (5, 17)").where(F.col("Id") != ROWS - 1)
    version = store.current("Top")
    assert merge(store, TOP, left, prune=True).rows_unchanged == ROWS - 3 and store.current("Top").slices == version.slices
    # a deleted key that is staged again comes back
    assert merge(store, TOP, rows(spark)).rows_inserted == 3 and contents(store, TOP) == sorted(tuple(r) for r in rows(spark).collect())


def test_many_deletes_fold_into_a_rewrite(spark, store):
    number = slice_of("Id", SLICES)
    ids = rows(spark).where((number == 2) & (F.col("Id") % 3 == 0)).select("Id")
    delete_ids(spark, TOP, ids, store, [TOP])
    version = store.current("Top")
    assert not any(s.deletes for s in version.slices.values()) and version.slices[2].folder != version.slices[1].folder
    assert store.read(TOP).join(ids, "Id").count() == 0 and store.read(TOP).count() == version.rows
    for i in range(10):
        delete_ids(spark, TOP, rows(spark).where((number == 4)).select("Id").orderBy("Id").offset(i).limit(1), store, [TOP])
    assert max(len(s.deletes) for s in store.current("Top").slices.values()) <= 8


def test_tables_become_visible_together(spark, tmp_path):
    a, b = spec("A"), spec("B")
    writer, reader = (TargetStore(spark, str(tmp_path)) for _ in range(2))
    one = spark.createDataFrame([(1, "x")], a.schema)
    with writer.transaction():
        merge(writer, a, one)
        assert reader.current("A") is None and writer.read(a).count() == 1
        merge(writer, b, one)
        assert reader.current("B") is None
    assert reader.read(a).count() == reader.read(b).count() == 1
    with pytest.raises(RuntimeError), writer.transaction():
        merge(writer, a, one.withColumn("Id", F.lit(2)))
        raise RuntimeError("stop")
    assert writer.read(a).count() == reader.read(a).count() == 1
    # another table's commit in between is no conflict, the same table's is
    with writer.transaction():
        merge(writer, a, one.withColumn("Id", F.lit(3)))
        merge(reader, b, one.withColumn("Id", F.lit(3)))
    assert reader.read(a).count() == reader.read(b).count() == 2
    with pytest.raises(CommitConflictError), writer.transaction():
        merge(writer, a, one.withColumn("Id", F.lit(4)))
        merge(writer, b, one.withColumn("Id", F.lit(4)))
        merge(reader, b, one.withColumn("Id", F.lit(5)))
    assert reader.read(a).count() == 2 and reader.read(b).count() == 3


def test_seeded_rows_and_mark_are_one_commit(spark, tmp_path):
    store = TargetStore(spark, str(tmp_path))
    seed(spark, TOP, spark.createDataFrame([(4, "a")], TOP.schema), store)
    seed(spark, TOP, spark.createDataFrame([(9, "b")], TOP.schema), store)
    assert [(v.rows, v.high_water) for v in store._history("Top")] == [(2, 9), (1, 4)]
    assert sorted(os.listdir(tmp_path / "_commits"))[-1].startswith(f"{2:020d}")


def test_many_writers_of_different_tables(spark, tmp_path):
    tables = [spec(f"T{i}") for i in range(6)]
    failed = []

    def write(table):
        try:
            store = TargetStore(spark, str(tmp_path))
            store.commit(table, None, "folder", 1, 0)
        except Exception as problem:  # noqa: BLE001
            failed.append(problem)

    threads = [threading.Thread(target=write, args=(t,)) for t in tables]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed and all(TargetStore(spark, str(tmp_path)).current(t.name).number == 1 for t in tables)


def test_cascade_through_a_diamond_and_a_table_that_refers_to_itself(spark, tmp_path):
    left, right = spec("Left", ("Top", "TopId")), spec("Right", ("Top", "TopId"))
    leaf = spec("Leaf", ("Left", "LeftId"), ("Right", "RightId"), ("Leaf", "LeafId"))
    specs = [TOP, left, right, leaf]
    store = TargetStore(spark, str(tmp_path))
    merge(store, TOP, spark.createDataFrame([(1, "a"), (2, "b")], TOP.schema))
    merge(store, left, spark.createDataFrame([(10, "l", 1), (11, "l", 2)], left.schema))
    merge(store, right, spark.createDataFrame([(20, "r", 1), (21, "r", 2)], right.schema))
    chain = [(30, "both", 10, 20, None), (31, "left", 10, 21, None), (32, "none", 11, 21, None), (33, "of 30", 11, 21, 30), (34, "of 33", 11, 21, 33), (35, "of 32", 11, 21, 32)]
    merge(store, leaf, spark.createDataFrame(chain, leaf.schema))
    report = delete_ids(spark, TOP, spark.createDataFrame([(1,)], "Id int"), store, specs).first().asDict()
    assert report == {"LeafRowsDeleted": 4, "RightRowsDeleted": 1, "LeftRowsDeleted": 1, "TopRowsDeleted": 1, "TopsRemaining": 1, "StillPresent": 0}
    assert [r[0] for r in contents(store, leaf)] == [32, 35]
    looped = [spec("X", ("Y", "YId")), spec("Y", ("X", "XId"))]
    with pytest.raises(ConfigurationError, match="cycle"):
        delete_ids(spark, looped[0], spark.createDataFrame([(1,)], "Id int"), store, looped)


def test_digests_are_of_bags_of_rows(spark):
    def digest(values):
        frame = spark.createDataFrame(values, "a string, b string").coalesce(1)
        return tuple(frame.agg(*digest_columns(["a", "b"])).first())

    assert digest([("x", None), ("y", "z")]) == digest([("y", "z"), ("x", None)])
    apart = [[("x", None)], [(None, "x")], [("x", "x")], [("x", None)] * 2, [("y", None)] * 2, [("", "x")]]
    assert len({digest(v) for v in apart}) == len(apart)


def test_more_rows_than_slices_hold_deal_the_table_anew(spark, store):
    assert store.slices_for(store.current("Top"), 4 * ROWS) == SLICES
    result = merge(store, TOP, rows(spark, 5 * ROWS))
    version = store.current("Top")
    assert (result.rows_inserted, result.rows_unchanged) == (4 * ROWS, ROWS) and version.slice_count > SLICES and version.rows == 5 * ROWS
    assert len(store.drop_old_versions(TOP, 1)) == 1 and store.read(TOP).count() == 5 * ROWS


def test_stores_written_table_by_table_are_still_read(spark, tmp_path):
    store = TargetStore(spark, str(tmp_path))
    folder, _ = store.write(TOP, rows(spark, 5), 5)
    os.makedirs(tmp_path / "Top" / "_commits")
    (tmp_path / "Top" / "_commits" / f"{1:020d}.json").write_text('{"number": 1, "folder": "%s", "rows": 5, "buckets": 0, "high_water": 4, "tags": {}}' % folder)
    assert store.read(TOP).count() == 5
    assert merge(store, TOP, rows(spark, 7)).rows_inserted == 2 and store.current("Top").number == 2
    assert replace(store.current("Top"), tags={}).slice_count == 1 and rewrite.BROADCAST_ROWS > 0
