import os
import shutil
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tidemark.errors import CommitConflictError, ConfigurationError, DuplicateKeyError
from tidemark.options import SyncOptions
from tidemark.plans import rewrite, runs
from tidemark.plans.ledger import FAILED, RUNNING, SUCCEEDED, RunLedger, SyncResult, current_state
from tidemark.plans.maintain import delete_ids, seed, verify
from tidemark.plans.runs import run_pass
from tidemark.plans.tables import BLOB, ITEM, ITEM_BLOB, ITEM_CATEGORY, ITEM_TABLES
from tidemark.sources.extract import extract_run
from tidemark.sources.inline import inline_ids, inline_rows
from tidemark.sources.targets import TargetStore
from tidemark.streaming.incremental import incremental_sync

RUN1, RUN2, RUN3 = "run_20260101_001", "run_20260102_001", "run_20260103_001"


def extract(categories=((1, "one"), (2, "two")), blobs=((1, "a.jpg"), (2, "b.jpg")), items=(), links=()):
    return {"ItemCategory": categories, "Blob": blobs, "Item": items, "ItemBlob": links}


SCHEMAS = {
    "ItemCategory": "Id int, Name string",
    "Blob": "BlobId int, Name string",
    "Item": "ItemID int, CategoryId int, Name string, Deleted boolean, Active boolean",
    "ItemBlob": "ItemBlobId int, ItemId int, BlobId int",
}


class World:
    def __init__(self, spark, root, bucket_rows):
        self.spark = spark
        self.root = str(root)
        self.store = TargetStore(spark, f"{root}/target", bucket_rows)
        self.ledger = RunLedger(spark, f"{root}/ledger")
        self.options = SyncOptions(stage_root=f"{root}/stage")

    def stage(self, run_id, tables):
        frames = {
            n: self.spark.createDataFrame(list(r), SCHEMAS[n]).coalesce(1) for n, r in tables.items()
        }
        extract_run(self.spark, ITEM_TABLES, frames, self.options.stage_root, run_id)

    def run(self, only=None, **changes):
        if only is not None:
            changes["skip_tables"] = frozenset(s.name for s in ITEM_TABLES) - set(only)
        summary = run_pass(self.spark, ITEM_TABLES, self.store, self.ledger, replace(self.options, **changes))
        if summary.failure and not changes.get("may_fail"):
            raise summary.failure
        return {t.table_name: t for t in summary.tables}

    def rows(self, spec):
        return sorted(tuple(r) for r in self.store.read(spec).collect())

    def state(self):
        return {(r["RunId"], r["TableName"]): r for r in self.ledger.state().collect()}


@pytest.fixture(autouse=True)
def interpreted(spark):
    """These tables hold a few rows: compiling code would take most of the time."""
    settings = {"spark.sql.codegen.wholeStage": "false", "spark.sql.codegen.factoryMode": "NO_CODEGEN"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name in settings:
        spark.conf.unset(name)


ITEMS = [(1, 1, "a", False, True), (2, 2, "b", None, False), (3, 1, None, False, True), (4, 1, "gone", True, True)]
LINKS = [(10, 1, 1), (11, 2, 2), (12, 3, 1), (13, 4, 1), (14, 1, 9)]


@pytest.fixture
def world(spark, tmp_path):
    """Nothing staged, nothing loaded."""
    return World(spark, tmp_path, 10**9)


@pytest.fixture(scope="module")
def first_passes(spark, tmp_path_factory):
    """One run staged and loaded, with and without buckets; copied for each test."""
    roots = {}
    for bucket_rows in (0, 10**9):
        root = tmp_path_factory.mktemp("loaded")
        start = World(spark, root, bucket_rows)
        start.stage(RUN1, extract(items=ITEMS, links=LINKS))
        start.run()
        roots[bucket_rows] = root
    return roots


def copied(spark, roots, tmp_path, bucket_rows):
    shutil.copytree(roots[bucket_rows], tmp_path / "copy")
    return World(spark, tmp_path / "copy", bucket_rows)


@pytest.fixture
def loaded(spark, first_passes, tmp_path):
    return copied(spark, first_passes, tmp_path, 10**9)


@pytest.fixture(params=[0, 10**9], ids=["bucketed", "plain"])
def each_loaded(request, spark, first_passes, tmp_path):
    return copied(spark, first_passes, tmp_path, request.param)


def test_first_load_counts(world):
    world.stage(RUN1, extract(items=[*ITEMS, (1, 1, "dup", False, True), (5, 7, "x" * 150, False, True)], links=LINKS))
    done = world.run()
    item, link = done["Item"], done["ItemBlob"]
    assert (item.rows_read, item.rows_filtered, item.rows_staged) == (6, 1, 5)
    assert (item.rows_inserted, item.rows_rejected, item.values_truncated) == (3, 2, 1)
    # Items 4 and blob 9 are missing.
    assert (link.rows_inserted, link.rows_rejected) == (3, 2)
    assert world.rows(ITEM_BLOB) == [(10, 1, 1), (11, 2, 2), (12, 3, 1)]
    assert [r[0] for r in world.rows(ITEM)] == [1, 2, 3]
    assert world.store.current("Item").high_water == 3
    assert world.store.current("Blob").high_water is None
    assert not os.path.exists(f"{world.root}/target/_work") or os.listdir(f"{world.root}/target/_work") == []


def test_rerun_changes_nothing_and_writes_nothing(each_loaded):
    before = {s.name: each_loaded.store.current(s.name) for s in ITEM_TABLES}
    assert all(t.was_skipped for t in each_loaded.run().values())
    for probe in (False, True):
        again = each_loaded.run(["Item", "ItemBlob"], skip_completed_tables=False, probe_changes=probe)
        assert all(t.rows_inserted == t.rows_updated == t.rows_deleted == 0 for t in again.values())
        assert again["Item"].rows_unchanged == 3
    assert {s.name: each_loaded.store.current(s.name) for s in ITEM_TABLES} == before
    assert each_loaded.state()[(RUN1, "Item")]["AttemptCount"] == 3


def test_later_run_updates_inserts_and_keeps(each_loaded):
    # Category 1 is only in the target now; it still counts as a parent.
    each_loaded.stage(RUN2, extract(categories=[(3, "three")], items=[(1, 1, "A", False, True), (6, 3, "f", False, True), (3, 1, None, False, True)]))
    done = each_loaded.run(["ItemCategory", "Item", "ItemBlob"])
    assert done["ItemCategory"].rows_inserted == 1
    item = done["Item"]
    assert (item.rows_inserted, item.rows_updated, item.rows_unchanged, item.rows_rejected) == (1, 1, 1, 0)
    assert [r[:1] + r[2:] for r in sorted(each_loaded.rows(ITEM), key=str)] == [(1, "A"), (2, "b"), (3, None), (6, "f")]
    assert done["ItemBlob"].rows_staged == 0
    assert each_loaded.store.current("Item").high_water == 6


@pytest.mark.parametrize("bucket_rows, few", [(0, True), (0, False), (10**9, True)])
def test_prune_cascades_and_lowers_the_mark(spark, first_passes, tmp_path, monkeypatch, bucket_rows, few):
    if not few:
        monkeypatch.setattr(rewrite, "BROADCAST_ROWS", -1)
    loaded = copied(spark, first_passes, tmp_path, bucket_rows)
    assert loaded.store.current("Item").high_water == 3
    # Item 2 is staged but an orphan now; item 3 is gone, though its link is still staged.
    loaded.stage(RUN2, extract(items=[(1, 1, "a", False, True), (2, 77, "held", False, True)], links=[(10, 1, 1), (12, 3, 1)]))
    done = loaded.run(["Item", "ItemBlob"], prune_missing_rows=True)
    item, link = done["Item"], done["ItemBlob"]
    assert (item.rows_deleted, item.child_rows_deleted, item.rows_rejected) == (1, 1, 1)
    assert loaded.rows(ITEM) == [(1, 1, "a"), (2, 2, "b")]
    assert loaded.store.current("Item").high_water == 2
    assert (link.rows_rejected, link.rows_unchanged, link.rows_deleted) == (1, 1, 1)
    assert loaded.rows(ITEM_BLOB) == [(10, 1, 1)]
    assert loaded.store.current("ItemBlob").rows == 1


def test_prune_deletes_links_and_leaves_other_tables(loaded):
    loaded.stage(RUN2, extract(categories=[(1, "one")], blobs=[(2, "b.jpg")], items=ITEMS, links=[(11, 2, 2)]))
    done = loaded.run(prune_missing_rows=True)
    assert done["ItemBlob"].rows_deleted == 2 and loaded.rows(ITEM_BLOB) == [(11, 2, 2)]
    assert done["Blob"].rows_deleted == 0 and len(loaded.rows(BLOB)) == 2
    assert len(loaded.rows(ITEM_CATEGORY)) == 2


def test_prune_is_skipped_when_nothing_is_staged(loaded):
    loaded.stage(RUN2, extract(items=[(4, 1, "gone", True, True)], links=[]))
    done = loaded.run(["Item", "ItemBlob"], prune_missing_rows=True)
    assert done["Item"].rows_deleted == 0 and len(loaded.rows(ITEM)) == 3
    assert any("was not pruned" in w for w in done["Item"].warnings)
    assert any("was not pruned" in w for w in done["ItemBlob"].warnings)


def test_reseed_option(loaded):
    loaded.stage(RUN2, extract(items=[(8, 1, "x", False, True)]))
    loaded.run(["Item"], reseed_identity_columns=False)
    assert loaded.store.current("Item").high_water == 3
    # A pass that changes nothing, and one that has nothing to merge, still set the mark.
    loaded.run(["Item"], skip_completed_tables=False)
    assert loaded.store.current("Item").high_water == 8
    version = loaded.store.current("Item")
    loaded.store.commit(ITEM, version, version.folder, version.rows, version.buckets, 1)
    loaded.stage(RUN3, extract(items=[(4, 1, "x", True, True)]))
    loaded.run(["Item"])
    assert loaded.store.current("Item").high_water == 8


def test_failure_stops_the_pass_and_the_next_resumes(world):
    world.stage(RUN1, extract(items=[(None, 1, "no key", False, True)], links=LINKS))
    summary = run_pass(world.spark, ITEM_TABLES, world.store, world.ledger, world.options)
    assert summary.failed_table == "Item" and not summary.succeeded
    state = world.state()
    assert [state[(RUN1, n)]["Status"] for n in ("ItemCategory", "Blob", "Item")] == [SUCCEEDED, SUCCEEDED, FAILED]
    assert (RUN1, "ItemBlob") not in state
    assert "NOT NULL" in state[(RUN1, "Item")]["ErrorMessage"]
    assert world.store.current("Item") is None
    world.stage(RUN1, extract(items=ITEMS, links=LINKS))
    done = world.run()
    assert [done[s.name].was_skipped for s in ITEM_TABLES] == [True, True, False, False]
    row = world.state()[(RUN1, "Item")]
    assert (row["Status"], row["AttemptCount"], row["ErrorMessage"], row["RowsStaged"]) == (SUCCEEDED, 2, None, 3)


def test_interrupt_leaves_the_table_running(world, monkeypatch):
    world.stage(RUN1, extract())

    def stop(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(runs, "sync_table", stop)
    with pytest.raises(KeyboardInterrupt):
        world.run()
    assert world.state()[(RUN1, "ItemCategory")]["Status"] == RUNNING


def test_skip_tables_leave_no_trace(world):
    world.stage(RUN1, extract(items=ITEMS))
    seed(world.spark, ITEM_CATEGORY, inline_rows(world.spark, ITEM_CATEGORY, [(1, "seeded")]), world.store)
    done = world.run(skip_tables=frozenset({"ITEMCATEGORY"}))
    assert done["ItemCategory"].was_skipped and (RUN1, "ItemCategory") not in world.state()
    assert world.rows(ITEM_CATEGORY) == [(1, "seeded")]
    assert done["Item"].rows_rejected == 1


def test_empty_folder_policy(world):
    world.stage(RUN1, extract(items=ITEMS))
    os.makedirs(f"{world.root}/stage/{RUN2}")
    for name in ("itemcategory", "blob", "item", "itemblob"):
        os.makedirs(f"{world.root}/stage/{RUN2}/{name}")
    world.run(run_id=RUN1)
    summary = run_pass(world.spark, ITEM_TABLES, world.store, world.ledger, world.options)
    assert summary.failed_table == "ItemCategory"
    done = world.run(allow_empty_source_folders=True, prune_missing_rows=True)
    assert all(t.rows_read == t.files_processed == 0 and t.warnings for t in done.values())
    assert len(world.rows(ITEM)) == 3
    assert all(t.was_skipped for t in world.run().values())


def test_bucketed_target_is_not_shuffled(spark, first_passes, tmp_path):
    world = copied(spark, first_passes, tmp_path, 0)
    from tidemark.operators import classify, first_per_key

    assert world.store.current("Item").buckets == 2
    source = first_per_key(spark.createDataFrame([(1, 1, "n")], ITEM.schema), "Id")
    joined = classify(source, world.store.read_by_key(ITEM), "Id", ITEM.value_names)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    assert sorted(tuple(r) for r in joined.drop("_action").collect())[0] == (1, 1, "n")
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith("tidemark_")] == []


def test_commit_conflict_and_old_versions(spark, tmp_path):
    store = TargetStore(spark, str(tmp_path))
    df = spark.createDataFrame([(1, "a")], ITEM_CATEGORY.schema)
    assert store.current("ItemCategory") is None and store.read(ITEM_CATEGORY).count() == 0
    first = store.commit(ITEM_CATEGORY, None, store.write(ITEM_CATEGORY, df, 1)[0], 1, 0, 1)
    with pytest.raises(CommitConflictError):
        store.commit(ITEM_CATEGORY, None, "version-other", 1, 0)
    version = first
    for _ in range(3):
        version = store.commit(ITEM_CATEGORY, version, store.write(ITEM_CATEGORY, df, 1)[0], 1, 0)
    assert version.number == 4 and len(store.drop_old_versions(ITEM_CATEGORY, 2)) == 2
    assert store.read(ITEM_CATEGORY).count() == 1
    in_flight, _ = store.write(ITEM_CATEGORY, df, 1)
    assert store.drop_old_versions(ITEM_CATEGORY, 2) == []
    (tmp_path / "ItemCategory" / "_commits" / "half-written.json").write_text("")
    version = store.commit(ITEM_CATEGORY, store.current("ItemCategory"), in_flight, 1, 0)
    assert version.number == 5 and store.read(ITEM_CATEGORY).count() == 1


def test_work_tables_use_the_clusters_shared_folder(spark, tmp_path, monkeypatch):
    store = TargetStore(spark, str(tmp_path / "t"))
    monkeypatch.setattr(rewrite, "shared_folder", lambda _: None)
    with rewrite.work_folder(spark, store, "x") as folder:
        assert folder.startswith(f"{tmp_path}/t/_work/")
    monkeypatch.setattr(rewrite, "shared_folder", lambda _: "/shared/checkpoints/")
    with rewrite.work_folder(spark, store, "x") as folder:
        assert folder.startswith("/shared/checkpoints/tidemark-x-")


def test_seed(world):
    spark, store = world.spark, world.store
    listed = seed(spark, ITEM_CATEGORY, inline_rows(spark, ITEM_CATEGORY, [(3, "c"), (1, "a"), (7, None)]), store)
    assert [tuple(r) for r in listed.collect()] == [(1, "a"), (3, "c"), (7, None)]
    assert store.current("ItemCategory").high_water == 7
    again = seed(spark, ITEM_CATEGORY, inline_rows(spark, ITEM_CATEGORY, [(3, "C"), (4, "d")]), store)
    assert [tuple(r) for r in again.collect()] == [(1, "a"), (3, "C"), (4, "d"), (7, None)]
    version = store.current("ItemCategory")
    seed(spark, ITEM_CATEGORY, inline_rows(spark, ITEM_CATEGORY, [(3, "C")]), store)
    assert store.current("ItemCategory") == version
    twice = spark.createDataFrame([(1, "a"), (1, "b")], ITEM_CATEGORY.schema)
    with pytest.raises(DuplicateKeyError):
        seed(spark, ITEM_CATEGORY, twice, store)
    with pytest.raises(Exception, match="too wide"):
        seed(spark, ITEM_CATEGORY, spark.createDataFrame([(1, "a" * 101)], ITEM_CATEGORY.schema), store)
    with pytest.raises(ConfigurationError):
        seed(spark, ITEM, spark.createDataFrame([], ITEM.schema), store)


def test_delete_ids(loaded):
    report = delete_ids(loaded.spark, ITEM, inline_ids(loaded.spark, ITEM, [1, 2, 99]), loaded.store, ITEM_TABLES)
    assert report.first().asDict() == {
        "ItemBlobRowsDeleted": 2, "ItemRowsDeleted": 2, "ItemsRemaining": 1, "StillPresent": 0,
    }
    assert [r[0] for r in loaded.rows(ITEM)] == [3] and [r[0] for r in loaded.rows(ITEM_BLOB)] == [12]
    again = delete_ids(loaded.spark, ITEM, inline_ids(loaded.spark, ITEM, [1, 2, 99]), loaded.store, ITEM_TABLES)
    assert again.first()["ItemRowsDeleted"] == 0
    # A deleted row comes back with the next pass, as it is still staged.
    loaded.run(["Item"], skip_completed_tables=False)
    assert len(loaded.rows(ITEM)) == 3
    with pytest.raises(DuplicateKeyError):
        delete_ids(loaded.spark, ITEM, loaded.spark.createDataFrame([(1,), (1,)], "Id int"), loaded.store, ITEM_TABLES)
    # A category takes its items with it, and they their links.
    deep = delete_ids(loaded.spark, ITEM_CATEGORY, inline_ids(loaded.spark, ITEM_CATEGORY, [1]), loaded.store, ITEM_TABLES)
    assert deep.first().asDict() == {
        "ItemBlobRowsDeleted": 1, "ItemRowsDeleted": 2, "ItemCategoryRowsDeleted": 1, "ItemCategorysRemaining": 1, "StillPresent": 0,
    }
    assert loaded.rows(ITEM) == [(2, 2, "b")] and loaded.rows(ITEM_BLOB) == [] and loaded.rows(ITEM_CATEGORY) == [(2, "two")]


def test_verify(loaded):
    checks = verify(loaded.spark, ITEM_TABLES, loaded.store, loaded.ledger, RUN1)
    assert [r["TableName"] for r in checks["ledger"].collect()] == [s.name for s in ITEM_TABLES]
    assert {tuple(r) for r in checks["row_counts"].collect()} == {("ItemCategory", 2), ("Blob", 2), ("Item", 3), ("ItemBlob", 3)}
    assert checks["orphans"].isEmpty()
    assert {tuple(r) for r in checks["high_water"].collect()} == {("ItemCategory", 2, 2, True), ("Item", 3, 3, True)}
    assert {tuple(r) for r in loaded.store.high_waters(list(ITEM_TABLES)).collect()} == {("ItemCategory", 2), ("Item", 3)}


def test_ledger_transitions(spark, tmp_path):
    ledger = RunLedger(spark, str(tmp_path / "ledger"))
    assert not ledger.has_succeeded("r", "Item")
    ledger.ensure()
    ledger.ensure()
    ledger.mark_failed("r", "Ghost", "no attempt was made")
    ledger.mark_running("r", "Item")
    row = ledger.state().first()
    assert (row["Status"], row["AttemptCount"], row["CompletedUtc"], row["RowsRead"]) == (RUNNING, 1, None, None)
    assert row["StartedUtc"].microsecond % 1000 == 0
    ledger.mark_succeeded("r", SyncResult("Item", files_processed=2, rows_read=10, rows_staged=9, values_truncated=1))
    assert ledger.has_succeeded("r", "Item") and not ledger.has_succeeded("other", "Item")
    row = ledger.state().first()
    assert (row["FilesProcessed"], row["RowsRead"], row["ValuesTruncated"]) == (2, 10, 1) and row["CompletedUtc"]
    ledger.mark_running("r", "Item")
    row = ledger.state().first()
    assert (row["Status"], row["AttemptCount"], row["CompletedUtc"], row["RowsRead"]) == (RUNNING, 2, None, 10)
    ledger.mark_failed("r", "Item", "broken")
    row = ledger.state().first()
    # A failure keeps the counters of the earlier success.
    assert (row["Status"], row["ErrorMessage"], row["RowsRead"], row["RowsStaged"]) == (FAILED, "broken", 10, 9)
    assert not ledger.has_succeeded("r", "Item")
    ledger.mark_running("r", "Item")
    assert ledger.state().first()["ErrorMessage"] is None
    assert ledger.report("r").count() == 1


def test_ledger_reads_files_of_an_earlier_shape(spark, tmp_path):
    path = str(tmp_path / "ledger")
    ledger = RunLedger(spark, path)
    ledger.mark_running("r", "Item")
    ledger.mark_succeeded("r", SyncResult("Item", rows_read=1))
    old = ledger.events().drop("ValuesTruncated", "RowsDeleted").withColumn("RunId", F.lit("20250101"))
    old.write.mode("append").partitionBy("RunId").parquet(path)
    state = {r["RunId"]: r for r in ledger.state().collect()}
    assert state["20250101"]["RowsRead"] == 1 and state["20250101"]["ValuesTruncated"] is None
    assert state["r"]["ValuesTruncated"] == 0
    assert current_state(ledger.events()).columns[:4] == ["RunId", "TableName", "Status", "AttemptCount"]


def test_stream_loads_each_new_run_once(world):
    folder = "first"

    def drain():
        query = incremental_sync(world.spark, ITEM_TABLES, world.store, world.options, f"{world.root}/{folder}")
        query.awaitTermination()
        return {s.name: world.store.current(s.name).number for s in ITEM_TABLES if world.store.current(s.name)}

    world.stage(RUN1, extract(items=ITEMS, links=LINKS))
    world.stage(RUN2, extract(items=[(1, 2, "later", False, True), (7, 1, "g", False, True)], links=[(20, 7, 2)]))
    os.makedirs(f"{world.root}/stage/scratch/item")
    first = drain()
    assert world.rows(ITEM_BLOB) == [(10, 1, 1), (11, 2, 2), (12, 3, 1), (20, 7, 2)]
    assert {r[0]: r[2] for r in world.rows(ITEM)} == {1: "later", 2: "b", 3: None, 7: "g"}
    assert drain() == first
    # A new checkpoint starts its batches at 0 again and must not be taken for a replay.
    tags = world.store.current("Item").tags
    assert len(tags) == 1 and list(tags.values()) == [[0, RUN2]]
    folder = "second"
    world.stage(RUN3, extract(items=[(2, 1, "third", False, True)]))
    drain()
    assert {r[0]: r[2] for r in world.rows(ITEM)} == {1: "later", 2: "third", 3: None, 7: "g"}
    assert len(world.store.current("Item").tags) == 2
    with pytest.raises(ConfigurationError, match="snapshot"):
        incremental_sync(world.spark, ITEM_TABLES, world.store, replace(world.options, prune_missing_rows=True), "/c")


def test_stream_batch_is_idempotent(world):
    from tidemark.streaming.incremental import apply_batch

    world.stage(RUN1, extract(items=ITEMS, links=LINKS))
    runs = world.spark.createDataFrame([(RUN1,)], "run string")
    for _ in range(2):
        apply_batch(world.spark, runs, 0, ITEM_TABLES, world.store, world.options, "s")
        assert [world.store.current(s.name).number for s in ITEM_TABLES] == [1, 1, 1, 1]
    assert world.store.current("Item").tags == {"stream:s": [0, RUN1]}


def test_stream_waits_for_the_end_of_a_run(world):
    """Links are staged before their items; none of them is lost."""
    from tidemark.sources.extract import mark_complete

    def drain():
        incremental_sync(world.spark, ITEM_TABLES, world.store, world.options, f"{world.root}/checkpoint").awaitTermination()

    frames = {n: world.spark.createDataFrame(list(r), SCHEMAS[n]) for n, r in extract(items=ITEMS, links=LINKS).items()}
    stage = world.options.stage_root
    extract_run(world.spark, [ITEM_BLOB], frames, stage, RUN1, complete=False)
    drain()
    assert world.store.current("ItemBlob") is None
    extract_run(world.spark, [s for s in ITEM_TABLES if s is not ITEM_BLOB], frames, stage, RUN1, complete=False)
    drain()
    assert world.store.current("Item") is None
    mark_complete(world.spark, stage, RUN1)
    # A run that was restored from elsewhere: its files are years old.
    os.utime(f"{stage}/{RUN1}/run.complete", (1_500_000_000, 1_500_000_000))
    drain()
    assert world.rows(ITEM_BLOB) == [(10, 1, 1), (11, 2, 2), (12, 3, 1)]


def test_relational_staging_gets_the_mapped_rows(loaded, monkeypatch):
    from tidemark.plans import sync
    from tidemark.sources.files import newest_run
    from tidemark.sources.jdbc import JdbcSource

    sent = {}

    def capture(df, source, table, **options):
        sent.update(options, table=table, rows=sorted(tuple(r) for r in df.collect()))

    monkeypatch.setattr(sync, "write_jdbc", capture)
    result = sync.load_staging_table(
        loaded.spark, ITEM, newest_run(loaded.spark, loaded.options.stage_root),
        JdbcSource("jdbc:x://host/db"), "stage_Item", replace(loaded.options, batch_size=100),
    )
    assert sent == {"table": "stage_Item", "batch_size": 100, "mode": "overwrite", "rows": [(1, 1, "a"), (2, 2, "b"), (3, 1, None)]}
    assert (result.rows_read, result.rows_staged, result.rows_filtered) == (4, 3, 1)
