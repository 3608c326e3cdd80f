"""One function per operator: (spark, folder of the given tables) -> DataFrame."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import fit_width, required, to_boolean, to_integer, to_text, too_wide
from tidemark.operators import (
    action_counters,
    after_merge,
    changes,
    classify,
    counters,
    delete_report,
    duplicate_counts,
    first_per_key,
    flag_eligible,
    high_water_check,
    high_water_mark,
    keep_with_parents,
    listed,
    map_rows,
    not_listed,
    not_staged,
    orphan_report,
    orphan_rows,
    orphan_values,
    rejected_rows,
    resolve_rows,
    row_counts,
    staged_only,
    upsert,
)
from tidemark.operators.parents import ELIGIBLE
from tidemark.options import SyncOptions
from tidemark.plans.ledger import RunLedger, current_state, pending_tables, run_report
from tidemark.plans.maintain import delete_ids, seed, verify
from tidemark.plans.runs import run_pass
from tidemark.plans.sync import eligible_source, read_outcomes
from tidemark.session import scratch_folder
from tidemark.sources.extract import capture_deleted, capture_rows, extract_run
from tidemark.sources.files import list_data_files, list_names, newest_run
from tidemark.sources.staged import read_columns, scan_folder
from tidemark.sources.targets import TargetStore
from tidemark.spec import ColumnSpec
from tidemark.streaming.incremental import incremental_sync
from workload.roles import (
    CATEGORY,
    DEFAULTS,
    LINE_BLOB,
    ORDER_ITEM,
    PART_BLOB,
    TABLES,
    Roles,
)

REGISTERED = {}


def query(function):
    REGISTERED[function.__name__] = lambda spark, folder: function(Roles(spark, folder))
    return function


# Mapped and loaded forms used by several queries.


def mapped_items(roles: Roles) -> DataFrame:
    return map_rows(roles.staged_items(), ORDER_ITEM, DEFAULTS)


def mapped_links(roles: Roles) -> DataFrame:
    return map_rows(roles.staged_links(), LINE_BLOB, DEFAULTS)


def item_target(roles: Roles) -> DataFrame:
    return map_rows(roles.earlier_items(), ORDER_ITEM, DEFAULTS)


def link_target(roles: Roles) -> DataFrame:
    return first_per_key(map_rows(roles.earlier_links(), LINE_BLOB, DEFAULTS), "ItemBlobId")


def eligible_links(roles: Roles) -> DataFrame:
    """As in a pass: distinct references are checked, so the rows are shuffled once, for the ranking."""
    mapped = mapped_links(roles)
    orphans = [
        ("ItemId", orphan_values(mapped, "ItemId", roles.loaded_items(), "Id")),
        ("BlobId", orphan_values(mapped, "BlobId", roles.loaded_blobs(), "BlobId")),
    ]
    order = [F.col(c).asc_nulls_last() for c in ("ItemId", "BlobId")]
    ranked = first_per_key(flag_eligible(mapped, orphans), "ItemBlobId", order)
    return ranked.where(ELIGIBLE).drop(ELIGIBLE)


def eligible_items(roles: Roles) -> DataFrame:
    deduplicated = first_per_key(mapped_items(roles), "Id")
    return keep_with_parents(deduplicated, [("CategoryId", roles.loaded_categories(), "Id")])


def classified_items(roles: Roles, prune: bool = False) -> DataFrame:
    """All staged items, flagged by their category, against the earlier state."""
    staged = mapped_items(roles)
    orphans = orphan_values(staged, "CategoryId", roles.loaded_categories(), "Id")
    source = eligible_source(staged, ORDER_ITEM, [("CategoryId", orphans)])
    return classify(source, item_target(roles), "Id", ORDER_ITEM.value_names, prune=prune)


# Scans and projections.


@query
def scan_project(roles):
    return read_columns(
        roles.spark, roles.path("orders"), ["O_ORDERKEY", "o_custkey", "O_OrderPriority"]
    )


@query
def alias_rename(roles):
    spec = replace(
        ORDER_ITEM, columns=(*ORDER_ITEM.columns, ColumnSpec("Note", ("Note", "Remark"), "string"))
    )
    both = roles.staged_items().withColumn("Id", F.lit(-1)).withColumnRenamed("CategoryId", "CATEGORYID")
    return map_rows(both, spec, replace(DEFAULTS, exclude_deleted_items=False))


@query
def coerce_int(roles):
    double, text = T.DoubleType(), T.StringType()
    return roles.table("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        to_integer(F.col("l_quantity") * 0.5, double, "int", "half").alias("half_quantity"),
        to_integer(
            F.col("l_quantity").cast("decimal(10,2)") * F.lit(2.5).cast("decimal(2,1)"),
            T.DecimalType(13, 3), "int", "scaled",
        ).alias("scaled_quantity"),
        to_integer(
            F.concat(F.lit(" +"), F.col("l_linenumber").cast("string"), F.lit(" ")), text, "int", "line"
        ).alias("text_line"),
        to_integer(F.col("l_returnflag") == "A", T.BooleanType(), "int", "flag").alias("is_a"),
        to_integer(F.col("l_partkey"), T.LongType(), "int", "part").alias("part"),
    )


@query
def coerce_text(roles):
    return roles.table("lineitem").select(
        "l_orderkey",
        to_text(F.col("l_partkey"), T.LongType(), "part").alias("part"),
        to_text(F.col("l_quantity"), T.DoubleType(), "quantity").alias("quantity"),
        to_text(F.col("l_extendedprice"), T.DoubleType(), "price").alias("price"),
        to_text(F.col("l_returnflag") == "A", T.BooleanType(), "flag").alias("is_a"),
        to_text(F.col("l_shipdate"), roles.table("lineitem").schema["l_shipdate"].dataType, "d").alias("shipped"),
    )


@query
def coerce_bool(roles):
    status = F.col("o_orderstatus")
    word = F.when(status == "O", " TRUE ").when(status == "F", "False")
    return roles.table("orders").select(
        "o_orderkey",
        to_boolean(word, T.StringType(), "word").alias("from_text"),
        to_boolean(F.col("o_custkey"), T.LongType(), "number").alias("from_number"),
    )


@query
def required_values(roles):
    return roles.table("orders").select(
        required(F.col("o_orderkey"), "o_orderkey").alias("Id"),
        required(F.col("o_orderpriority"), "o_orderpriority").alias("Name"),
    )


@query
def capture_categories(roles):
    return capture_rows(roles.staged_categories(), "Id", ["Name"])


@query
def capture_deleted_items(roles):
    return capture_deleted(roles.staged_items(), "ItemID", ["Name"])


# Row filters and widths.


@query
def filter_deleted(roles):
    return mapped_items(roles)


@query
def filter_inactive(roles):
    options = replace(DEFAULTS, exclude_deleted_items=False, exclude_inactive_items=True)
    return map_rows(roles.staged_items(), ORDER_ITEM, options)


@query
def map_categories(roles):
    flagged = roles.staged_categories().withColumns({"Deleted": F.lit(True), "Active": F.lit(False)})
    return map_rows(flagged, CATEGORY, DEFAULTS)


@query
def null_reject(roles):
    return map_rows(roles.staged_blobs(), PART_BLOB, DEFAULTS)


@query
def null_reject_quarantine(roles):
    return rejected_rows(resolve_rows(roles.staged_blobs(), PART_BLOB, DEFAULTS), PART_BLOB)


@query
def width_fit(roles):
    return roles.table("documents").select(
        "doc_id",
        fit_width(F.col("text"), 100).alias("text_100"),
        too_wide(F.col("text"), 50).alias("over_50"),
    )


@query
def truncation_count(roles):
    return resolve_rows(roles.staged_items(), ORDER_ITEM, DEFAULTS).agg(
        F.sum("_cut").alias("values_truncated")
    )


@query
def mapping_counters(roles):
    staged = roles.staged()
    parts = [
        resolve_rows(staged[spec.name], spec, DEFAULTS)
        .agg(*counters())
        .select(F.lit(spec.name).alias("TableName"), "*")
        for spec in TABLES
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


# Duplicates and parents.


@query
def dedup_key(roles):
    lines = roles.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return first_per_key(lines, ["l_orderkey", "l_linenumber"])


@query
def duplicate_keys(roles):
    return duplicate_counts(mapped_links(roles), "ItemBlobId")


@query
def semi_parent_one(roles):
    return keep_with_parents(
        mapped_items(roles), [("CategoryId", roles.loaded_categories(), "Id")]
    )


@query
def semi_parent_two(roles):
    return keep_with_parents(
        mapped_links(roles),
        [("ItemId", roles.loaded_items(), "Id"), ("BlobId", roles.loaded_blobs(), "BlobId")],
    )


@query
def orphan_references(roles):
    return orphan_values(mapped_links(roles), "ItemId", roles.loaded_items(), "Id")


@query
def orphan_links(roles):
    return orphan_rows(mapped_links(roles), "BlobId", roles.loaded_blobs(), "BlobId")


@query
def dedup_then_parent(roles):
    return eligible_links(roles)


@query
def eligible_flags(roles):
    staged = mapped_links(roles)
    orphans = [
        ("ItemId", orphan_values(staged, "ItemId", roles.loaded_items(), "Id")),
        ("BlobId", orphan_values(staged, "BlobId", roles.loaded_blobs(), "BlobId")),
    ]
    flagged = flag_eligible(staged, orphans)
    return first_per_key(flagged, "ItemBlobId", [F.col("ItemId"), F.col("BlobId")])


@query
def reject_count(roles):
    # Staged rows and eligible rows in one union, so that each side is one aggregate.
    staged = mapped_links(roles).agg(F.count(F.lit(1)).alias("staged"))
    eligible = eligible_links(roles).agg(F.count(F.lit(1)).alias("eligible"))
    return (
        staged.unionByName(eligible, allowMissingColumns=True)
        .agg(F.max("staged").alias("staged"), F.max("eligible").alias("eligible"))
        .withColumn("rejected", F.col("staged") - F.col("eligible"))
    )


# Merges.


@query
def merge_actions(roles):
    return classified_items(roles)


@query
def merge_prune_actions(roles):
    return classified_items(roles, prune=True)


@query
def merge_counts(roles):
    return classified_items(roles).agg(*action_counters())


@query
def merge_result(roles):
    return after_merge(classified_items(roles))


@query
def merge_changes(roles):
    return changes(eligible_items(roles), item_target(roles), "Id", ORDER_ITEM.value_names)


@query
def merge_rerun_noop(roles):
    once = after_merge(classified_items(roles))
    source = eligible_items(roles)
    return classify(source, once, "Id", ORDER_ITEM.value_names).agg(*action_counters())


@query
def merge_collation(roles):
    target = roles.loaded_categories().withColumn("Descr", F.upper("Descr"))
    source = map_rows(roles.staged_categories(), CATEGORY, DEFAULTS)
    return classify(
        source, target, "Id", ["Descr"], collations={"Descr": "UTF8_LCASE"}
    ).agg(*action_counters())


@query
def merge_item_category(roles):
    source = first_per_key(map_rows(roles.staged_categories(), CATEGORY, DEFAULTS), "Id")
    target = map_rows(roles.earlier_categories(), CATEGORY, DEFAULTS)
    return upsert(source, target, "Id", ["Descr"])


@query
def merge_blob(roles):
    source = first_per_key(map_rows(roles.staged_blobs(), PART_BLOB, DEFAULTS), "BlobId")
    target = map_rows(roles.earlier_blobs(), PART_BLOB, DEFAULTS)
    return classify(source, target, "BlobId", ["Name"])


@query
def merge_item_blob(roles):
    return classify(eligible_links(roles), link_target(roles), "ItemBlobId", ["ItemId", "BlobId"])


@query
def seed_upsert(roles):
    store = TargetStore(roles.spark, scratch_folder(roles.spark, "seed"))
    earlier = map_rows(roles.earlier_categories(), CATEGORY, DEFAULTS)
    seed(roles.spark, CATEGORY, earlier, store)
    return seed(roles.spark, CATEGORY, map_rows(roles.staged_categories(), CATEGORY, DEFAULTS), store)


@query
def high_water(roles):
    return mapped_items(roles).agg(high_water_mark("Id").alias("high_water"))


@query
def high_water_state(roles):
    # The mark of a table must not be below its highest key; before it is
    # reset after new orders, it is.
    mark = roles.table("orders").where("o_orderdate < '1998-01-01'").agg(
        high_water_mark("o_orderkey").alias("mark")
    )
    current = mark.first()["mark"]
    return high_water_check(mapped_items(roles), "Id", F.lit(current))


# Deletes.


@query
def prune_item_survivors(roles):
    return staged_only(item_target(roles), "Id", mapped_items(roles), "Id")


@query
def prune_child_cascade(roles):
    return not_staged(link_target(roles), "ItemId", mapped_items(roles), "Id")


@query
def prune_item_blob(roles):
    later = mapped_links(roles).join(
        roles.table("lineitem").where("l_shipdate >= '1996-01-01'").select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ItemBlobId")
        ),
        "ItemBlobId",
        "left_semi",
    )
    return staged_only(link_target(roles), "ItemBlobId", later, "ItemBlobId")


@query
def prune_counts(roles):
    items = not_staged(item_target(roles), "Id", mapped_items(roles), "Id").agg(
        F.count(F.lit(1)).alias("items_deleted")
    )
    links = not_staged(link_target(roles), "ItemId", mapped_items(roles), "Id").agg(
        F.count(F.lit(1)).alias("children_deleted")
    )
    return items.unionByName(links, allowMissingColumns=True).agg(
        F.max("items_deleted").alias("items_deleted"),
        F.max("children_deleted").alias("children_deleted"),
    )


def deleted_ids(roles: Roles) -> DataFrame:
    return capture_deleted(roles.staged_items(), "ItemID").withColumnRenamed("ItemID", "Id")


@query
def delete_ids_report(roles):
    return delete_report(
        item_target(roles), "Id", link_target(roles), "ItemId", deleted_ids(roles)
    )


@query
def delete_ids_survivors(roles):
    return not_listed(link_target(roles), "ItemId", deleted_ids(roles))


@query
def delete_ids_removed(roles):
    return listed(item_target(roles), "Id", deleted_ids(roles))


# Checks.


@query
def table_counts_union(roles):
    return row_counts(
        {
            "ItemCategory": roles.loaded_categories(),
            "Blob": roles.loaded_blobs(),
            "Item": roles.loaded_items(),
            "ItemBlob": link_target(roles),
        }
    )


@query
def integrity_orphans(roles):
    return orphan_report(
        TABLES,
        {
            "ItemCategory": roles.loaded_categories(),
            "Blob": roles.loaded_blobs(),
            "Item": roles.loaded_items(),
            "ItemBlob": link_target(roles),
        },
    )


# Ledger.


@query
def ledger_current(roles):
    return current_state(roles.ledger_events())


@query
def ledger_attempts(roles):
    return current_state(roles.ledger_events()).select("RunId", "TableName", "Status", "AttemptCount")


@query
def ledger_report(roles):
    return run_report(roles.ledger_events(), "run_20240115_001")


@query
def resume_pending_tables(roles):
    events = roles.ledger_events()
    return pending_tables(events, events.select("RunId", "TableName").distinct())


# Whole passes over staged files.


def staged_runs(roles: Roles, runs: dict[str, dict[str, DataFrame]]) -> str:
    root = scratch_folder(roles.spark, "pass")
    for run_id, frames in runs.items():
        extract_run(roles.spark, TABLES, frames, f"{root}/stage", run_id)
    return root


FIRST, SECOND = "run_20260101_001", "run_20260102_001"


def two_passes(roles: Roles):
    """Load the earlier extract, then sync and prune with the full one."""
    root = staged_runs(roles, {FIRST: roles.earlier(), SECOND: roles.staged()})
    store = TargetStore(roles.spark, f"{root}/target")
    ledger = RunLedger(roles.spark, f"{root}/ledger")
    options = SyncOptions(stage_root=f"{root}/stage", prune_missing_rows=True)
    summaries = [
        run_pass(roles.spark, TABLES, store, ledger, o)
        for o in (replace(options, run_id=FIRST), options)
    ]
    for summary in summaries:
        if summary.failure:
            raise summary.failure
    return store, ledger, summaries


REPORT = [
    "TableName", "RowsRead", "RowsFiltered", "RowsStaged", "RowsInserted", "RowsUpdated",
    "RowsUnchanged", "RowsRejected", "RowsDeleted", "ChildRowsDeleted", "ValuesTruncated",
]


@query
def pass_report(roles):
    _, _, (first, second) = two_passes(roles)
    reports = [
        summary.report(roles.spark).select(F.lit(run_id).alias("RunId"), *REPORT)
        for run_id, summary in ((FIRST, first), (SECOND, second))
    ]
    return reports[0].unionByName(reports[1])


@query
def pass_target_items(roles):
    store, _, _ = two_passes(roles)
    return store.read(ORDER_ITEM)


@query
def pass_target_links(roles):
    store, _, _ = two_passes(roles)
    return store.read(LINE_BLOB)


@query
def pass_ledger(roles):
    _, ledger, _ = two_passes(roles)
    return ledger.report(SECOND).drop("StartedUtc", "CompletedUtc", "FilesProcessed", "ErrorMessage")


@query
def pass_verify(roles):
    store, ledger, _ = two_passes(roles)
    checks = verify(roles.spark, TABLES, store, ledger, SECOND)
    orphans = checks["orphans"].groupBy(F.lit("orphans").alias("Check")).agg(
        F.count(F.lit(1)).alias("Value")
    )
    rows = checks["row_counts"].select(
        F.concat(F.lit("rows "), "TableName").alias("Check"), F.col("Rows").alias("Value")
    )
    marks = checks["high_water"].select(
        F.concat(F.lit("mark "), "TableName").alias("Check"), F.col("CurrentIdentity").alias("Value")
    )
    return rows.unionByName(marks).unionByName(orphans)


@query
def delete_ids_job(roles):
    root = staged_runs(roles, {FIRST: roles.earlier()})
    store = TargetStore(roles.spark, f"{root}/target")
    ledger = RunLedger(roles.spark, f"{root}/ledger")
    run_pass(roles.spark, TABLES, store, ledger, SyncOptions(stage_root=f"{root}/stage"))
    return delete_ids(roles.spark, ORDER_ITEM, deleted_ids(roles), store, TABLES)


@query
def cascade_delete_job(roles):
    """Categories go with their items, and these with their links."""
    return cascaded(roles)[1]


@query
def cascade_delete_links(roles):
    return cascaded(roles)[0].read(LINE_BLOB)


def cascaded(roles: Roles) -> tuple[TargetStore, DataFrame]:
    store, _, _ = one_pass(roles)
    doomed = roles.table("customer").where("c_mktsegment = 'MACHINERY'").select(F.col("c_custkey").alias("Id"))
    return store, delete_ids(roles.spark, CATEGORY, doomed, store, TABLES)


def one_pass(roles: Roles, slice_rows: int = 250_000) -> tuple[TargetStore, RunLedger, SyncOptions]:
    """The earlier extract, loaded."""
    root = staged_runs(roles, {FIRST: roles.earlier()})
    store = TargetStore(roles.spark, f"{root}/target", slice_rows=slice_rows)
    ledger = RunLedger(roles.spark, f"{root}/ledger")
    options = SyncOptions(stage_root=f"{root}/stage")
    loaded(run_pass(roles.spark, TABLES, store, ledger, options))
    return store, ledger, options


def loaded(summary):
    if summary.failure:
        raise summary.failure
    return summary


@query
def pass_rerun_writes(roles):
    """The same run once more, with default options: nothing changes and no data folder is added."""
    store, ledger, options = one_pass(roles)
    before = {s.name: store.current(s.name) for s in TABLES}
    folders = {s.name: len(list_names(roles.spark, f"{store.root}/{s.name}", directories=True)) for s in TABLES}
    again = loaded(run_pass(roles.spark, TABLES, store, ledger, replace(options, skip_completed_tables=False)))
    rows = []
    for t in again.tables:
        now = len(list_names(roles.spark, f"{store.root}/{t.table_name}", directories=True))
        changed = t.rows_inserted + t.rows_updated + t.rows_deleted
        same = store.current(t.table_name) == before[t.table_name]
        rows.append((t.table_name, t.rows_unchanged, changed, now - folders[t.table_name], same))
    schema = "TableName string, RowsUnchanged bigint, RowsChanged bigint, FoldersWritten bigint, SameVersion boolean"
    return roles.spark.createDataFrame(rows, schema)


def sliced_passes(roles: Roles) -> TargetStore:
    """Both extracts, synced into tables of many slices, with prune."""
    store, ledger, options = one_pass(roles, slice_rows=2_000)
    extract_run(roles.spark, TABLES, roles.staged(), options.stage_root, SECOND)
    loaded(run_pass(roles.spark, TABLES, store, ledger, replace(options, prune_missing_rows=True)))
    return store


@query
def sliced_pass_items(roles):
    return sliced_passes(roles).read(ORDER_ITEM)


@query
def sliced_pass_links(roles):
    return sliced_passes(roles).read(LINE_BLOB)


def later_pass(roles: Roles, frames: dict[str, DataFrame], **changes):
    """Another extract over the loaded one."""
    store, ledger, options = one_pass(roles)
    extract_run(roles.spark, TABLES, frames, options.stage_root, SECOND)
    return store, ledger, run_pass(roles.spark, TABLES, store, ledger, replace(options, **changes))


@query
def prune_guard_items(roles):
    """An extract in which every item is deleted stages nothing, and is not taken for a reason to prune all."""
    frames = {**roles.earlier(), "Item": roles.earlier_items().withColumn("Deleted", F.lit(True))}
    store, _, summary = later_pass(roles, frames, prune_missing_rows=True, skip_tables=frozenset({"ItemBlob"}))
    loaded(summary)
    return store.read(ORDER_ITEM)


@query
def skipped_table_rows(roles):
    """A table that the options skip keeps its rows while the others are synced."""
    store, _, summary = later_pass(roles, roles.staged(), skip_tables=frozenset({"blob"}))
    loaded(summary)
    return store.read(PART_BLOB)


@query
def stopped_pass_ledger(roles):
    """A required value that is missing fails its table, and the tables after it are not begun."""
    items = roles.staged_items().withColumn("ItemID", F.when(F.col("Active"), F.col("ItemID")))
    _, ledger, summary = later_pass(roles, {**roles.staged(), "Item": items}, exclude_deleted_items=False)
    if summary.failed_table != "Item":
        raise AssertionError(f"The pass failed at {summary.failed_table}.")
    return ledger.report(SECOND).select("TableName", "Status", "RowsRead", "RowsStaged")


@query
def pass_outcomes(roles):
    """Staged rows that the later pass left out, by table and reason."""
    store, ledger, options = one_pass(roles)
    extract_run(roles.spark, TABLES, roles.staged(), options.stage_root, SECOND)
    options = replace(options, prune_missing_rows=True, quarantine_root=f"{options.stage_root}-left-out")
    summary = loaded(run_pass(roles.spark, TABLES, store, ledger, options))
    tables = [
        read_outcomes(roles.spark, options, SECOND, spec).select(F.lit(spec.name).alias("TableName"), "Outcome", "Rows")
        for spec in TABLES
    ]
    counts = reduce(DataFrame.unionByName, tables).groupBy("TableName", "Outcome").agg(F.sum("Rows").alias("Rows"))
    told = {t.table_name: t.rows_filtered + t.rows_rejected for t in summary.tables}
    expected = roles.spark.createDataFrame(list(told.items()), "TableName string, LeftOut bigint")
    return counts.join(expected, "TableName")


@query
def extract_counts(roles):
    root = staged_runs(roles, {FIRST: roles.staged()})
    folders = {s.name: f"{root}/stage/{FIRST}/{s.folder}" for s in TABLES}
    return row_counts({name: roles.spark.read.parquet(path) for name, path in folders.items()})


@query
def staged_file_listing(roles):
    """Data files only: the bookkeeping of a write beside them is passed over."""
    root = staged_runs(roles, {FIRST: roles.staged()})
    files = list_data_files(roles.spark, f"{root}/stage/{FIRST}")
    return files.groupBy(F.element_at(F.split("path", "/"), -2).alias("folder")).agg(
        (F.min("length") > 0).alias("has_data")
    )


@query
def newest_run_rows(roles):
    root = staged_runs(roles, {FIRST: roles.earlier(), SECOND: roles.staged()})
    run = newest_run(roles.spark, f"{root}/stage")
    return read_columns(roles.spark, f"{run.path}/item", ["ItemID"]).select(
        F.lit(run.run_id).alias("run_id"), "ItemID"
    )


@query
def mixed_schema_scan(roles):
    """Orders staged in three parts that name and type their columns differently."""
    folder = scratch_folder(roles.spark, "mixed")
    items = roles.staged_items()
    parts = {
        "new": items.where("Deleted"),
        "old": items.where("Deleted is null").select(
            F.col("ItemID").cast("int").alias("id"), F.col("CategoryId").alias("CategoryID"), "Name"
        ),
        "other": items.where("not Deleted").select(
            F.col("ItemID").cast("string").alias("ITEMID"),
            F.lit(-1).alias("Id"),
            "CategoryId",
            F.col("Name").alias("NAME"),
            F.lit("no").alias("Unused"),
        ),
    }
    for name, part in parts.items():
        part.write.mode("overwrite").parquet(f"{folder}/{name}")
    options = replace(DEFAULTS, exclude_deleted_items=False)
    scan = scan_folder(roles.spark, folder, ORDER_ITEM, options)
    return map_rows(scan.frames, ORDER_ITEM, options)


@query
def stream_incremental(roles):
    """Two runs arrive one after the other, the second in two parts; the stream loads each when it is complete."""
    root = scratch_folder(roles.spark, "stream")
    store = TargetStore(roles.spark, f"{root}/target")
    options = SyncOptions(stage_root=f"{root}/stage")
    children = [spec for spec in TABLES if spec.parents]
    parents = [spec for spec in TABLES if not spec.parents]
    steps = [(FIRST, roles.earlier(), TABLES, True), (SECOND, roles.staged(), children, False), (SECOND, roles.staged(), parents, True)]
    for run_id, frames, specs, complete in steps:
        extract_run(roles.spark, specs, frames, f"{root}/stage", run_id, complete=complete)
        incremental_sync(
            roles.spark, TABLES, store, options, f"{root}/checkpoint"
        ).awaitTermination()
    return store.read(ORDER_ITEM)
