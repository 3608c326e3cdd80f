"""Bring one target table in step with its staged extract."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.dedup import duplicate_counts, first_and_count, first_per_key
from tidemark.operators.mapping import KEEP, KEY_TEXT, REASON, kept_rows, map_rows, resolve_all
from tidemark.operators.merge import ACTION, DELETE, action_counters, after_merge, classify, stays
from tidemark.operators.parents import ELIGIBLE, flag_eligible, orphan_values
from tidemark.operators.prune import not_staged
from tidemark.options import SyncOptions
from tidemark.plans.ledger import SyncResult
from tidemark.plans.rewrite import SCRATCH_CODEC, cascade, materialise, sized, work_folder
from tidemark.sources.files import Run, folder_exists
from tidemark.sources.jdbc import JdbcSource, write_jdbc
from tidemark.sources.staged import StagedScan, scan_folder
from tidemark.sources.targets import SLICE, TargetStore, Version, digest_columns, slice_columns, slice_from, slice_of
from tidemark.spec import TableSpec, children_of

log = logging.getLogger(__name__)


# Of a row that stands for its key: how many rows the key has beyond it, and its first reference without a parent.
EXTRA_ROWS, LOST = "_extra_rows", "_lost"


def unique_source(flagged: DataFrame, spec: TableSpec) -> DataFrame:
    """The first staged row per key, in order of all its values."""
    order = [F.col(name).asc_nulls_last() for name in spec.value_names]
    return first_per_key(flagged, spec.key, order)


def eligible_source(
    staged: DataFrame, spec: TableSpec, orphans: Sequence[tuple[str, DataFrame]]
) -> DataFrame:
    """One staged row per key, flagged by whether all its parents exist.

    The surviving duplicate is chosen before its parents count: a key whose
    survivor is an orphan is lost even if another duplicate has parents.
    """
    return unique_source(flag_eligible(staged, orphans), spec)


def merge_into(
    spec: TableSpec,
    flagged: DataFrame,
    store: TargetStore,
    options: SyncOptions,
    result: SyncResult,
    prune: bool = False,
    tags: Mapping[str, object] | None = None,
    staged: DataFrame | None = None,
    decided: str | None = None,
) -> None:
    """Merge, prune and set the high-water mark of one table.

    ``flagged`` are the staged rows with their eligibility, ``staged``, if given, the same rows
    without it, which are cheaper to count; the counts go to ``result``, which holds how many
    rows are staged. A merge into slices that joins leaves in the folder ``decided``, if given,
    what happened to each key of the slices it joined, with the columns ``EXTRA_ROWS`` and ``LOST``;
    ``flagged`` must then hold ``LOST``.
    """
    previous = store.current(spec.name)
    expected = result.rows_staged + (previous.rows if previous else 0)
    count = store.slices_for(previous, expected)
    if previous is not None and previous.slice_count == count:
        seen = _merge_slices(
            spec, flagged if staged is None else staged, flagged, store, options, previous, expected, prune, tags, decided
        )
    else:
        seen = _merge_whole(spec, flagged.drop(LOST), store, options, previous, expected, count, prune, tags)
    result.rows_inserted = seen["insert"]
    result.rows_updated = seen["update"]
    result.rows_unchanged = seen["unchanged"]
    result.rows_rejected = result.rows_staged - seen["insert"] - seen["update"] - seen["unchanged"]
    result.rows_deleted = seen["delete"]


def _classified(
    spec: TableSpec, flagged: DataFrame, target: DataFrame, prune: bool, counted: bool = False
) -> DataFrame:
    carry = (EXTRA_ROWS, LOST) if counted else ()
    if counted:
        source = first_and_count(flagged.drop(ELIGIBLE), spec.key, spec.value_names, EXTRA_ROWS)
        source = source.withColumn(ELIGIBLE, F.col(LOST).isNull())
    else:
        source = unique_source(flagged, spec)
    return classify(
        source, target, spec.key, spec.value_names, prune=prune, collations=spec.collations, carry=carry
    )


def _set_mark(
    spec: TableSpec, store: TargetStore, options: SyncOptions, previous: Version | None
) -> None:
    """Set the mark of a table whose rows stay as they are."""
    if previous is None or not spec.identity or not options.reseed_identity_columns:
        return
    mark = store.highest_key(spec, previous)
    if mark != previous.high_water:
        store.commit(spec, previous, previous.folder, previous.rows, previous.buckets, mark)


def _merge_whole(
    spec: TableSpec,
    flagged: DataFrame,
    store: TargetStore,
    options: SyncOptions,
    previous: Version | None,
    expected: int,
    count: int,
    prune: bool,
    tags: Mapping[str, object] | None,
) -> Mapping[str, int]:
    """Write a table as a whole: its first load, and when it is dealt into another number of slices."""
    classified = _classified(spec, flagged, store.read_by_key(spec), prune)
    if previous is not None and options.probe_changes:
        probed = classified.agg(*action_counters()).first().asDict()
        if not probed["insert"] + probed["update"] + probed["delete"]:
            _set_mark(spec, store, options, previous)
            return probed
    observed = Observation()
    folder, buckets = store.write(
        spec, after_merge(classified.observe(observed, *action_counters())), expected, count
    )
    seen = observed.get
    if previous is not None and not seen["insert"] + seen["update"] + seen["delete"]:
        store.discard(spec, folder)
        _set_mark(spec, store, options, previous)
        return seen
    slices = store.digest(spec, folder, count)
    high_water = previous.high_water if previous else None
    if spec.identity and options.reseed_identity_columns:
        high_water = max((s.top for s in slices.values()), default=0)
    store.commit_slices(spec, previous, slices, count, folder, buckets, high_water, tags)
    return seen


def _merge_slices(
    spec: TableSpec,
    staged: DataFrame,
    flagged: DataFrame,
    store: TargetStore,
    options: SyncOptions,
    previous: Version,
    expected: int,
    prune: bool,
    tags: Mapping[str, object] | None,
    kept: str | None = None,
) -> Mapping[str, int]:
    """Read and write only slices that change.

    A slice whose staged rows have the digest of its target rows holds the same rows: its
    keys are unique in the target, so no staged key comes twice, and every row is
    unchanged. Slices with another number of rows cannot, and need no digest. The others are
    joined once, and what happens to each row is written; then slices with an insert or update
    are made from that, and of those with deletes only, the deleted keys are written.
    """
    count = previous.slice_count
    number = slice_of(spec.key, count)
    held = {r[SLICE]: r["count"] for r in staged.groupBy(number.alias(SLICE)).count().collect()}
    alike = sorted(k for k, rows in held.items() if k in previous.slices and rows == previous.slices[k].rows)

    def within(df: DataFrame, numbers: Sequence[int]) -> DataFrame:
        return df if len(numbers) == count else df.where(number.isin(numbers))

    digests = (
        within(flagged, alike).groupBy(number.alias(SLICE))
        .agg(*digest_columns(spec.column_names), F.count_if(~F.col(ELIGIBLE)).alias("ineligible"))
        .collect()
        if alike else []
    )
    same = {
        r[SLICE] for r in digests
        if not r["ineligible"] and (r["xor"], r["high"], r["low"]) == previous.slices[r[SLICE]].digest
    }
    seen = dict.fromkeys(("insert", "update", "unchanged", "keep", "reject", "delete"), 0)
    seen["unchanged"] = sum(previous.slices[k].rows for k in same)
    apart = sorted(set(held) - same | (set(previous.slices) - same if prune else set()))
    if not apart:
        _set_mark(spec, store, options, previous)
        return seen

    target = store.read_by_key(spec) if previous.buckets else store.read_version(spec, previous, apart)
    classified = _classified(spec, within(flagged, apart), target, prune, kept is not None)
    with work_folder(store.spark, store, f"{spec.name}-merge") as work:
        decided, _ = materialise(classified, kept or f"{work}/decided", SCRATCH_CODEC)
        decided = decided.select(ACTION, *spec.column_names)
        # one scan counts what happens in each slice and digests the rows it will hold
        totals = [*action_counters(), *slice_columns(spec, stays())]
        happened = {r[SLICE]: r for r in decided.groupBy(number.alias(SLICE)).agg(*totals).collect()}
        for name in seen:
            seen[name] += sum(r[name] for r in happened.values())
        touched = sorted(k for k, r in happened.items() if r["insert"] + r["update"])
        emptied = sorted(k for k, r in happened.items() if r["delete"] and k not in set(touched))
        if not touched and not emptied:
            _set_mark(spec, store, options, previous)
            return seen

        with store.transaction():
            version = previous
            if touched:
                rows = after_merge(decided if len(touched) == len(happened) else within(decided, touched))
                folder, buckets = store.write(spec, rows, expected, count)
                slices = {k: s for k, s in previous.slices.items() if k not in set(touched)}
                slices |= {k: slice_from(happened[k], folder) for k in touched}
                version = store.commit_slices(
                    spec, previous, slices, count, folder, buckets, previous.high_water, tags
                )
            if emptied:
                gone = within(decided, emptied).where(F.col(ACTION) == DELETE).drop(ACTION)
                store.delete(spec, version, gone)
                version = store.current(spec.name)
            mark = version.high_water
            if spec.identity and options.reseed_identity_columns:
                mark = store.highest_key(spec, version)
            if mark != version.high_water or (tags and not touched):
                store.commit(spec, version, version.folder, version.rows, version.buckets, mark, tags)
    return seen


def _take_counters(result: SyncResult, seen: Mapping[str, int]) -> None:
    result.rows_read = seen["rows_read"]
    result.rows_filtered = seen["rows_filtered"]
    result.rows_staged = seen["rows_staged"]
    result.values_truncated = seen["values_truncated"]


OUTCOMES = "Key string, Outcome string, Rows bigint"


def read_part(spark: SparkSession, folder: str, schema) -> DataFrame:
    """The rows of a partition folder; one that was never written holds none."""
    if not folder_exists(spark, folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(folder)


def staged_outcomes(
    staged: DataFrame, spec: TableSpec, orphans: Sequence[tuple[str, DataFrame]]
) -> DataFrame:
    """``Key, Outcome, Rows`` of the staged rows that do not reach the merge.

    The rows of a key beyond the first are counted under one outcome. A first row whose
    parents are missing is named by the first reference, in order of the spec, that finds none.
    """
    twice = duplicate_counts(staged, spec.key).select(
        F.col(spec.key).cast("string").alias("Key"),
        F.lit("duplicate").alias("Outcome"),
        F.col("extra_rows").alias("Rows"),
    )
    parents = {p.column: p.table for p in spec.parents}
    first = unique_source(staged, spec)
    outcome = F.lit(None).cast("string")
    for position, (column, values) in reversed(list(enumerate(orphans))):
        name = f"_missing_{position}"
        marked = values.select(F.col(column).alias(f"{name}_value"), F.lit(True).alias(name))
        first = first.join(marked, F.col(column).eqNullSafe(F.col(f"{name}_value")), "left")
        outcome = F.when(F.col(name), F.lit(f"no {parents[column]} for {column}")).otherwise(outcome)
    lost = first.select(
        F.col(spec.key).cast("string").alias("Key"), outcome.alias("Outcome"), F.lit(1).cast("bigint").alias("Rows")
    ).where(F.col("Outcome").isNotNull())
    return twice.unionByName(lost) if orphans else twice


def merge_outcomes(decided: DataFrame, spec: TableSpec, orphans: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """The rows of ``staged_outcomes``, from what a merge into slices left, without ranking again.

    Slices that the merge did not join hold the staged rows, each key once, and lack no parent.
    """
    parents = {p.column: p.table for p in spec.parents}
    key = F.col(spec.key).cast("string").alias("Key")
    twice = decided.where(F.col(EXTRA_ROWS) > 0).select(
        key, F.lit("duplicate").alias("Outcome"), F.col(EXTRA_ROWS).alias("Rows")
    )
    if not orphans:
        return twice
    outcome = F.lit(None).cast("string")
    for position, (column, _) in enumerate(orphans):
        named = F.lit(f"no {parents[column]} for {column}")
        outcome = F.when(F.col(LOST) == position, named).otherwise(outcome)
    lost = decided.where(F.col(LOST).isNotNull()).select(
        key, outcome.alias("Outcome"), F.lit(1).cast("bigint").alias("Rows")
    )
    return twice.unionByName(lost)


def write_outcomes(spark: SparkSession, left_out: DataFrame, mapped: str, quarantine: str) -> None:
    """What became of every staged row that is not in the target, in one folder per outcome."""
    filtered = read_part(spark, f"{mapped}/{KEEP}=false", f"{REASON} string, {KEY_TEXT} string").select(
        F.col(KEY_TEXT).alias("Key"), F.col(REASON).alias("Outcome"), F.lit(1).cast("bigint").alias("Rows")
    )
    rows = filtered.unionByName(left_out)
    rows.write.mode("overwrite").partitionBy("Outcome").parquet(quarantine)


def read_outcomes(spark: SparkSession, options: SyncOptions, run_id: str, spec: TableSpec) -> DataFrame:
    """``Key, Outcome, Rows`` of a table of a pass that kept them."""
    folder = f"{options.quarantine_root.rstrip('/')}/{run_id}/{spec.name}"
    if not folder_exists(spark, folder):
        return spark.createDataFrame([], OUTCOMES)
    return spark.read.schema(OUTCOMES).parquet(folder).select("Key", "Outcome", "Rows")


def load_scan(
    spark: SparkSession,
    spec: TableSpec,
    scan: StagedScan,
    store: TargetStore,
    options: SyncOptions,
    specs: Sequence[TableSpec],
    tags: Mapping[str, object] | None = None,
    quarantine: str | None = None,
) -> SyncResult:
    """Map, de-duplicate, check parents, merge, prune and set the high-water mark.

    The mapped rows are written once and read by every later step. That write
    has no shuffle, which keeps its counters exact when tasks are repeated,
    and it forces all value checks before the target is touched.
    """
    result = SyncResult(spec.name, files_processed=scan.file_count, warnings=list(scan.warnings))
    by_name = {s.name: s for s in specs}

    with work_folder(spark, store, spec.name) as work:
        observed = Observation()
        resolved = resolve_all(scan.frames, spec, options, observed)
        if quarantine is None:
            kept_rows(resolved, spec).write.option("compression", SCRATCH_CODEC).parquet(f"{work}/staged")
            staged = spark.read.schema(spec.schema).parquet(f"{work}/staged")
        else:
            # rows that are left out are a second output of the same scan
            dealt = resolved.select(*spec.column_names, KEEP, REASON, KEY_TEXT)
            dealt.write.option("compression", SCRATCH_CODEC).partitionBy(KEEP).parquet(f"{work}/staged")
            staged = read_part(spark, f"{work}/staged/{KEEP}=true", spec.schema)
        _take_counters(result, observed.get)

        wants_prune = options.prune_missing_rows and spec.prunable
        if result.rows_staged == 0:
            if quarantine is not None:
                write_outcomes(spark, staged_outcomes(staged, spec, []), f"{work}/staged", quarantine)
            if wants_prune:
                result.warnings.append(
                    f"{spec.name} was not pruned. Nothing was staged for it, so each of its target rows "
                    "would count as gone; stage the table again if it is not empty at its source."
                )
            _set_mark(spec, store, options, store.current(spec.name))
            return result

        orphans = []
        for position, parent in enumerate(spec.parents):
            parent_spec = by_name[parent.table]
            values, rows = materialise(
                orphan_values(
                    staged, parent.column, store.read_by_key(parent_spec), parent_spec.key
                ),
                f"{work}/orphans-{position}",
            )
            if rows:
                orphans.append((parent.column, sized(values, rows)))

        # What refers to pruned rows goes with them, and all of it becomes visible at once.
        with store.transaction():
            if wants_prune:
                doomed = {}
                for child, column in children_of(spec.name, specs):
                    if store.current(child.name) is not None:
                        references = store.read(child).select(column).distinct()
                        missing = not_staged(references, column, staged, spec.key)
                        doomed[child.name, column] = materialise(missing, f"{work}/doomed-{child.name}-{column}")
                removed = cascade(spark, store, spec, specs, doomed, work)
                result.child_rows_deleted += sum(removed.values())
            flagged = flag_eligible(staged, orphans, LOST if quarantine is not None else None)
            decided = f"{work}/decided" if quarantine is not None else None
            merge_into(spec, flagged, store, options, result, wants_prune, tags, staged, decided)
        if quarantine is not None:
            if folder_exists(spark, decided):
                kind = spec.schema[spec.key].dataType.simpleString()
                schema = f"`{spec.key}` {kind}, {EXTRA_ROWS} bigint, {LOST} int"
                left_out = merge_outcomes(spark.read.schema(schema).parquet(decided), spec, orphans)
            else:
                left_out = staged_outcomes(staged, spec, orphans)
            write_outcomes(spark, left_out, f"{work}/staged", quarantine)
    if options.keep_versions is not None:
        store.drop_old_versions(spec, options.keep_versions)
    if result.rows_deleted:
        result.warnings.append(
            f"{spec.name}: {result.rows_deleted} target row(s) had no staged counterpart and were "
            f"deleted, with {result.child_rows_deleted} row(s) that referred to them."
        )
    if result.values_truncated:
        result.warnings.append(
            f"{spec.name}: {result.values_truncated} text(s) were cut at the target's width; widen "
            "the column in the table spec to keep them whole."
        )
    if result.rows_rejected:
        result.warnings.append(
            f"{spec.name}: {result.rows_rejected} of {result.rows_staged} staged row(s) did not reach "
            "the merge, because their key came twice or a row they refer to is absent."
        )
    return result


def load_staging_table(
    spark: SparkSession,
    spec: TableSpec,
    run: Run,
    target: JdbcSource,
    table: str,
    options: SyncOptions,
) -> SyncResult:
    """Map the staged rows of a run into a relational staging table, in insert batches.

    What follows there, the merge into the table itself, is the database's work.
    """
    scan = scan_folder(spark, f"{run.path.rstrip('/')}/{options.folder_of(spec)}", spec, options)
    result = SyncResult(spec.name, files_processed=scan.file_count, warnings=list(scan.warnings))
    if scan.file_count:
        observed = Observation()
        rows = map_rows(scan.frames, spec, options, observed)
        write_jdbc(rows, target, table, batch_size=options.batch_size, mode="overwrite")
        _take_counters(result, observed.get)
    return result


def sync_table(
    spark: SparkSession,
    spec: TableSpec,
    run: Run,
    store: TargetStore,
    options: SyncOptions,
    specs: Sequence[TableSpec],
    tags: Mapping[str, object] | None = None,
) -> SyncResult:
    folder = f"{run.path.rstrip('/')}/{options.folder_of(spec)}"
    scan = scan_folder(spark, folder, spec, options)
    if scan.file_count == 0:
        return SyncResult(
            spec.name,
            warnings=[f"{spec.name} is unchanged: '{folder}' holds no data file, which the options allow."],
        )
    log.info("%s: %d file(s) to read in %s", spec.name, scan.file_count, folder)
    quarantine = options.quarantine_root and f"{options.quarantine_root.rstrip('/')}/{run.run_id}/{spec.name}"
    result = load_scan(spark, spec, scan, store, options, specs, tags, quarantine)
    for warning in result.warnings:
        log.warning(warning)
    return result
