"""A pass over all tables of a run."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tidemark.options import SyncOptions
from tidemark.plans.ledger import RunLedger, SyncResult, results_frame
from tidemark.plans.sync import sync_table
from tidemark.sources.files import Run, resolve_run
from tidemark.sources.targets import TargetStore
from tidemark.spec import TableSpec, load_order

log = logging.getLogger(__name__)


@dataclass
class PassSummary:
    run: Run
    tables: list[SyncResult] = field(default_factory=list)
    failure: Exception | None = None
    failed_table: str | None = None

    @property
    def succeeded(self) -> bool:
        return self.failure is None

    def report(self, spark: SparkSession) -> DataFrame:
        return results_frame(spark, self.tables)


def run_pass(
    spark: SparkSession,
    specs: Sequence[TableSpec],
    store: TargetStore,
    ledger: RunLedger,
    options: SyncOptions,
) -> PassSummary:
    """Sync every table in parent-before-child order, recording each outcome.

    Tables that already succeeded for the run are skipped, and the pass stops
    at the first failure because later tables depend on what did not load.
    An interrupt is not recorded; the table stays ``Running`` and is retried.
    """
    options.validate()
    run = resolve_run(spark, options.stage_root, options.run_id, options.run_folder_prefix)
    summary = PassSummary(run)
    if options.ensure_ledger:
        ledger.ensure()
    done = ledger.succeeded_tables(run.run_id) if options.skip_completed_tables else set()

    ordered = load_order(specs)
    for spec in ordered:
        if options.skips(spec.name) or spec.name in done:
            log.info("%s is skipped for run %s.", spec.name, run.run_id)
            summary.tables.append(SyncResult(spec.name, was_skipped=True))
            continue
        ledger.mark_running(run.run_id, spec.name)
        try:
            result = sync_table(spark, spec, run, store, options, ordered)
            ledger.mark_succeeded(run.run_id, result)
            summary.tables.append(result)
        except Exception as problem:
            ledger.mark_failed(run.run_id, spec.name, str(problem))
            summary.failure = problem
            summary.failed_table = spec.name
            log.error("The pass ends at %s; a later one resumes there.", spec.name, exc_info=problem)
            return summary
    return summary
