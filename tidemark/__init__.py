"""Keep related tables in step with staged snapshot extracts, on Spark."""

from tidemark.options import SyncOptions
from tidemark.plans.ledger import RunLedger, SyncResult
from tidemark.plans.maintain import delete_ids, seed, verify
from tidemark.plans.runs import PassSummary, run_pass
from tidemark.plans.sync import load_staging_table, sync_table
from tidemark.plans.tables import BLOB, ITEM, ITEM_BLOB, ITEM_CATEGORY, ITEM_TABLES
from tidemark.sources.extract import extract_run
from tidemark.sources.jdbc import JdbcSource
from tidemark.sources.targets import TargetStore
from tidemark.spec import ColumnSpec, FlagFilter, ParentRef, TableSpec, load_order
from tidemark.streaming.incremental import incremental_sync

__all__ = [
    "BLOB",
    "ITEM",
    "ITEM_BLOB",
    "ITEM_CATEGORY",
    "ITEM_TABLES",
    "ColumnSpec",
    "FlagFilter",
    "JdbcSource",
    "ParentRef",
    "PassSummary",
    "RunLedger",
    "SyncOptions",
    "SyncResult",
    "TableSpec",
    "TargetStore",
    "delete_ids",
    "extract_run",
    "incremental_sync",
    "load_order",
    "load_staging_table",
    "run_pass",
    "seed",
    "sync_table",
    "verify",
]
