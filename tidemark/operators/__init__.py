from tidemark.operators.checks import high_water_check, high_water_mark, orphan_report, row_counts
from tidemark.operators.columns import find_column, flag_warnings, has_column, require_column
from tidemark.operators.dedup import duplicate_counts, first_and_count, first_per_key, require_unique
from tidemark.operators.mapping import counters, kept_rows, map_rows, rejected_rows, resolve_rows
from tidemark.operators.merge import action_counters, after_merge, changes, classify, upsert
from tidemark.operators.parents import (
    flag_eligible,
    keep_with_parents,
    orphan_rows,
    orphan_values,
)
from tidemark.operators.prune import delete_report, listed, not_listed, not_staged, staged_only

__all__ = [
    "action_counters",
    "after_merge",
    "changes",
    "classify",
    "counters",
    "delete_report",
    "duplicate_counts",
    "find_column",
    "first_and_count",
    "first_per_key",
    "flag_eligible",
    "flag_warnings",
    "has_column",
    "high_water_check",
    "high_water_mark",
    "keep_with_parents",
    "kept_rows",
    "listed",
    "map_rows",
    "not_listed",
    "not_staged",
    "orphan_report",
    "orphan_rows",
    "orphan_values",
    "rejected_rows",
    "require_column",
    "require_unique",
    "resolve_rows",
    "row_counts",
    "staged_only",
    "upsert",
]
