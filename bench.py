"""Headline timings on the given tables; prints one JSON line.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the number of cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.options import SyncOptions  # noqa: E402
from tidemark.plans.ledger import RunLedger  # noqa: E402
from tidemark.plans.runs import run_pass  # noqa: E402
from tidemark.session import SESSION_CONF, scratch_folder  # noqa: E402
from tidemark.sources.extract import extract_run  # noqa: E402
from tidemark.sources.targets import TargetStore  # noqa: E402
from workload.queries import REGISTERED  # noqa: E402
from workload.roles import TABLES, Roles  # noqa: E402

# Operator queries, run to the last row without writing a result.
HEADLINES = [
    "scan_project",
    "mapping_counters",
    "dedup_key",
    "semi_parent_two",
    "dedup_then_parent",
    "eligible_flags",
    "merge_actions",
    "merge_counts",
    "merge_item_blob",
    "prune_child_cascade",
    "delete_ids_report",
    "integrity_orphans",
    "ledger_current",
]


def session(cpus: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tidemark-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for name, value in SESSION_CONF.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def one_percent_changed(roles: Roles) -> dict[str, DataFrame]:
    """The full extract with about every hundredth order name changed."""
    frames = roles.staged()
    rename = F.pmod(F.xxhash64("ItemID"), F.lit(100)) == 0
    items = frames["Item"]
    return {**frames, "Item": items.withColumn("Name", F.when(rename, F.lit("renamed")).otherwise(F.col("Name")))}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(cpus)
    roles = Roles(spark, folder)
    timings: dict[str, float] = {}

    for name in HEADLINES:
        drain(REGISTERED[name](spark, folder))
        timings[name] = seconds(lambda: drain(REGISTERED[name](spark, folder)))

    root = scratch_folder(spark, "bench")
    store = TargetStore(spark, f"{root}/target")
    ledger = RunLedger(spark, f"{root}/ledger")
    options = SyncOptions(stage_root=f"{root}/stage")
    read = {}

    def a_pass(name: str, run_id: str, **changes: object) -> None:
        def go() -> None:
            summary = run_pass(
                spark, TABLES, store, ledger, SyncOptions(stage_root=f"{root}/stage", run_id=run_id, **changes)
            )
            if summary.failure:
                raise summary.failure
            read[name] = sum(t.rows_read for t in summary.tables)

        timings[name] = seconds(go)

    timings["extract"] = seconds(
        lambda: extract_run(spark, TABLES, roles.staged(), options.stage_root, "run_20260101_001")
    )
    a_pass("pass_first_load", "run_20260101_001")
    a_pass("pass_no_change", "run_20260101_001", skip_completed_tables=False)
    extract_run(spark, TABLES, one_percent_changed(roles), options.stage_root, "run_20260102_001")
    a_pass("pass_one_percent_changed", "run_20260102_001")
    extract_run(spark, TABLES, roles.earlier(), options.stage_root, "run_20260103_001")
    a_pass("pass_prune", "run_20260103_001", prune_missing_rows=True)

    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "sum of headline times",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
                "cpus": int(cpus),
                "rows_per_sec": {
                    name: round(rows / timings[name]) for name, rows in read.items()
                },
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
