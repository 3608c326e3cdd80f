"""Incremental sync of newly staged runs with Structured Streaming."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.errors import ConfigurationError
from tidemark.options import SyncOptions
from tidemark.plans.sync import sync_table
from tidemark.sources.files import COMPLETE_FILE, FILE_SCHEMA, Run, read_text
from tidemark.sources.targets import TargetStore
from tidemark.spec import TableSpec, load_order


def _any_case(text: str) -> str:
    """A glob that matches the text in any case."""
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in text)


def complete_run_stream(spark: SparkSession, options: SyncOptions) -> DataFrame:
    """A stream of the names of runs, each as soon as it is marked complete.

    The stream carries names only. A run is read by the same scan as in a batch
    pass, from its whole folders, so it is loaded all at once or not at all.
    """
    reader = (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("recursiveFileLookup", True)
        # Runs that were copied or restored carry old time stamps and count all the same.
        .option("maxFileAge", "36500d")
    )
    root = options.stage_root.rstrip("/")
    marks = reader.load(f"{root}/{_any_case(options.run_folder_prefix)}*/{COMPLETE_FILE}")
    return marks.select(F.element_at(F.split("path", "/"), -2).alias("run"))


def apply_batch(
    spark: SparkSession,
    runs: DataFrame,
    batch_id: int,
    specs: Sequence[TableSpec],
    store: TargetStore,
    options: SyncOptions,
    stream_id: str,
) -> None:
    """Merge the runs of one micro-batch: run by run, parents before children.

    A commit carries the stream, batch and run it came from, so a batch that
    is replayed after a failure goes on where it stopped.
    """
    mark = f"stream:{stream_id}"
    for run in sorted(r["run"] for r in runs.select("run").distinct().collect()):
        for spec in load_order(specs):
            version = store.current(spec.name)
            seen = (version.tags if version else {}).get(mark)
            if seen is None or tuple(seen) < (batch_id, run):
                place = Run(run, f"{options.stage_root.rstrip('/')}/{run}")
                sync_table(spark, spec, place, store, options, specs, tags={mark: [batch_id, run]})


def incremental_sync(
    spark: SparkSession,
    specs: Sequence[TableSpec],
    store: TargetStore,
    options: SyncOptions,
    checkpoint: str,
    *,
    name: str = "tidemark",
    interval: str | None = None,
) -> StreamingQuery:
    """Keep the target tables in step with every run that is staged.

    Without an ``interval`` all runs that are complete now are loaded and the
    query ends. Unlike a pass, which loads the newest run, this loads every
    new run, those of a batch in order of names. A run counts once its mark is
    there: ``extract_run`` sets it last, ``mark_complete`` sets it for runs that
    come from elsewhere. A run without one of the tables stops the stream, as it
    stops a pass. Pruning is left to passes over one chosen run and is refused.
    """
    options.validate()
    if options.prune_missing_rows:
        raise ConfigurationError("Pruning needs a complete snapshot and cannot run on a stream.")

    def each_batch(runs: DataFrame, batch_id: int) -> None:
        # The checkpoint names the stream: a new checkpoint starts a new count of batches.
        stream_id = json.loads(read_text(spark, f"{checkpoint.rstrip('/')}/metadata"))["id"]
        apply_batch(spark, runs, batch_id, specs, store, options, stream_id)

    writer = (
        complete_run_stream(spark, options)
        .writeStream.queryName(name)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(each_batch)
    )
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()
