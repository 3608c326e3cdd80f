"""Line dedup: levelled sorted runs of line hashes, merged against each new batch.

A *run* is a table of line keys that is sorted by key and never changed. A batch
is joined against all runs; the keys that no run holds become a run of level 0.
When a level has ``fan_in`` runs they are merged into one of the next level, so
n batches leave about log(n) runs and each key is rewritten about log(n) times.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import LAST_ID, SPACE, hash_pair, let, lower_ascii, scratch, shuffle_partitions, stored, whole
from tidemark.sources.files import delete_folder, list_names

ROW = ["_row_1", "_row_2"]
KEY = ["_key_1", "_key_2"]


def text_lines(text: Column) -> Column:
    return F.split(whole(text), "\n")


def _row_key(text: Column) -> list[Column]:
    """Names a row by id and text; rows that share both share all their lines."""
    parts = hash_pair(F.isnull("doc_id"), F.col("doc_id"), whole(text))
    return [part.alias(name) for part, name in zip(parts, ROW)]


def line_keys(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """One row per line whose key is long enough: row key, owner id, position, line key."""
    lines = docs.select(
        *_row_key(F.col("text")),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST_ID)).alias("owner"),
        F.posexplode(text_lines(F.col("text"))).alias("pos", "line"),
    )
    key = lower_ascii(F.btrim("line", F.lit(SPACE)))
    lines = lines.select(*ROW, "owner", "pos", key.alias("key")).where(F.char_length("key") >= min_chars)
    return lines.select(*ROW, "owner", "pos", *[h.alias(n) for h, n in zip(hash_pair(F.col("key")), KEY)])


class LineRuns:
    """The runs below a folder; what a crash leaves half-written is ignored and written anew."""

    def __init__(self, spark: SparkSession, folder: str, fan_in: int = 4):
        if fan_in < 2:
            raise ValueError("fan_in must be at least 2.")
        self.spark, self.folder, self.fan_in = spark, folder.rstrip("/"), fan_in

    def levels(self) -> dict[int, list[str]]:
        """Complete runs by level, oldest first."""
        found: dict[int, list[str]] = {}
        for name in sorted(list_names(self.spark, self.folder, directories=True)):
            if name.startswith("run-") and "_SUCCESS" in list_names(self.spark, f"{self.folder}/{name}", directories=False):
                found.setdefault(int(name.split("-")[1]), []).append(name)
        return found

    def _read(self, names: list[str]) -> DataFrame | None:
        schema = "_key_1 bigint, _key_2 bigint, owner bigint"
        return self.spark.read.schema(schema).parquet(*[f"{self.folder}/{n}" for n in names]) if names else None

    def _write(self, keys: DataFrame, level: int) -> None:
        taken = [int(n.split("-")[2]) for names in self.levels().values() for n in names]
        name = f"run-{level:02d}-{max(taken, default=-1) + 1:06d}"
        parts = shuffle_partitions(self.spark)
        keys.repartitionByRange(parts, *KEY).sortWithinPartitions(*KEY).write.mode("overwrite").parquet(f"{self.folder}/{name}")

    def owners(self) -> DataFrame | None:
        """Each key once, with the document that keeps its lines."""
        names = [n for level in self.levels().values() for n in level]
        runs = self._read(names)
        # A merge that was cut short after its write leaves keys in two runs, with the same owner.
        return None if runs is None else runs.groupBy(*KEY).agg(F.min("owner").alias("owner"))

    def ingest(self, keys: DataFrame) -> None:
        """Add a batch (columns of ``KEY`` and owner): new keys only, the smallest owner of each."""
        fresh = keys.groupBy(*KEY).agg(F.min("owner").alias("owner"))
        for names in self.levels().values():
            for name in names:
                fresh = fresh.join(self._read([name]), KEY, "left_anti")
        self._write(fresh, 0)
        self.compact()

    def compact(self) -> None:
        for level in range(64):
            names = self.levels().get(level, [])
            if len(names) < self.fan_in:
                return
            self._write(self._read(names), level + 1)
            for name in names:
                delete_folder(self.spark, f"{self.folder}/{name}")


def dropped_lines(keys: DataFrame, owners: DataFrame) -> DataFrame:
    """Per row key the positions of the lines whose key an earlier document owns."""
    kept_by = owners.withColumnRenamed("owner", "first")
    lost = keys.join(kept_by, KEY).where(F.col("first") < F.col("owner"))
    return lost.groupBy(*ROW).agg(F.collect_set("pos").alias("_drop"))


def dedup_lines(docs: DataFrame, min_chars: int = 10, batches: int = 4, fan_in: int = 2) -> DataFrame:
    """All rows and columns, ``text`` without repeated lines, plus ``n_lines`` and ``n_dropped``.

    A key (the stripped, lower-cased line) of at least ``min_chars`` code points
    that several documents hold stays only in the one with the smallest id, there
    with all its lines. Batches are taken in order of ids, so the run that holds
    a key first names that document. Null text is one empty line. Rows that share
    an id are one document; null ids together are one document, after all others.
    An empty table gives an empty result; other columns pass through, and of those
    named ``n_lines`` or ``n_dropped`` the new ones stay.
    """
    spark = docs.sparkSession
    work = scratch(spark, "lines")
    # Approximate quantiles only balance the batches; ids decide the order.
    probabilities = [i / batches for i in range(1, batches)]
    bounds = docs.agg(F.percentile_approx(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST_ID)), probabilities, 1000)).first()[0]
    number = F.lit(0)
    for bound in sorted(set(bounds or [])):
        number = number + (F.col("owner") > bound).cast("int")
    keys = stored(line_keys(docs, min_chars).withColumn("batch", number), f"{work}/keys", "batch")
    runs = LineRuns(spark, f"{work}/runs", fan_in)
    for batch in range(len(set(bounds or [])) + 1):
        runs.ingest(keys.where(F.col("batch") == batch).select(*KEY, "owner"))
    drops = stored(dropped_lines(keys, runs.owners()), f"{work}/drops")

    kept_columns = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    # rows travel as one column, so that none of their names meets one of the steps
    row = F.struct(*[F.col(f"`{c}`") for c in kept_columns])
    rows = docs.select(row.alias("_row"), F.col("text").alias("_text"), *_row_key(F.col("text")))
    n_lines = F.size(text_lines(F.col("_text"))).cast("bigint")
    kept = let(
        text_lines(F.col("_text")),
        lambda lines: F.array_join(
            F.transform(
                F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_drop")), lambda i: F.get(lines, i)
            ),
            "\n",
        ),
    )
    joined = rows.join(drops, ROW, "left")
    return joined.select(
        *[F.when(F.col("_drop").isNull(), whole("_text")).otherwise(kept).alias(c) if c == "text" else F.col("_row").getField(c).alias(c) for c in kept_columns],
        n_lines.alias("n_lines"),
        F.coalesce(F.size("_drop"), F.lit(0)).cast("bigint").alias("n_dropped"),
    )


def line_digest(docs: DataFrame) -> DataFrame:
    """The columns the line-dedup query returns."""
    done = dedup_lines(docs.select("doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


LINE_SQL = r"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
    FROM documents
), keyed AS (
    SELECT doc_id, pos, line,
           translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
), owners AS (
    SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10 GROUP BY key
), judged AS (
    SELECT k.doc_id, k.pos, k.line, coalesce(o.first < k.doc_id, false) AS lost
    FROM keyed k LEFT JOIN owners o ON k.key = o.key AND length(k.key) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lost), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
