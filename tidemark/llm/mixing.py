"""Mixing sources to target weights: capped water-filling and seeded repetitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import count_words, scratch, shuffle_partitions, stored, whole

# Documents of a source are ranked in strata of about this many rows, so that no task holds a whole source.
STRATUM_ROWS = 4096
SEED = 1337


def _ranked(sources: DataFrame, path: str) -> DataFrame:
    """``rank`` by code point, null last, counted over range partitions and not in one task."""
    parts = shuffle_partitions(sources.sparkSession)
    order = F.col("source").asc_nulls_last()
    laid = stored(
        sources.repartitionByRange(parts, order).withColumn("_part", F.spark_partition_id()), f"{path}/laid"
    )
    sizes = sorted((r["_part"], r["n"]) for r in laid.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect())
    before, offset = [], 0
    for part, n in sizes:  # one entry per partition
        before.append((part, offset))
        offset += n
    spark = sources.sparkSession
    offsets = F.broadcast(spark.createDataFrame(before or [(0, 0)], "_part int, _before bigint"))
    within = F.row_number().over(Window.partitionBy("_part").orderBy(order)) - 1
    return laid.withColumn("_within", within).join(offsets, "_part").select(
        *sources.columns, (F.col("_before") + F.col("_within")).alias("rank")
    )


def water_fill(sources: DataFrame, cap: int) -> tuple[Column, Column]:
    """``capped`` and ``target`` as columns over (source_size, weight).

    Sources above their cap are clamped to it and the rest is shared again by
    weight, until no further source is above: the level only rises, so each
    round clamps at least one source. A round is one distributed sum.
    """
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    clamped, rest, weights = -1, total, 0
    above = F.lit(False)
    while True:
        n, capped_words, weights = sources.agg(
            F.coalesce(F.count_if(above), F.lit(0)),
            F.coalesce(F.sum(F.when(above, F.col("source_size") * cap)), F.lit(0)),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)),
        ).first()
        rest = total - capped_words
        if n == clamped or weights == 0:
            break
        clamped = n
        share = F.lit(float(rest)) * F.col("weight") / F.lit(float(weights))
        above = share > F.col("source_size") * cap
    open_share = F.lit(float(rest)) * F.col("weight") / F.lit(float(max(weights, 1)))
    limit = (F.col("source_size") * cap).cast("double")
    return above, F.when(above, limit).otherwise(open_share)


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3, seed: int = SEED) -> DataFrame:
    """All rows and columns, plus ``size``, ``source_size``, ``target``, ``copies`` and ``taken``.

    ``size`` is the number of words; null text has none. Sources in order of code
    point, null last, take the weights in turn. A source repeats all its documents
    ``floor(target / source_size)`` times and takes one more copy of some: within
    each stratum documents stand in the order of a seeded hash, and those up to the
    wanted number of words get it, which misses by half a document at most. Strata
    and order follow id and text together, so that rows without an id, or with one id,
    spread like others. Rows equal in both are interchangeable. Empty tables give no row; columns
    of the result's names are replaced.
    """
    new = ["size", "source_size", "target", "copies", "taken"]
    work = scratch(docs.sparkSession, "mix")
    # other columns travel under numbers, so that none of their names meets one of the steps
    kept = {c: f"_column_{i}" for i, c in enumerate(c for c in docs.columns if c not in new)}
    row = [F.col(f"`{c}`").alias(n) for c, n in kept.items()]
    text = F.xxhash64(F.isnull("doc_id"), "doc_id", whole("text"))
    sized = docs.select(*row, "source", "doc_id", text.alias("text"), count_words(whole("text")).alias("size"))
    sizes = stored(sized.select("source", "size"), f"{work}/sizes")
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_docs"))
    ranked = _ranked(sources, work)
    weight = F.lit(weights[-1])
    for i, w in enumerate(weights[:-1]):
        weight = F.when(F.col("rank") % len(weights) == i, F.lit(w)).otherwise(weight)
    weighed = stored(ranked.withColumn("weight", weight), f"{work}/sources")
    capped, target = water_fill(weighed, cap)
    passes = F.when(F.col("source_size") == 0, F.lit(0)).when(capped, F.lit(cap)).otherwise(
        F.floor(F.col("target") / F.col("source_size"))
    )
    plan = weighed.withColumn("target", target).select(
        F.col("source").alias("_source"), "source_size", "target", passes.cast("bigint").alias("_passes"), "_docs"
    ).withColumn(
        "_share",
        F.when(F.col("source_size") == 0, F.lit(0.0)).otherwise(F.col("target") / F.col("source_size") - F.col("_passes")),
    )
    joined = sized.join(plan, sized["source"].eqNullSafe(plan["_source"]))
    strata = F.ceil(F.col("_docs") / STRATUM_ROWS)
    joined = joined.withColumn("_stratum", F.pmod(F.xxhash64(F.lit(seed), F.col("text")), strata))
    group = Window.partitionBy("_source", "_stratum")
    order = group.orderBy(F.xxhash64(F.lit(seed + 1), F.col("text")), "doc_id", "text")
    seen = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
    extra = (seen - F.col("size") / 2) < F.col("_share") * F.sum("size").over(group)
    copies = (F.col("_passes") + F.when(extra, F.lit(1)).otherwise(F.lit(0))).cast("bigint")
    return joined.withColumn("copies", copies).select(
        *[F.col(n).alias(c) for c, n in kept.items()], "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def mix_digest(docs: DataFrame) -> DataFrame:
    """The columns the mixing query returns."""
    done = mix(docs.select("doc_id", "text", "source"))
    return done.select("doc_id", "source", "size", "source_size", "target", "copies", "taken")


# The sampled columns depend on Spark's hash, so SQL states the deterministic ones.
MIX_TARGET_SQL = r"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents
), s AS (
    SELECT source, sum(size)::BIGINT AS source_size, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w
    FROM sized GROUP BY source
), ordered AS (
    SELECT *, row_number() OVER (ORDER BY source_size::DOUBLE / w, source) AS r FROM s
), levels AS (
    SELECT j.r, ((SELECT sum(source_size) FROM s) - coalesce(sum(3 * i.source_size), 0))::DOUBLE AS rest,
           (SELECT sum(w) FROM s) - coalesce(sum(i.w), 0) AS open
    FROM ordered j LEFT JOIN ordered i ON i.r < j.r GROUP BY j.r
), first_open AS (
    SELECT l.rest, l.open, l.r FROM levels l JOIN ordered o USING (r) WHERE l.rest * o.w / l.open <= 3 * o.source_size ORDER BY l.r LIMIT 1
)
SELECT source, source_size, CASE WHEN o.r < f.r THEN 3.0 * source_size ELSE f.rest * w / f.open END AS target
FROM ordered o, first_open f
"""
