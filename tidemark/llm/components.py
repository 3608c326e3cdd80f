"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.shiftright(F.xxhash64("v", "u"), 20))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where(F.col("u") != F.col("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, work: str, max_rounds: int = 100) -> DataFrame:
    """``u, v``: each vertex that is not the smallest of its component, with the smallest.

    ``edges`` has bigint ``u`` and ``v``. Every round is two joins whose result is
    written, so no lineage grows. Rounds grow with the logarithm of the size.
    """
    current = stored(_small_star(edges), f"{work}/stars-0")
    seen = _digest(current)
    for round_ in range(1, max_rounds + 1):
        if seen[0] == 0:
            return current
        current = stored(_small_star(_large_star(current)), f"{work}/stars-{round_}")
        now = _digest(current)
        if now == seen:
            return current
        seen = now
    raise RuntimeError(f"The components did not settle within {max_rounds} rounds.")
