"""The corpus pipeline: five stages from raw documents to a weighted mixture.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import leaks, lines, mixing, quality, simhash
from tidemark.llm.common import scratch, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops failing lines, and documents that the rules reject."""
    return _measured(quality.keep_good(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps repeated lines in their first document only; documents left without a word go."""
    done = lines.dedup_lines(docs).select(*[F.col(f"`{c}`") for c in docs.columns])
    return _measured(done.where(F.regexp_like("text", F.lit(r"[^\x20\x09-\x0D]"))))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies."""
    return simhash.drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    return leaks.drop_leaked(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mixture takes, with how often; those it takes no copy of go."""
    return mixing.mix(docs).where("copies > 0")


def _measured(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the text as it is now."""
    chars = F.char_length(F.coalesce("text", F.lit(""))).cast("bigint")
    return docs.withColumn("n_chars", chars) if "n_chars" in docs.columns else docs


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
]

# Fingerprints, walks and seeded samples have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    work = scratch(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{work}/{number}-{name}")
        docs = spark.read.parquet(f"{work}/{number}-{name}")
    return docs
