"""Words, keys, scratch tables and other small helpers the operators share."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_folder

# White space is the six ASCII characters, words are what lies between.
SPACE = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

# What stands for a missing id where ids are compared: it comes after all others.
LAST_ID = (1 << 63) - 1


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder below the shared folder of the cluster."""
    return scratch_folder(spark, f"llm-{label}")


def stored(df: DataFrame, path: str, *partition_by: str) -> DataFrame:
    """Write a frame and read it back: later steps start from files that outlive executors."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def whole(text: Column | str) -> Column:
    """The text; a null one is empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def count_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once, however often ``body`` names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def split_words(text: Column) -> Column:
    """The words of a text that is not null."""
    return let(
        F.btrim(text, F.lit(SPACE)),
        lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, SPACE_RUN)),
    )


def hash_pair(*columns: Column) -> list[Column]:
    """Two independent 64-bit hashes, for keys that must not collide."""
    return [F.xxhash64(F.lit(17), *columns), F.xxhash64(F.lit(40_503), *columns)]
