"""Relational sources and sinks through Spark's JDBC data source."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tidemark.options import check_no_placeholder
from tidemark.spec import TableSpec


def derived_table(table: str, columns: Sequence[str], alias: str = "t") -> str:
    """A parenthesised query with an alias, as the ``dbtable`` option takes it."""
    return f"(SELECT {', '.join(columns)} FROM {table}) AS {alias}"


@dataclass(frozen=True)
class JdbcSource:
    """Connection options plus, per table, how to split the read.

    ``partitions`` maps a table name to ``partitionColumn``, ``lowerBound``,
    ``upperBound`` and ``numPartitions``; without an entry Spark reads the
    table through one connection.
    """

    url: str
    options: Mapping[str, str] = field(default_factory=dict)
    partitions: Mapping[str, Mapping[str, object]] = field(default_factory=dict)
    fetch_size: int = 10_000

    def __post_init__(self) -> None:
        check_no_placeholder(
            url=self.url, **{f"options.{k}": str(v) for k, v in self.options.items()}
        )

    def read_options(self, query: str, table: str | None = None) -> dict[str, str]:
        merged: dict[str, object] = {"url": self.url, "dbtable": query, "fetchsize": self.fetch_size}
        merged.update(self.options)
        merged.update(self.partitions.get(table or "", {}))
        return {name: str(value) for name, value in merged.items()}

    def read(self, spark: SparkSession, query: str, table: str | None = None) -> DataFrame:
        return spark.read.format("jdbc").options(**self.read_options(query, table)).load()

    def read_table(self, spark: SparkSession, spec: TableSpec) -> DataFrame:
        query = derived_table(spec.source_table or spec.name, spec.extract_columns)
        return self.read(spark, query, spec.name)


def write_jdbc(
    df: DataFrame,
    source: JdbcSource,
    table: str,
    *,
    batch_size: int = 5_000,
    num_partitions: int | None = None,
    mode: str = "append",
) -> None:
    """Send rows to a relational table, matched by column name, in insert batches."""
    writer = (
        df.write.format("jdbc")
        .mode(mode)
        .options(**{name: str(value) for name, value in source.options.items()})
        .option("url", source.url)
        .option("dbtable", table)
        .option("batchsize", batch_size)
    )
    if num_partitions:
        writer = writer.option("numPartitions", num_partitions)
    writer.save()
