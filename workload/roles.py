"""The given tables in the roles of the item tables.

customer plays the category, part the blob, orders the item and lineitem the
item-blob link. lineitem repeats (order, line) pairs, which gives duplicate
keys; customers in debt and parts of size 1 are missing as parents, which
gives orphans. The earlier state of a table is what was there before 1998,
with some values changed since.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.options import SyncOptions
from tidemark.plans.tables import BLOB, ITEM, ITEM_BLOB, ITEM_CATEGORY

# The keys of large order tables do not fit 32 bits.
CATEGORY = ITEM_CATEGORY.with_integer_type("bigint")
PART_BLOB = BLOB.with_integer_type("bigint")
ORDER_ITEM = ITEM.with_integer_type("bigint")
LINE_BLOB = ITEM_BLOB.with_integer_type("bigint")
TABLES = (CATEGORY, PART_BLOB, ORDER_ITEM, LINE_BLOB)

DEFAULTS = SyncOptions(stage_root="/staged")
CUT_OFF = "1998-01-01"


class Roles:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    # Staged extracts: source column names, before mapping.

    def staged_categories(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").alias("Id"), F.col("c_name").alias("Name")
        )

    def staged_blobs(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("BlobId"),
            F.when(F.col("p_size") != 1, F.col("p_name")).alias("Name"),
        )

    def staged_items(self) -> DataFrame:
        status = F.col("o_orderstatus")
        return self.table("orders").select(
            F.col("o_orderkey").alias("ItemID"),
            F.col("o_custkey").alias("CategoryId"),
            F.repeat(F.col("o_orderpriority"), F.lit(10)).alias("Name"),
            F.when(status == "F", True).when(status == "P", None).otherwise(False).alias("Deleted"),
            (status != "O").alias("Active"),
        )

    def staged_links(self) -> DataFrame:
        return self.table("lineitem").select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ItemBlobId"),
            F.col("l_orderkey").alias("ItemId"),
            F.col("l_partkey").alias("BlobId"),
        )

    def staged(self) -> dict[str, DataFrame]:
        return {
            "ItemCategory": self.staged_categories(),
            "Blob": self.staged_blobs(),
            "Item": self.staged_items(),
            "ItemBlob": self.staged_links(),
        }

    # Parents as loaded.

    def loaded_categories(self) -> DataFrame:
        return (
            self.table("customer")
            .where("c_acctbal >= 0")
            .select(F.col("c_custkey").alias("Id"), F.col("c_name").alias("Descr"))
        )

    def loaded_blobs(self) -> DataFrame:
        return self.staged_blobs().where(F.col("Name").isNotNull())

    def loaded_items(self) -> DataFrame:
        return self.table("orders").where("o_orderstatus <> 'F'").select(
            F.col("o_orderkey").alias("Id"), F.col("o_custkey").alias("CategoryId")
        )

    # Earlier extracts and, from them, earlier target states.

    def earlier_categories(self) -> DataFrame:
        return (
            self.table("customer")
            .where("c_acctbal >= 0")
            .select(
                F.col("c_custkey").alias("Id"),
                F.when(F.col("c_mktsegment") == "BUILDING", F.lower("c_name"))
                .otherwise(F.col("c_name"))
                .alias("Name"),
            )
        )

    def earlier_blobs(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("BlobId"),
            F.when(F.col("p_size") == 1, None)
            .when(F.col("p_size") > 40, F.upper("p_name"))
            .otherwise(F.col("p_name"))
            .alias("Name"),
        )

    def earlier_items(self) -> DataFrame:
        return self.table("orders").where(F.col("o_orderdate") < F.lit(CUT_OFF)).select(
            F.col("o_orderkey").alias("ItemID"),
            F.col("o_custkey").alias("CategoryId"),
            F.when(F.col("o_orderpriority") == "5-LOW", None)
            .when(F.col("o_totalprice") > 250000, F.col("o_orderpriority"))
            .otherwise(F.repeat(F.col("o_orderpriority"), F.lit(10)))
            .alias("Name"),
            F.lit(False).alias("Deleted"),
            F.lit(True).alias("Active"),
        )

    def earlier_links(self) -> DataFrame:
        return self.table("lineitem").where(F.col("l_shipdate") < F.lit(CUT_OFF)).select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ItemBlobId"),
            F.col("l_orderkey").alias("ItemId"),
            F.col("l_partkey").alias("BlobId"),
        )

    def earlier(self) -> dict[str, DataFrame]:
        return {
            "ItemCategory": self.earlier_categories(),
            "Blob": self.earlier_blobs(),
            "Item": self.earlier_items(),
            "ItemBlob": self.earlier_links(),
        }

    def ledger_events(self) -> DataFrame:
        """User events read as a ledger: a day is a run, a user is a table."""
        kind = F.col("event_type")
        amount = F.floor("value").cast("bigint")
        status = F.when(kind == "purchase", "Succeeded").when(kind == "error", "Failed").otherwise("Running")
        return self.table("events").select(
            F.concat(F.lit("run_"), F.date_format("ts", "yyyyMMdd"), F.lit("_001")).alias("RunId"),
            F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("TableName"),
            status.alias("Status"),
            F.col("event_id").alias("EventSeq"),
            F.col("ts").alias("EventUtc"),
            F.lit(1).alias("FilesProcessed"),
            *[
                (amount + offset).alias(name)
                for offset, name in enumerate(
                    ["RowsRead", "RowsStaged", "RowsInserted", "RowsUpdated", "RowsFiltered",
                     "RowsRejected", "RowsDeleted", "ValuesTruncated"]
                )
            ],
            F.when(status == "Failed", F.col("props")).alias("ErrorMessage"),
        )
