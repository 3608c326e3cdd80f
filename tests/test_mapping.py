from dataclasses import replace

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tidemark.errors import MappingError
from tidemark.operators import counters, find_column, flag_warnings, has_column, map_rows, require_column, resolve_rows
from tidemark.options import SyncOptions
from tidemark.plans.tables import BLOB, ITEM, ITEM_BLOB, ITEM_CATEGORY, ITEM_TABLES
from tidemark.spec import ColumnSpec

OPTIONS = SyncOptions(stage_root="/stage")
ITEM_SCHEMA = "ItemID int, CategoryId int, Name string, Deleted boolean, Active boolean"


def items(spark, *rows):
    return spark.createDataFrame(list(rows), ITEM_SCHEMA)


def mapped(df, spec=ITEM, options=OPTIONS):
    rows = [tuple(r) for r in map_rows(df, spec, options).collect()]
    seen = resolve_rows(df, spec, options).agg(*counters()).first()
    assert seen["rows_read"] == seen["rows_staged"] + seen["rows_filtered"]
    assert seen["rows_staged"] == len(rows)
    return rows, seen["rows_filtered"], seen["values_truncated"]


def test_item_is_mapped(spark):
    assert mapped(items(spark, (3001, 12, "Green Tea", False, True))) == ([(3001, 12, "Green Tea")], 0, 0)


def test_long_item_name_is_cut_and_counted(spark):
    rows, _, cut = mapped(items(spark, (1, 1, "x" * 200, False, True)))
    assert len(rows[0][2]) == 100 and cut == 1
    assert mapped(items(spark, (1, 1, "Black Tea", False, True))) == ([(1, 1, "Black Tea")], 0, 0)
    assert mapped(items(spark, (1, 1, "y" * 100, False, True)))[2] == 0


def test_null_item_name_is_kept(spark):
    assert mapped(items(spark, (1, 1, None, None, None))) == ([(1, 1, None)], 0, 0)


def test_deleted_rows_follow_the_option(spark):
    df = items(spark, (1, 1, "x" * 200, True, True), (2, 1, "b", None, True), (3, 1, "c", False, True))
    assert mapped(df) == ([(2, 1, "b"), (3, 1, "c")], 1, 0)
    rows, dropped, cut = mapped(df, options=replace(OPTIONS, exclude_deleted_items=False))
    assert [r[0] for r in rows] == [1, 2, 3] and dropped == 0 and cut == 1


def test_inactive_rows_follow_the_option(spark):
    df = items(spark, (1, 1, "a", False, False), (2, 1, "b", False, None))
    assert len(mapped(df)[0]) == 2
    assert mapped(df, options=replace(OPTIONS, exclude_inactive_items=True)) == ([(2, 1, "b")], 1, 0)


def test_deleted_row_may_hold_anything(spark):
    assert mapped(items(spark, (None, None, "gone", True, True), (1, 2, "here", False, True)))[1] == 1
    bad = spark.createDataFrame([("not a key", "1", "n", True), ("5", "1", "n", False)], "ItemID string, CategoryId string, Name string, Deleted boolean")
    assert mapped(bad)[0] == [(5, 1, "n")]


def test_null_key_fails(spark, tmp_path):
    with pytest.raises(PySparkException, match="NOT NULL"):
        map_rows(items(spark, (None, 1, "a", False, True)), ITEM, OPTIONS).write.parquet(str(tmp_path / "o"))


def test_category_takes_either_name_and_ignores_flags(spark):
    for column in ("Name", "Descr", "DISPLAYNAME"):
        df = spark.createDataFrame([(4, "Sauces", True, False)], f"Id int, {column} string, Deleted boolean, Active boolean")
        assert mapped(df, ITEM_CATEGORY) == ([(4, "Sauces")], 0, 0)
    rows, _, cut = mapped(spark.createDataFrame([(4, "c" * 140)], "Id int, Name string"), ITEM_CATEGORY)
    assert len(rows[0][1]) == 100 and cut == 1


def test_blob_needs_a_name(spark):
    df = spark.createDataFrame([(9, "hero.jpg"), (10, None), (11, "n" * 80)], "BlobId int, Name string")
    assert mapped(df, BLOB) == ([(9, "hero.jpg"), (11, "n" * 50)], 1, 1)


def test_blob_key_is_checked_before_the_name(spark):
    df = spark.createDataFrame([(None, None)], "BlobId int, Name string")
    with pytest.raises(PySparkException, match="'BlobId' is null"):
        map_rows(df, BLOB, OPTIONS).collect()
    with pytest.raises(PySparkException, match="'BlobId' is null"):
        map_rows(df, BLOB, OPTIONS, Observation()).collect()


def test_alias_order_and_case():
    assert find_column(["itemid"], ["ItemID", "ItemId", "Id"]) == "itemid"
    assert find_column(["Id", "ItemID"], ["ItemID", "Id"]) == "ItemID"
    assert find_column(["Name"], ["Id"]) is None
    assert has_column(["DELETED"], "Deleted") and not has_column(["x"], "Deleted")


def test_presence_beats_value(spark):
    df = spark.createDataFrame([(1, 7, None, "second")], "Id int, CategoryId int, Descr string, Name string")
    spec = replace(ITEM_CATEGORY, columns=ITEM_CATEGORY.columns)
    assert mapped(df, spec)[0] == [(1, None)]


def test_missing_required_column_lists_both_sides(spark):
    with pytest.raises(MappingError, match=r"\[ItemID, Id\].*\[Name\]"):
        require_column(["Name"], ["ItemID", "Id"])
    with pytest.raises(MappingError, match="BlobId, BlobID, Id"):
        map_rows(spark.createDataFrame([("a",)], "Name string"), BLOB, OPTIONS)


def test_missing_optional_column_is_null(spark):
    df = spark.createDataFrame([(1, 2)], "ItemID bigint, CategoryId int")
    assert mapped(df) == ([(1, 2, None)], 0, 0)
    assert map_rows(df, ITEM, OPTIONS).schema["Id"].dataType == ITEM.schema["Id"].dataType


def test_item_blob_has_no_bare_id(spark):
    with pytest.raises(MappingError):
        map_rows(spark.createDataFrame([(1, 2, 3)], "Id int, ItemId int, BlobId int"), ITEM_BLOB, OPTIONS)
    df = spark.createDataFrame([(1, 2, 3)], "ITEMBLOBID int, itemid int, blobID int")
    assert mapped(df, ITEM_BLOB)[0] == [(1, 2, 3)]


def test_flag_warnings():
    warnings = flag_warnings(["ItemID", "Name"], ITEM, OPTIONS)
    assert len(warnings) == 1
    assert "exclude_deleted_items" in warnings[0] and "Deleted" in warnings[0] and "ItemID, Name" in warnings[0]
    assert flag_warnings(["deleted"], ITEM, OPTIONS) == []
    assert len(flag_warnings(["ItemID"], ITEM, replace(OPTIONS, exclude_inactive_items=True))) == 2
    assert flag_warnings(["Id"], ITEM_CATEGORY, OPTIONS) == []


def test_observed_counters_match(spark, tmp_path):
    df = items(spark, (1, 1, "x" * 200, False, True), (2, 1, "b", True, True)).unionAll(
        items(spark, (3, 1, None, False, True))
    )
    observed = Observation()
    map_rows(df, ITEM, OPTIONS, observed).write.parquet(str(tmp_path / "o"))
    assert observed.get == {"rows_read": 3, "rows_filtered": 1, "rows_staged": 2, "values_truncated": 1}
    empty = Observation()
    map_rows(df.where("ItemID < 0"), ITEM, OPTIONS, empty).write.parquet(str(tmp_path / "e"))
    assert empty.get["rows_read"] == 0 and empty.get["values_truncated"] == 0


def test_only_declared_columns_are_scanned(spark, tmp_path):
    df = items(spark, (1, 1, "a", False, True)).withColumn("Image", F.lit(b"bytes"))
    df.write.parquet(str(tmp_path / "item"))
    plan = map_rows(spark.read.parquet(str(tmp_path / "item")), ITEM, OPTIONS)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<ItemID:int,CategoryId:int,Name:string,Deleted:boolean>" in text
    assert "Image" not in text.split("ReadSchema")[1]


def test_load_order_follows_parents():
    assert [s.name for s in ITEM_TABLES] == ["ItemCategory", "Blob", "Item", "ItemBlob"]
    from tidemark.errors import ConfigurationError
    from tidemark.spec import ParentRef, load_order

    assert [s.name for s in load_order(reversed(ITEM_TABLES))][-1] == "ItemBlob"
    looped = [replace(ITEM_CATEGORY, parents=(ParentRef("ItemBlob", "Id"),)), *ITEM_TABLES[1:]]
    with pytest.raises(ConfigurationError, match="cycle"):
        load_order(looped)
    with pytest.raises(ConfigurationError):
        replace(ITEM, columns=(ColumnSpec("Other", ("Other",)),))
