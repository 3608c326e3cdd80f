import os
from dataclasses import replace

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidemark.errors import ConfigurationError, DuplicateKeyError, EmptySourceError, MappingError
from tidemark.operators import map_rows
from tidemark.options import SyncOptions
from tidemark.plans.tables import BLOB, ITEM, ITEM_CATEGORY, ITEM_TABLES
from tidemark.sources.extract import capture_deleted, capture_rows, default_run_id, extract_run, stage
from tidemark.sources.files import is_data_file, list_data_files, newest_run, resolve_run
from tidemark.sources.inline import inline_ids, inline_rows
from tidemark.sources.jdbc import JdbcSource, derived_table, write_jdbc
from tidemark.sources.staged import read_columns, scan_folder

OPTIONS = SyncOptions(stage_root="/stage")


@pytest.mark.parametrize(
    "name, expected",
    [
        ("part-00000-a.snappy.parquet", True),
        ("part-00000-a.PARQUET", True),
        ("_SUCCESS", False),
        ("_committed_1234", False),
        ("_started_1234", False),
        (".part-00000-a.parquet.crc", False),
        ("notes.txt", False),
        ("_hidden.parquet", False),
    ],
)
def test_data_files(name, expected):
    assert is_data_file(name) is expected


def write(path, **columns):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    pq.write_table(pa.table(columns), path)


def test_listing_is_recursive_and_skips_bookkeeping(spark, tmp_path):
    root = str(tmp_path)
    write(f"{root}/part-0.parquet", Id=[1])
    write(f"{root}/day=1/deep/part-1.PARQUET", Id=[2])
    for name in ("_SUCCESS", "notes.txt", ".part-0.parquet.crc"):
        (tmp_path / name).write_text("x")
    paths = [r["path"] for r in list_data_files(spark, root).orderBy("path").collect()]
    assert [p.rsplit("/", 1)[1] for p in paths] == ["part-1.PARQUET", "part-0.parquet"]
    scan = scan_folder(spark, root, ITEM_CATEGORY, OPTIONS)
    assert scan.file_count == 2
    # Folder names never turn into columns.
    assert scan.frames[0].columns == ["Id"]


def test_read_columns(spark, tmp_path):
    path = f"{tmp_path}/item.parquet"
    table = pa.table({"ItemID": [1, 2], "Name": ["item-1", None], "Deleted": [False, True], "Image": [b"a", b"b"]})
    pq.write_table(table, path, row_group_size=1)
    df = read_columns(spark, path, ["itemid", "Name", "DELETED", "Absent"])
    assert [tuple(r) for r in df.orderBy("ItemID").collect()] == [(1, "item-1", False), (2, None, True)]
    plan = read_columns(spark, path, ["ItemID"])._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<ItemID:bigint>" in plan
    with pytest.raises(ValueError):
        read_columns(spark, path, [])


def test_row_groups_are_all_read(spark, tmp_path):
    path = f"{tmp_path}/item.parquet"
    pq.write_table(pa.table({"ItemID": list(range(1, 7))}), path, row_group_size=2)
    assert sorted(r[0] for r in read_columns(spark, path, ["ItemID"]).collect()) == [1, 2, 3, 4, 5, 6]


def rows_of(scan, spec, options=OPTIONS):
    return sorted(tuple(r) for r in map_rows(scan.frames, spec, options).collect())


def test_files_may_name_and_type_columns_differently(spark, tmp_path):
    root = str(tmp_path)
    write(f"{root}/a.parquet", ItemID=pa.array([1, 2], pa.int32()), CategoryId=[1, 1], Name=["a", "b"], Deleted=[False, True])
    write(f"{root}/b.parquet", id=pa.array([3, 4], pa.int64()), CATEGORYID=[1, 1], Name=["c", "d"])
    write(f"{root}/c.parquet", Id=[-1, -1], ItemId=["5", "6"], CategoryID=[1, 1], Name=[None, "f"])
    scan = scan_folder(spark, root, ITEM, OPTIONS)
    assert scan.file_count == 3 and len(scan.frames) == 3
    assert rows_of(scan, ITEM) == [(1, 1, "a"), (3, 1, "c"), (4, 1, "d"), (5, 1, None), (6, 1, "f")]
    # Every schema without the flag is reported, not only the first.
    assert len(scan.warnings) == 2


@pytest.mark.parametrize("jobs", [3, 40])
def test_every_write_job_is_looked_at(spark, tmp_path, jobs):
    root = str(tmp_path)
    for n in range(jobs):
        write(f"{root}/a{n}.parquet", Id=pa.array([n], pa.int32()), CategoryId=[1], Name=[f"a{n}"], Deleted=[False])
    write(f"{root}/b.parquet", Id=pa.array([100], pa.int32()), CategoryId=[1], Name=["b"])
    scan = scan_folder(spark, root, ITEM, OPTIONS)
    assert (scan.file_count, len(scan.frames), len(scan.warnings)) == (jobs + 1, 2, 1)
    assert rows_of(scan, ITEM) == [*((n, 1, f"a{n}") for n in range(jobs)), (100, 1, "b")]


def test_files_with_either_alias_keep_their_values(spark, tmp_path):
    root = str(tmp_path)
    for n in range(5):
        write(f"{root}/a{n}.parquet", Id=pa.array([n], pa.int32()), Descr=[f"a{n}"])
        write(f"{root}/b{n}.parquet", CategoryId=pa.array([10 + n], pa.int64()), Name=[f"b{n}"])
    write(f"{root}/c.parquet", Id=pa.array([20], pa.int64()), Descr=["c"])
    scan = scan_folder(spark, root, ITEM_CATEGORY, OPTIONS)
    assert scan.file_count == 11 and len(scan.frames) == 3
    expected = [(n, f"a{n}") for n in range(5)] + [(10 + n, f"b{n}") for n in range(5)] + [(20, "c")]
    assert rows_of(scan, ITEM_CATEGORY) == sorted(expected)


def test_one_write_job_is_one_group(spark, tmp_path):
    root = str(tmp_path / "item")
    spark.range(100).select(F.col("id").alias("ItemID"), F.lit(1).alias("CategoryId")).repartition(5).write.parquet(root)
    scan = scan_folder(spark, root, ITEM, OPTIONS)
    assert scan.file_count == 5 and len(scan.frames) == 1
    assert len(rows_of(scan, ITEM)) == 100


def test_folder_without_usable_columns(spark, tmp_path):
    write(f"{tmp_path}/a.parquet", Other=[1])
    with pytest.raises(MappingError):
        scan_folder(spark, str(tmp_path), ITEM, OPTIONS)


def test_empty_and_missing_folders(spark, tmp_path):
    empty = tmp_path / "item"
    empty.mkdir()
    (empty / "_SUCCESS").write_text("")
    with pytest.raises(EmptySourceError, match="allow_empty_source_folders"):
        scan_folder(spark, str(empty), ITEM, OPTIONS)
    allowed = replace(OPTIONS, allow_empty_source_folders=True)
    assert scan_folder(spark, str(empty), ITEM, allowed).file_count == 0
    for options in (OPTIONS, allowed):
        with pytest.raises(EmptySourceError, match="does not exist"):
            scan_folder(spark, str(tmp_path / "absent"), ITEM, options)


def test_newest_run(spark, tmp_path):
    for name in ("run_20260101_001", "run_20260102_001", "RUN_20250101_001", "stage", "test"):
        (tmp_path / name).mkdir()
    (tmp_path / "run_99999999_file").write_text("x")
    assert newest_run(spark, f"{tmp_path}/").run_id == "run_20260102_001"
    assert resolve_run(spark, str(tmp_path), "mine").path == f"{tmp_path}/mine"
    assert resolve_run(spark, str(tmp_path), "  ").run_id == "run_20260102_001"
    with pytest.raises(ConfigurationError, match="load_"):
        newest_run(spark, str(tmp_path), "load_")


def test_stage_counts_what_was_written(spark, tmp_path):
    path = str(tmp_path / "t")
    assert stage(spark.range(50).repartition(4), path) == 50
    assert stage(spark.range(7).repartition(4), path, num_files=1) == 7
    assert len([f for f in os.listdir(path) if is_data_file(f)]) == 1


def test_extract_run(spark, tmp_path):
    source = {
        "ItemCategory": spark.createDataFrame([(1, "a", True)], "Id int, Name string, Extra boolean"),
        "Blob": spark.createDataFrame([(1, "b")], "BlobId int, Name string"),
        "Item": spark.createDataFrame([(1, 1, "n", False, True, b"i")], "ItemID int, CategoryId int, Name string, Deleted boolean, Active boolean, Image binary"),
        "ItemBlob": spark.createDataFrame([(1, 1, 1), (2, 1, 1)], "ItemBlobId int, ItemId int, BlobId int"),
    }
    run_id, counts = extract_run(spark, ITEM_TABLES, source, f"{tmp_path}/", "run_1", {"Blob": 1})
    assert run_id == "run_1" and counts == {"ItemCategory": 1, "Blob": 1, "Item": 1, "ItemBlob": 2}
    assert spark.read.parquet(f"{tmp_path}/run_1/item").columns == ["ItemID", "CategoryId", "Name", "Deleted", "Active"]
    again, _ = extract_run(spark, ITEM_TABLES, lambda s: source[s.name], str(tmp_path))
    assert again == default_run_id() and again.startswith("run_") and again.endswith("_001")
    with pytest.raises(ConfigurationError):
        extract_run(spark, ITEM_TABLES, source, "/data/<folder>")


def test_captures(spark):
    df = spark.createDataFrame([(3, "c", True), (1, "a", None), (2, "b", True)], "ItemID int, Name string, Deleted boolean")
    assert [tuple(r) for r in capture_rows(df, "ItemID", ["Name"]).collect()] == [(1, "a"), (2, "b"), (3, "c")]
    assert [r[0] for r in capture_deleted(df, "ItemID").collect()] == [2, 3]


def test_inline_rows_are_keyed(spark):
    assert inline_rows(spark, ITEM_CATEGORY, [(1, "a"), (2, None)]).count() == 2
    with pytest.raises(DuplicateKeyError):
        inline_rows(spark, ITEM_CATEGORY, [(1, "a"), (1, "b")])
    with pytest.raises(DuplicateKeyError):
        inline_ids(spark, ITEM, [1, 1])
    with pytest.raises(MappingError):
        inline_ids(spark, ITEM, [1, None])


def test_jdbc_options():
    assert derived_table("dbo.Blob", BLOB.extract_columns, "b") == "(SELECT BlobId, Name FROM dbo.Blob) AS b"
    source = JdbcSource(
        "jdbc:x://host/db",
        {"user": "u", "driver": "D"},
        {"Item": {"partitionColumn": "ItemID", "lowerBound": 1, "upperBound": 10**9, "numPartitions": 64}},
    )
    options = source.read_options("(SELECT 1) AS t", "Item")
    assert options["numPartitions"] == "64" and options["fetchsize"] == "10000" and options["user"] == "u"
    assert "partitionColumn" not in source.read_options("q", "Blob")
    with pytest.raises(ConfigurationError):
        JdbcSource("jdbc:x://<server>/db")
    with pytest.raises(ConfigurationError):
        JdbcSource("jdbc:x://host/db", {"user": "<sql-user>"})


def test_jdbc_write_options():
    class Writer:
        def __init__(self):
            self.seen = {}

        def format(self, name):
            self.seen["format"] = name
            return self

        def mode(self, name):
            self.seen["mode"] = name
            return self

        def options(self, **values):
            self.seen.update(values)
            return self

        def option(self, name, value):
            self.seen[name] = value
            return self

        def save(self):
            self.seen["saved"] = True

    class Frame:
        write = Writer()

    write_jdbc(Frame(), JdbcSource("jdbc:x://host/db", {"user": "u"}), "stage_Item", num_partitions=8)
    assert Frame.write.seen == {
        "format": "jdbc", "mode": "append", "user": "u", "url": "jdbc:x://host/db",
        "dbtable": "stage_Item", "batchsize": 5000, "numPartitions": 8, "saved": True,
    }


def test_options():
    good = SyncOptions(stage_root="/data/stage")
    assert good.validate() is good and good.skip_completed_tables and good.exclude_deleted_items
    assert not good.prune_missing_rows and good.batch_size == 5000 and good.run_folder_prefix == "run_"
    assert SyncOptions(stage_root="s3a://bucket/stage").validate()
    for bad in ("", "  ", "relative/path", "/data/<folder>", "/data/>"):
        with pytest.raises(ConfigurationError, match="stage_root"):
            SyncOptions(stage_root=bad).validate()
    with pytest.raises(ConfigurationError, match="batch_size"):
        SyncOptions(stage_root="/a", batch_size=0).validate()
    assert good.folder_of(ITEM) == "item"
    assert replace(good, source_folders={"ITEM": "things"}).folder_of(ITEM) == "things"
    with pytest.raises(ConfigurationError, match="source_folders.*'Item'"):
        replace(good, source_folders={"item": " "}).folder_of(ITEM)
    assert replace(good, skip_tables=frozenset({"itemcategory"})).skips("ItemCategory")
