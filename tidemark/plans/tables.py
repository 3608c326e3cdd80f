"""The four item tables and their load order."""

from __future__ import annotations

from tidemark.spec import ColumnSpec, FlagFilter, ParentRef, TableSpec, load_order

# Table, column, alias and folder names, widths.
ITEM_CATEGORY = TableSpec(
    name="ItemCategory",
    key="Id",
    columns=(
        ColumnSpec("Id", ("Id", "CategoryId", "CategoryID", "ItemCategoryId"), required=True),
        ColumnSpec("Descr", ("Descr", "Name", "DisplayName"), type="string", width=100),
    ),
    folder="itemcategory",
    identity=True,
    source_table="dbo.Category",
    extract_columns=("Id", "Name"),
)

BLOB = TableSpec(
    name="Blob",
    key="BlobId",
    columns=(
        ColumnSpec("BlobId", ("BlobId", "BlobID", "Id"), required=True),
        ColumnSpec("Name", ("Name",), type="string", width=50, reject_null=True),
    ),
    folder="blob",
    source_table="dbo.Blob",
    extract_columns=("BlobId", "Name"),
)

ITEM = TableSpec(
    name="Item",
    key="Id",
    columns=(
        ColumnSpec("Id", ("ItemID", "ItemId", "Id"), required=True),
        ColumnSpec("CategoryId", ("CategoryId", "CategoryID"), required=True),
        ColumnSpec("Name", ("Name",), type="string", width=100),
    ),
    folder="item",
    parents=(ParentRef("ItemCategory", "CategoryId"),),
    flags=(
        FlagFilter("exclude_deleted_items", ("Deleted",), drop_when=True),
        FlagFilter("exclude_inactive_items", ("Active",), drop_when=False),
    ),
    prunable=True,
    identity=True,
    source_table="dbo.ItemNew",
    extract_columns=("ItemID", "CategoryId", "Name", "Deleted", "Active"),
)

ITEM_BLOB = TableSpec(
    name="ItemBlob",
    key="ItemBlobId",
    columns=(
        ColumnSpec("ItemBlobId", ("ItemBlobId", "ItemBlobID"), required=True),
        ColumnSpec("ItemId", ("ItemId", "ItemID"), required=True),
        ColumnSpec("BlobId", ("BlobId", "BlobID"), required=True),
    ),
    folder="itemblob",
    parents=(ParentRef("Item", "ItemId"), ParentRef("Blob", "BlobId")),
    prunable=True,
    source_table="dbo.ItemBlob",
    extract_columns=("ItemBlobId", "ItemId", "BlobId"),
)

ITEM_TABLES = tuple(load_order([ITEM_CATEGORY, BLOB, ITEM, ITEM_BLOB]))
