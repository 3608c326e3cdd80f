"""What each query must return, as SQL over the given tables."""

from __future__ import annotations

# Shared table expressions, by name; a statement lists the ones it needs.
EXPRESSIONS = {
    "staged_items": """
        SELECT o_orderkey AS Id, o_custkey AS CategoryId, repeat(o_orderpriority, 10) AS FullName,
               left(repeat(o_orderpriority, 10), 100) AS Name,
               CASE o_orderstatus WHEN 'F' THEN true WHEN 'P' THEN NULL ELSE false END AS Deleted,
               o_orderstatus <> 'O' AS Active
        FROM orders""",
    "items": "SELECT Id, CategoryId, Name FROM staged_items WHERE Deleted IS NOT TRUE",
    "staged_blobs": "SELECT p_partkey AS BlobId, CASE WHEN p_size <> 1 THEN p_name END AS Name FROM part",
    "blobs": "SELECT BlobId, Name FROM staged_blobs WHERE Name IS NOT NULL",
    "links": """
        SELECT l_orderkey * 10 + l_linenumber AS ItemBlobId, l_orderkey AS ItemId, l_partkey AS BlobId
        FROM lineitem""",
    "one_link": """
        SELECT ItemBlobId, ItemId, BlobId FROM (
            SELECT *, row_number() OVER (PARTITION BY ItemBlobId ORDER BY ItemId, BlobId) AS rn
            FROM links) WHERE rn = 1""",
    "loaded_categories": "SELECT c_custkey AS Id, c_name AS Descr FROM customer WHERE c_acctbal >= 0",
    "loaded_items": "SELECT o_orderkey AS Id, o_custkey AS CategoryId FROM orders WHERE o_orderstatus <> 'F'",
    "earlier_categories": """
        SELECT c_custkey AS Id,
               CASE WHEN c_mktsegment = 'BUILDING' THEN lower(c_name) ELSE c_name END AS Descr
        FROM customer WHERE c_acctbal >= 0""",
    "earlier_blobs": """
        SELECT p_partkey AS BlobId, CASE WHEN p_size > 40 THEN upper(p_name) ELSE p_name END AS Name
        FROM part WHERE p_size <> 1""",
    "earlier_items": """
        SELECT o_orderkey AS Id, o_custkey AS CategoryId,
               CASE WHEN o_orderpriority = '5-LOW' THEN NULL
                    WHEN o_totalprice > 250000 THEN o_orderpriority
                    ELSE left(repeat(o_orderpriority, 10), 100) END AS Name
        FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'""",
    "earlier_all_links": """
        SELECT l_orderkey * 10 + l_linenumber AS ItemBlobId, l_orderkey AS ItemId, l_partkey AS BlobId
        FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01'""",
    "earlier_links": """
        SELECT ItemBlobId, ItemId, BlobId FROM (
            SELECT *, row_number() OVER (PARTITION BY ItemBlobId ORDER BY ItemId, BlobId) AS rn
            FROM earlier_all_links) WHERE rn = 1""",
    "eligible_items": """
        SELECT * FROM items i WHERE EXISTS (SELECT 1 FROM loaded_categories c WHERE c.Id = i.CategoryId)""",
    "eligible_links": """
        SELECT * FROM one_link l
        WHERE EXISTS (SELECT 1 FROM loaded_items i WHERE i.Id = l.ItemId)
          AND EXISTS (SELECT 1 FROM blobs b WHERE b.BlobId = l.BlobId)""",
    "held_items": """
        SELECT i.*, EXISTS (SELECT 1 FROM loaded_categories c WHERE c.Id = i.CategoryId) AS ok
        FROM items i""",
    "item_actions": """
        SELECT CASE WHEN s.ok AND t.Id IS NULL THEN 'INSERT'
                    WHEN s.ok AND (s.CategoryId IS DISTINCT FROM t.CategoryId
                                   OR s.Name IS DISTINCT FROM t.Name) THEN 'UPDATE'
                    WHEN s.ok THEN 'UNCHANGED'
                    WHEN s.Id IS NOT NULL AND t.Id IS NULL THEN 'REJECT'
                    ELSE 'KEEP' END AS _action,
               coalesce(s.Id, t.Id) AS Id,
               s.Id IS NULL AS target_only,
               CASE WHEN s.ok THEN s.CategoryId ELSE t.CategoryId END AS CategoryId,
               CASE WHEN s.ok THEN s.Name ELSE t.Name END AS Name
        FROM held_items s FULL JOIN earlier_items t ON s.Id = t.Id""",
    "deleted_ids": "SELECT o_orderkey AS Id FROM orders WHERE o_orderstatus = 'F'",
    # The earlier pass: all items, links with both parents.
    "first_items": """
        SELECT * FROM earlier_items i
        WHERE EXISTS (SELECT 1 FROM earlier_categories c WHERE c.Id = i.CategoryId)""",
    "first_links": """
        SELECT * FROM earlier_links l
        WHERE EXISTS (SELECT 1 FROM first_items i WHERE i.Id = l.ItemId)
          AND EXISTS (SELECT 1 FROM earlier_blobs b WHERE b.BlobId = l.BlobId)""",
    # What goes with the categories of one segment.
    "doomed_categories": "SELECT c_custkey AS Id FROM customer WHERE c_mktsegment = 'MACHINERY'",
    "doomed_items": "SELECT Id FROM first_items WHERE CategoryId IN (SELECT Id FROM doomed_categories)",
    # The later pass: all customers are there, deleted items are pruned.
    "second_items": "SELECT * FROM items",
    "cascaded_links": "SELECT * FROM first_links l WHERE EXISTS (SELECT 1 FROM items i WHERE i.Id = l.ItemId)",
    "second_eligible": """
        SELECT * FROM one_link l
        WHERE EXISTS (SELECT 1 FROM items i WHERE i.Id = l.ItemId)
          AND EXISTS (SELECT 1 FROM blobs b WHERE b.BlobId = l.BlobId)""",
    "second_links": """
        SELECT coalesce(s.ItemBlobId, t.ItemBlobId) AS ItemBlobId,
               CASE WHEN s.ItemBlobId IS NOT NULL THEN s.ItemId ELSE t.ItemId END AS ItemId,
               CASE WHEN s.ItemBlobId IS NOT NULL THEN s.BlobId ELSE t.BlobId END AS BlobId
        FROM second_eligible s FULL JOIN cascaded_links t ON s.ItemBlobId = t.ItemBlobId""",
    "ledger_events": """
        SELECT 'run_' || strftime(ts, '%Y%m%d') || '_001' AS RunId,
               'user_' || user_id AS TableName,
               CASE event_type WHEN 'purchase' THEN 'Succeeded' WHEN 'error' THEN 'Failed'
                               ELSE 'Running' END AS Status,
               event_id AS EventSeq, ts AS EventUtc, CAST(floor(value) AS BIGINT) AS amount,
               props AS message
        FROM events""",
    "ledger": """
        SELECT RunId, TableName, arg_max(Status, EventSeq) AS Status,
               CAST(count(*) FILTER (Status = 'Running') AS INTEGER) AS AttemptCount,
               CAST(CASE WHEN count(*) FILTER (Status = 'Succeeded') > 0 THEN 1 END AS INTEGER) AS FilesProcessed,
               arg_max(amount, EventSeq) FILTER (Status = 'Succeeded') AS amount,
               arg_max(EventUtc, EventSeq) FILTER (Status = 'Running') AS StartedUtc,
               CASE WHEN arg_max(Status, EventSeq) <> 'Running' THEN arg_max(EventUtc, EventSeq) END AS CompletedUtc,
               CASE WHEN arg_max(Status, EventSeq) = 'Failed' THEN arg_max(message, EventSeq) END AS ErrorMessage
        FROM ledger_events GROUP BY RunId, TableName
        HAVING count(*) FILTER (Status = 'Running') > 0""",
}

# Expressions an expression is built on.
NEEDS = {
    "items": ["staged_items"],
    "blobs": ["staged_blobs"],
    "one_link": ["links"],
    "earlier_links": ["earlier_all_links"],
    "eligible_items": ["items", "loaded_categories"],
    "eligible_links": ["one_link", "loaded_items", "blobs"],
    "held_items": ["items", "loaded_categories"],
    "item_actions": ["held_items", "earlier_items"],
    "first_items": ["earlier_items", "earlier_categories"],
    "first_links": ["earlier_links", "first_items", "earlier_blobs"],
    "doomed_items": ["first_items", "doomed_categories"],
    "second_items": ["items"],
    "cascaded_links": ["first_links", "items"],
    "second_eligible": ["one_link", "items", "blobs"],
    "second_links": ["second_eligible", "cascaded_links"],
    "ledger": ["ledger_events"],
}


def statement(body: str, *names: str) -> str:
    """The statement with every table expression it needs in front."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for need in NEEDS.get(name, []):
            add(need)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    if not ordered:
        return body
    return "WITH " + ", ".join(f"{n} AS ({EXPRESSIONS[n]})" for n in ordered) + " " + body


LEDGER_COLUMNS = """RunId, TableName, Status, AttemptCount, FilesProcessed,
    amount AS RowsRead, amount + 1 AS RowsStaged, amount + 2 AS RowsInserted,
    amount + 3 AS RowsUpdated, amount + 4 AS RowsFiltered, amount + 5 AS RowsRejected,
    amount + 6 AS RowsDeleted, amount + 7 AS ValuesTruncated,
    StartedUtc, CompletedUtc, ErrorMessage"""

COUNTERS_OF = """count(*) FILTER (_action = 'INSERT') AS "insert",
    count(*) FILTER (_action = 'UPDATE') AS "update",
    count(*) FILTER (_action = 'UNCHANGED') AS unchanged,
    count(*) FILTER (_action = 'KEEP') AS keep,
    count(*) FILTER (_action = 'REJECT') AS reject,
    count(*) FILTER (_action = 'DELETE') AS "delete" """


def _report_row(run: str, table: str, **counts: str) -> str:
    names = [
        "RowsRead", "RowsFiltered", "RowsStaged", "RowsInserted", "RowsUpdated",
        "RowsUnchanged", "RowsRejected", "RowsDeleted", "ChildRowsDeleted", "ValuesTruncated",
    ]
    cells = ", ".join(f"CAST(({counts.get(n, '0')}) AS BIGINT) AS {n}" for n in names)
    return f"SELECT '{run}' AS RunId, '{table}' AS TableName, {cells}"


def _count(source: str) -> str:
    return f"SELECT count(*) FROM {source}"


FIRST, SECOND = "run_20260101_001", "run_20260102_001"

_PASS_ROWS = [
    _report_row(
        FIRST, "ItemCategory", RowsRead=_count("earlier_categories"),
        RowsStaged=_count("earlier_categories"), RowsInserted=_count("earlier_categories"),
    ),
    _report_row(
        FIRST, "Blob", RowsRead=_count("part"), RowsFiltered=_count("part WHERE p_size = 1"),
        RowsStaged=_count("earlier_blobs"), RowsInserted=_count("earlier_blobs"),
    ),
    _report_row(
        FIRST, "Item", RowsRead=_count("earlier_items"), RowsStaged=_count("earlier_items"),
        RowsInserted=_count("first_items"),
        RowsRejected=f"({_count('earlier_items')}) - ({_count('first_items')})",
        ValuesTruncated=_count(
            "orders WHERE o_orderdate < TIMESTAMP '1998-01-01' AND o_orderpriority <> '5-LOW' "
            "AND o_totalprice <= 250000 AND length(o_orderpriority) > 10"
        ),
    ),
    _report_row(
        FIRST, "ItemBlob", RowsRead=_count("earlier_all_links"),
        RowsStaged=_count("earlier_all_links"), RowsInserted=_count("first_links"),
        RowsRejected=f"({_count('earlier_all_links')}) - ({_count('first_links')})",
    ),
    _report_row(
        SECOND, "ItemCategory", RowsRead=_count("customer"), RowsStaged=_count("customer"),
        RowsInserted=_count("customer WHERE c_acctbal < 0"),
        RowsUpdated=_count(
            "customer WHERE c_acctbal >= 0 AND c_mktsegment = 'BUILDING' AND c_name <> lower(c_name)"
        ),
        RowsUnchanged=_count(
            "customer WHERE c_acctbal >= 0 AND NOT (c_mktsegment = 'BUILDING' AND c_name <> lower(c_name))"
        ),
    ),
    _report_row(
        SECOND, "Blob", RowsRead=_count("part"), RowsFiltered=_count("part WHERE p_size = 1"),
        RowsStaged=_count("blobs"),
        RowsUpdated=_count("blobs JOIN earlier_blobs t USING (BlobId) WHERE blobs.Name <> t.Name"),
        RowsUnchanged=_count("blobs JOIN earlier_blobs t USING (BlobId) WHERE blobs.Name = t.Name"),
    ),
    _report_row(
        SECOND, "Item", RowsRead=_count("orders"),
        RowsFiltered=_count("orders WHERE o_orderstatus = 'F'"), RowsStaged=_count("items"),
        RowsInserted=_count("items i WHERE NOT EXISTS (SELECT 1 FROM first_items t WHERE t.Id = i.Id)"),
        RowsUpdated=_count(
            "items i JOIN first_items t ON t.Id = i.Id WHERE i.Name IS DISTINCT FROM t.Name"
        ),
        RowsUnchanged=_count(
            "items i JOIN first_items t ON t.Id = i.Id WHERE i.Name IS NOT DISTINCT FROM t.Name"
        ),
        RowsDeleted=_count("first_items t WHERE NOT EXISTS (SELECT 1 FROM items i WHERE i.Id = t.Id)"),
        ChildRowsDeleted=f"({_count('first_links')}) - ({_count('cascaded_links')})",
        ValuesTruncated=_count("staged_items WHERE Deleted IS NOT TRUE AND length(FullName) > 100"),
    ),
    _report_row(
        SECOND, "ItemBlob", RowsRead=_count("links"), RowsStaged=_count("links"),
        RowsInserted=_count(
            "second_eligible s WHERE NOT EXISTS "
            "(SELECT 1 FROM cascaded_links t WHERE t.ItemBlobId = s.ItemBlobId)"
        ),
        RowsUpdated=_count(
            "second_eligible s JOIN cascaded_links t ON s.ItemBlobId = t.ItemBlobId "
            "WHERE s.ItemId <> t.ItemId OR s.BlobId <> t.BlobId"
        ),
        RowsUnchanged=_count(
            "second_eligible s JOIN cascaded_links t ON s.ItemBlobId = t.ItemBlobId "
            "WHERE s.ItemId = t.ItemId AND s.BlobId = t.BlobId"
        ),
        RowsRejected=f"({_count('links')}) - ({_count('second_eligible')})",
    ),
]
_PASS_NEEDS = ["staged_items", "second_links", "first_links", "blobs", "links"]

STATEMENTS = {
    "scan_project": "SELECT o_orderkey, o_custkey, o_orderpriority FROM orders",
    "alias_rename": statement(
        "SELECT Id, CategoryId, Name, CAST(NULL AS VARCHAR) AS Note FROM staged_items", "staged_items"
    ),
    "coerce_int": """
        SELECT l_orderkey, l_linenumber,
               CAST(round_even(l_quantity * 0.5, 0) AS INTEGER) AS half_quantity,
               CAST(round_even(l_quantity * 2.5, 0) AS INTEGER) AS scaled_quantity,
               l_linenumber AS text_line, CAST(l_returnflag = 'A' AS INTEGER) AS is_a,
               CAST(l_partkey AS INTEGER) AS part
        FROM lineitem""",
    "coerce_text": """
        SELECT l_orderkey, CAST(l_partkey AS VARCHAR) AS part,
               regexp_replace(CAST(l_quantity AS VARCHAR), '\\.0$', '') AS quantity,
               regexp_replace(CAST(l_extendedprice AS VARCHAR), '\\.0$', '') AS price,
               CASE WHEN l_returnflag = 'A' THEN 'True' ELSE 'False' END AS is_a,
               strftime(l_shipdate, '%m/%d/%Y %H:%M:%S') AS shipped
        FROM lineitem""",
    "coerce_bool": """
        SELECT o_orderkey,
               CASE o_orderstatus WHEN 'O' THEN true WHEN 'F' THEN false END AS from_text,
               o_custkey <> 0 AS from_number
        FROM orders""",
    "required_values": "SELECT o_orderkey AS Id, o_orderpriority AS Name FROM orders",
    "capture_categories": "SELECT c_custkey AS Id, c_name AS Name FROM customer ORDER BY Id",
    "capture_deleted_items": statement(
        "SELECT Id AS ItemID, FullName AS Name FROM staged_items WHERE Deleted ORDER BY ItemID",
        "staged_items",
    ),
    "filter_deleted": statement("SELECT * FROM items", "items"),
    "filter_inactive": statement(
        "SELECT Id, CategoryId, Name FROM staged_items WHERE Active IS NOT FALSE", "staged_items"
    ),
    "map_categories": "SELECT c_custkey AS Id, c_name AS Descr FROM customer",
    "null_reject": statement("SELECT * FROM blobs", "blobs"),
    "null_reject_quarantine": statement("SELECT * FROM staged_blobs WHERE Name IS NULL", "staged_blobs"),
    "width_fit": "SELECT doc_id, left(text, 100) AS text_100, length(text) > 50 AS over_50 FROM documents",
    "truncation_count": statement(
        "SELECT count(*) AS values_truncated FROM staged_items "
        "WHERE Deleted IS NOT TRUE AND length(FullName) > 100",
        "staged_items",
    ),
    "mapping_counters": statement(
        """
        SELECT 'ItemCategory' AS TableName, count(*) AS rows_read, CAST(0 AS BIGINT) AS rows_filtered,
               count(*) AS rows_staged, CAST(0 AS BIGINT) AS values_truncated FROM customer
        UNION ALL SELECT 'Blob', count(*), count(*) FILTER (Name IS NULL), count(Name), 0 FROM staged_blobs
        UNION ALL SELECT 'Item', count(*), count(*) FILTER (Deleted), count(*) FILTER (Deleted IS NOT TRUE),
               count(*) FILTER (Deleted IS NOT TRUE AND length(FullName) > 100) FROM staged_items
        UNION ALL SELECT 'ItemBlob', count(*), 0, count(*), 0 FROM links""",
        "staged_blobs", "staged_items", "links",
    ),
    "dedup_key": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM (
            SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                         ORDER BY l_partkey, l_suppkey) AS rn
            FROM lineitem) WHERE rn = 1""",
    "duplicate_keys": statement(
        "SELECT ItemBlobId, count(*) - 1 AS extra_rows FROM links GROUP BY 1 HAVING count(*) > 1", "links"
    ),
    "semi_parent_one": statement("SELECT * FROM eligible_items", "eligible_items"),
    "semi_parent_two": statement(
        """SELECT * FROM links l
           WHERE EXISTS (SELECT 1 FROM loaded_items i WHERE i.Id = l.ItemId)
             AND EXISTS (SELECT 1 FROM blobs b WHERE b.BlobId = l.BlobId)""",
        "links", "loaded_items", "blobs",
    ),
    "orphan_references": statement(
        """SELECT DISTINCT ItemId FROM links l
           WHERE NOT EXISTS (SELECT 1 FROM loaded_items i WHERE i.Id = l.ItemId)""",
        "links", "loaded_items",
    ),
    "orphan_links": statement(
        "SELECT * FROM links l WHERE NOT EXISTS (SELECT 1 FROM blobs b WHERE b.BlobId = l.BlobId)",
        "links", "blobs",
    ),
    "dedup_then_parent": statement("SELECT * FROM eligible_links", "eligible_links"),
    "eligible_flags": statement(
        """SELECT l.*, EXISTS (SELECT 1 FROM loaded_items i WHERE i.Id = l.ItemId)
                   AND EXISTS (SELECT 1 FROM blobs b WHERE b.BlobId = l.BlobId) AS _eligible
           FROM one_link l""",
        "one_link", "loaded_items", "blobs",
    ),
    "reject_count": statement(
        """SELECT (SELECT count(*) FROM links) AS staged,
                  (SELECT count(*) FROM eligible_links) AS eligible,
                  (SELECT count(*) FROM links) - (SELECT count(*) FROM eligible_links) AS rejected""",
        "eligible_links",
    ),
    "merge_actions": statement("SELECT _action, Id, CategoryId, Name FROM item_actions", "item_actions"),
    "merge_prune_actions": statement(
        """SELECT CASE WHEN target_only THEN 'DELETE' ELSE _action END AS _action, Id, CategoryId, Name
           FROM item_actions""",
        "item_actions",
    ),
    "merge_counts": statement(f"SELECT {COUNTERS_OF} FROM item_actions", "item_actions"),
    "merge_result": statement(
        "SELECT Id, CategoryId, Name FROM item_actions WHERE _action <> 'REJECT'", "item_actions"
    ),
    "merge_changes": statement(
        "SELECT _action, Id, CategoryId, Name FROM item_actions WHERE _action IN ('INSERT', 'UPDATE')",
        "item_actions",
    ),
    "merge_rerun_noop": statement(
        """SELECT CAST(0 AS BIGINT) AS "insert", CAST(0 AS BIGINT) AS "update",
                  count(*) FILTER (_action IN ('INSERT', 'UPDATE', 'UNCHANGED')) AS unchanged,
                  count(*) FILTER (_action = 'KEEP') AS keep,
                  CAST(0 AS BIGINT) AS reject, CAST(0 AS BIGINT) AS "delete" FROM item_actions""",
        "item_actions",
    ),
    "merge_collation": """
        SELECT count(*) FILTER (c_acctbal < 0) AS "insert", CAST(0 AS BIGINT) AS "update",
               count(*) FILTER (c_acctbal >= 0) AS unchanged, CAST(0 AS BIGINT) AS keep,
               CAST(0 AS BIGINT) AS reject, CAST(0 AS BIGINT) AS "delete" FROM customer""",
    "merge_item_category": "SELECT c_custkey AS Id, c_name AS Descr FROM customer",
    "merge_blob": statement(
        """SELECT CASE WHEN s.Name <> t.Name THEN 'UPDATE' ELSE 'UNCHANGED' END AS _action,
                  s.BlobId, s.Name
           FROM blobs s JOIN earlier_blobs t ON s.BlobId = t.BlobId""",
        "blobs", "earlier_blobs",
    ),
    "merge_item_blob": statement(
        """SELECT CASE WHEN t.ItemBlobId IS NULL THEN 'INSERT'
                       WHEN s.ItemBlobId IS NULL THEN 'KEEP'
                       WHEN s.ItemId <> t.ItemId OR s.BlobId <> t.BlobId THEN 'UPDATE'
                       ELSE 'UNCHANGED' END AS _action,
                  coalesce(s.ItemBlobId, t.ItemBlobId) AS ItemBlobId,
                  coalesce(s.ItemId, t.ItemId) AS ItemId, coalesce(s.BlobId, t.BlobId) AS BlobId
           FROM eligible_links s FULL JOIN earlier_links t ON s.ItemBlobId = t.ItemBlobId""",
        "eligible_links", "earlier_links",
    ),
    "seed_upsert": "SELECT c_custkey AS Id, c_name AS Descr FROM customer ORDER BY Id",
    "high_water": statement("SELECT coalesce(max(Id), 0) AS high_water FROM items", "items"),
    "high_water_state": statement(
        """SELECT m.mark AS CurrentIdentity, max(Id) AS MaxId, m.mark >= max(Id) AS Ok
           FROM items, (SELECT coalesce(max(o_orderkey), 0) AS mark FROM orders
                        WHERE o_orderdate < TIMESTAMP '1998-01-01') m GROUP BY m.mark""",
        "items",
    ),
    "prune_item_survivors": statement(
        "SELECT * FROM earlier_items t WHERE EXISTS (SELECT 1 FROM items s WHERE s.Id = t.Id)",
        "earlier_items", "items",
    ),
    "prune_child_cascade": statement(
        "SELECT * FROM earlier_links t WHERE NOT EXISTS (SELECT 1 FROM items s WHERE s.Id = t.ItemId)",
        "earlier_links", "items",
    ),
    "prune_item_blob": statement(
        """SELECT * FROM earlier_links t WHERE EXISTS (
               SELECT 1 FROM lineitem s WHERE s.l_shipdate >= TIMESTAMP '1996-01-01'
                 AND s.l_orderkey * 10 + s.l_linenumber = t.ItemBlobId)""",
        "earlier_links",
    ),
    "prune_counts": statement(
        """SELECT (SELECT count(*) FROM earlier_items t
                   WHERE NOT EXISTS (SELECT 1 FROM items s WHERE s.Id = t.Id)) AS items_deleted,
                  (SELECT count(*) FROM earlier_links t
                   WHERE NOT EXISTS (SELECT 1 FROM items s WHERE s.Id = t.ItemId)) AS children_deleted""",
        "earlier_items", "earlier_links", "items",
    ),
    "delete_ids_report": statement(
        """SELECT (SELECT count(*) FROM earlier_links WHERE ItemId IN (SELECT Id FROM deleted_ids)) AS ItemBlobRowsDeleted,
                  (SELECT count(*) FROM earlier_items WHERE Id IN (SELECT Id FROM deleted_ids)) AS ItemRowsDeleted,
                  (SELECT count(*) FROM earlier_items WHERE Id NOT IN (SELECT Id FROM deleted_ids)) AS ItemsRemaining,
                  CAST(0 AS BIGINT) AS StillPresent""",
        "earlier_links", "earlier_items", "deleted_ids",
    ),
    "delete_ids_survivors": statement(
        "SELECT * FROM earlier_links WHERE ItemId NOT IN (SELECT Id FROM deleted_ids)",
        "earlier_links", "deleted_ids",
    ),
    "delete_ids_removed": statement(
        "SELECT * FROM earlier_items WHERE Id IN (SELECT Id FROM deleted_ids)",
        "earlier_items", "deleted_ids",
    ),
    "table_counts_union": statement(
        """SELECT 'ItemCategory' AS TableName, count(*) AS "Rows" FROM loaded_categories
           UNION ALL SELECT 'Blob', count(*) FROM blobs
           UNION ALL SELECT 'Item', count(*) FROM loaded_items
           UNION ALL SELECT 'ItemBlob', count(*) FROM earlier_links""",
        "loaded_categories", "blobs", "loaded_items", "earlier_links",
    ),
    "integrity_orphans": statement(
        """SELECT 'Item -> ItemCategory' AS Relationship, Id, CategoryId AS ParentId FROM loaded_items i
           WHERE NOT EXISTS (SELECT 1 FROM loaded_categories c WHERE c.Id = i.CategoryId)
           UNION ALL SELECT 'ItemBlob -> Item', ItemBlobId, ItemId FROM earlier_links l
           WHERE NOT EXISTS (SELECT 1 FROM loaded_items i WHERE i.Id = l.ItemId)
           UNION ALL SELECT 'ItemBlob -> Blob', ItemBlobId, BlobId FROM earlier_links l
           WHERE NOT EXISTS (SELECT 1 FROM blobs b WHERE b.BlobId = l.BlobId)""",
        "loaded_items", "loaded_categories", "earlier_links", "blobs",
    ),
    "ledger_current": statement(f"SELECT {LEDGER_COLUMNS} FROM ledger", "ledger"),
    "ledger_attempts": statement(
        "SELECT RunId, TableName, Status, AttemptCount FROM ledger", "ledger"
    ),
    "ledger_report": statement(
        f"""SELECT * EXCLUDE (RunId) FROM (SELECT {LEDGER_COLUMNS} FROM ledger)
            WHERE RunId = 'run_20240115_001' ORDER BY StartedUtc""",
        "ledger",
    ),
    "resume_pending_tables": statement(
        """SELECT DISTINCT RunId, TableName FROM ledger_events e
           WHERE NOT EXISTS (SELECT 1 FROM ledger l WHERE l.RunId = e.RunId
                             AND l.TableName = e.TableName AND l.Status = 'Succeeded')""",
        "ledger",
    ),
    "pass_report": statement(" UNION ALL ".join(_PASS_ROWS), *_PASS_NEEDS),
    "pass_target_items": statement("SELECT Id, CategoryId, Name FROM items", "items"),
    "pass_target_links": statement("SELECT * FROM second_links", "second_links"),
    "pass_ledger": statement(
        f"""SELECT TableName, 'Succeeded' AS Status, CAST(1 AS INTEGER) AS AttemptCount, RowsRead,
                   RowsStaged, RowsInserted, RowsUpdated, RowsFiltered, RowsRejected, RowsDeleted,
                   ValuesTruncated
            FROM ({" UNION ALL ".join(_PASS_ROWS)}) WHERE RunId = '{SECOND}'""",
        *_PASS_NEEDS,
    ),
    "pass_verify": statement(
        """SELECT 'rows ItemCategory' AS "Check", count(*) AS "Value" FROM customer
           UNION ALL SELECT 'rows Blob', count(*) FROM blobs
           UNION ALL SELECT 'rows Item', count(*) FROM items
           UNION ALL SELECT 'rows ItemBlob', count(*) FROM second_links
           UNION ALL SELECT 'mark ItemCategory', max(c_custkey) FROM customer
           UNION ALL SELECT 'mark Item', max(Id) FROM items""",
        "blobs", "items", "second_links",
    ),
    "delete_ids_job": statement(
        """SELECT (SELECT count(*) FROM first_links WHERE ItemId IN (SELECT Id FROM deleted_ids)) AS ItemBlobRowsDeleted,
                  (SELECT count(*) FROM first_items WHERE Id IN (SELECT Id FROM deleted_ids)) AS ItemRowsDeleted,
                  (SELECT count(*) FROM first_items WHERE Id NOT IN (SELECT Id FROM deleted_ids)) AS ItemsRemaining,
                  CAST(0 AS BIGINT) AS StillPresent""",
        "first_links", "deleted_ids",
    ),
    "cascade_delete_job": statement(
        """SELECT (SELECT count(*) FROM first_links WHERE ItemId IN (SELECT Id FROM doomed_items)) AS ItemBlobRowsDeleted,
                  (SELECT count(*) FROM doomed_items) AS ItemRowsDeleted,
                  (SELECT count(*) FROM earlier_categories WHERE Id IN (SELECT Id FROM doomed_categories)) AS ItemCategoryRowsDeleted,
                  (SELECT count(*) FROM earlier_categories WHERE Id NOT IN (SELECT Id FROM doomed_categories)) AS ItemCategorysRemaining,
                  CAST(0 AS BIGINT) AS StillPresent""",
        "first_links", "doomed_items",
    ),
    "cascade_delete_links": statement(
        "SELECT * FROM first_links WHERE ItemId NOT IN (SELECT Id FROM doomed_items)", "first_links", "doomed_items"
    ),
    "pass_rerun_writes": statement(
        """SELECT TableName, n AS RowsUnchanged, CAST(0 AS BIGINT) AS RowsChanged, CAST(0 AS BIGINT) AS FoldersWritten, true AS SameVersion
           FROM (SELECT 'ItemCategory' AS TableName, count(*) AS n FROM earlier_categories
                 UNION ALL SELECT 'Blob', count(*) FROM earlier_blobs
                 UNION ALL SELECT 'Item', count(*) FROM first_items
                 UNION ALL SELECT 'ItemBlob', count(*) FROM first_links)""",
        "first_links",
    ),
    "sliced_pass_items": statement("SELECT Id, CategoryId, Name FROM items", "items"),
    "sliced_pass_links": statement("SELECT * FROM second_links", "second_links"),
    "prune_guard_items": statement("SELECT Id, CategoryId, Name FROM first_items", "first_items"),
    "skipped_table_rows": statement("SELECT BlobId, Name FROM earlier_blobs", "earlier_blobs"),
    "stopped_pass_ledger": statement(
        """SELECT 'ItemCategory' AS TableName, 'Succeeded' AS Status, (SELECT count(*) FROM customer) AS RowsRead, (SELECT count(*) FROM customer) AS RowsStaged
           UNION ALL SELECT 'Blob', 'Succeeded', (SELECT count(*) FROM part), (SELECT count(*) FROM blobs)
           UNION ALL SELECT 'Item', 'Failed', NULL, NULL""",
        "blobs",
    ),
    "pass_outcomes": statement(
        """SELECT TableName, Outcome, n AS "Rows", CAST(sum(n) OVER (PARTITION BY TableName) AS BIGINT) AS LeftOut FROM (
               SELECT 'Blob' AS TableName, 'Name is missing' AS Outcome, count(*) AS n FROM part WHERE p_size = 1
               UNION ALL SELECT 'Item', 'filtered by exclude_deleted_items', count(*) FROM orders WHERE o_orderstatus = 'F'
               UNION ALL SELECT 'ItemBlob', 'duplicate', (SELECT count(*) FROM links) - (SELECT count(*) FROM one_link)
               UNION ALL SELECT 'ItemBlob', 'no Item for ItemId', count(*) FROM one_link WHERE ItemId NOT IN (SELECT Id FROM items)
               UNION ALL SELECT 'ItemBlob', 'no Blob for BlobId', count(*) FROM one_link
                         WHERE ItemId IN (SELECT Id FROM items) AND BlobId NOT IN (SELECT BlobId FROM blobs))
           WHERE n > 0""",
        "one_link", "items", "blobs",
    ),
    "extract_counts": """
        SELECT 'ItemCategory' AS TableName, count(*) AS "Rows" FROM customer
        UNION ALL SELECT 'Blob', count(*) FROM part
        UNION ALL SELECT 'Item', count(*) FROM orders
        UNION ALL SELECT 'ItemBlob', count(*) FROM lineitem""",
    "staged_file_listing": """
        SELECT 'itemcategory' AS folder, count(*) > 0 AS has_data FROM customer
        UNION ALL SELECT 'blob', count(*) > 0 FROM part
        UNION ALL SELECT 'item', count(*) > 0 FROM orders
        UNION ALL SELECT 'itemblob', count(*) > 0 FROM lineitem""",
    "newest_run_rows": f"SELECT '{SECOND}' AS run_id, o_orderkey AS ItemID FROM orders",
    "mixed_schema_scan": statement("SELECT Id, CategoryId, Name FROM staged_items", "staged_items"),
    "stream_incremental": statement(
        """SELECT coalesce(s.Id, t.Id) AS Id,
                  CASE WHEN s.Id IS NOT NULL THEN s.CategoryId ELSE t.CategoryId END AS CategoryId,
                  CASE WHEN s.Id IS NOT NULL THEN s.Name ELSE t.Name END AS Name
           FROM items s FULL JOIN first_items t ON s.Id = t.Id""",
        "items", "first_items",
    ),
}
