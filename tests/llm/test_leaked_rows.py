"""Decontamination drops the rows that hold an item, and no other row with their id."""

from tidemark.llm import leaks

ITEM = "nothing else is said of the matter by anyone who was there"


def test_only_leaked_rows_go(spark):
    clean = [(None, f"a clean text of number {i} that holds no item at all") for i in range(5)] + [(None, None), (7, "clean under an id twice")]
    rows = [*clean, (None, f"before it {ITEM} and after"), (7, f"{ITEM} again"), (8, ITEM)]
    items = spark.createDataFrame([(1, ITEM)], "item_id bigint, text string")
    left = leaks.drop_leaked(spark.createDataFrame(rows, "doc_id bigint, text string"), items).collect()
    assert sorted(map(repr, map(tuple, left))) == sorted(map(repr, clean))
