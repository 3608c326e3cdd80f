"""A pass that keeps what it leaves out ranks the staged rows once, in its merge."""

from dataclasses import replace

from pyspark.sql import functions as F

from tidemark.operators import duplicate_counts, first_and_count, first_per_key
from tidemark.options import SyncOptions
from tidemark.plans import sync
from tidemark.plans.ledger import RunLedger
from tidemark.plans.runs import run_pass
from tidemark.sources.extract import extract_run
from tidemark.sources.targets import TargetStore
from tidemark.spec import ColumnSpec, ParentRef, TableSpec

TOP = TableSpec("Top", "Id", (ColumnSpec("Id", ("Id",)), ColumnSpec("Name", ("Name",), "string")), "top", (), extract_columns=("Id", "Name"))
LOW = TableSpec(
    "Low", "Id",
    (ColumnSpec("Id", ("Id",)), ColumnSpec("TopId", ("TopId",)), ColumnSpec("SideId", ("SideId",)), ColumnSpec("Name", ("Name",), "string", reject_null=True)),
    "low", (ParentRef("Top", "TopId"), ParentRef("Top", "SideId")), prunable=True, extract_columns=("Id", "TopId", "SideId", "Name"),
)
TABLES = (TOP, LOW)


def staged(spark, low):
    top = spark.createDataFrame([(i, f"t{i}") for i in range(5)], "Id int, Name string")
    return {"Top": top, "Low": spark.createDataFrame(low, "Id int, TopId int, SideId int, Name string")}


def test_the_first_row_and_the_others_of_a_key(spark):
    nan = float("nan")
    rows = [(1, None, "b"), (1, 2.0, None), (1, 2.0, "a"), (2, None, None), (2, None, "z"), (3, nan, "q"), (3, 1.0, "q"), (4, None, None), (None, 1.0, "n"), (None, 1.0, "m"), (5, 0.5, "x"), (5, 0.5, "x")]
    df = spark.createDataFrame(rows, "Id int, A double, B string").repartition(3).withColumn("Flag", F.col("B") == "a")
    order = [F.col(c).asc_nulls_last() for c in ("A", "B")]
    got = first_and_count(df, "Id", ["A", "B"], "n")
    assert got.columns == ["Id", "A", "B", "Flag", "n"]
    assert sorted(map(str, got.drop("n").collect())) == sorted(map(str, first_per_key(df, "Id", order).collect()))
    twice = {(r["Id"], r["extra_rows"]) for r in duplicate_counts(df, "Id").collect()}
    assert {(r["Id"], r["n"]) for r in got.where("n > 0").collect()} == twice


def test_outcomes_come_from_the_merge(spark, tmp_path, monkeypatch):
    store, ledger = TargetStore(spark, str(tmp_path / "target"), slice_rows=5), RunLedger(spark, str(tmp_path / "ledger"))
    options = SyncOptions(stage_root=str(tmp_path / "stage"), quarantine_root=str(tmp_path / "left"), prune_missing_rows=True)
    ranked = []

    def outcomes(*args, of=sync.staged_outcomes):
        ranked.append(args[1].name)
        return of(*args)

    monkeypatch.setattr(sync, "staged_outcomes", outcomes)
    first = [(i, i % 5, i % 4, f"n{i}") for i in range(20)]
    later = [r for r in first if r[0] % 7] + [
        (1, 9, 1, "a"),  # the second of its key, which is sound
        (2, 0, 0, "a"), (2, 0, 0, "b"),  # another survivor
        (30, 8, 9, "x"), (31, 1, 9, "x"), (32, 8, 1, "x"),  # no parent in both columns, in the second, in the first
        (33, 8, 1, "a"), (33, 1, 1, "z"), (33, 8, 1, "a"),  # the survivor is sound
        (34, 0, 9, "a"), (34, 1, 1, "a"),  # the survivor is an orphan
        (3, None, 3, None), (40, 1, 1, None),  # filtered
        (5, 8, 0, "a"), (6, 1, None, "n6"),  # in the target; the sound row comes first, or has a reference that is missing last
    ]
    for run, rows in (("run_1", first), ("run_2", later), ("run_3", later)):
        extract_run(spark, TABLES, staged(spark, rows), options.stage_root, run)
        del ranked[:]
        summary = run_pass(spark, TABLES, store, ledger, replace(options, run_id=run))
        assert summary.failure is None
        found = sorted(tuple(r) for r in sync.read_outcomes(spark, options, run, LOW).collect())
        if run == "run_1":
            assert found == []
            continue
        assert "Low" not in ranked
        frame = spark.createDataFrame([r for r in rows if r[3]], LOW.schema)
        orphans = [(c, spark.createDataFrame([(v,) for v in vs], f"{c} int")) for c, vs in (("TopId", (8, 9)), ("SideId", (9, None)))]
        kept = [tuple(r) for r in sync.staged_outcomes(frame, LOW, orphans).collect()]
        assert found == sorted(kept + [("3", "Name is missing", 1), ("40", "Name is missing", 1)])
        assert {o for _, o, _ in found} >= {"duplicate", "no Top for SideId", "Name is missing"}
        told = next(t for t in summary.tables if t.table_name == "Low")
        assert sum(n for _, _, n in found) == told.rows_filtered + told.rows_rejected
    assert store.read(LOW).where("Id = 33").count() == 1 and store.read(LOW).where("Id IN (30, 31, 32, 34)").count() == 0
