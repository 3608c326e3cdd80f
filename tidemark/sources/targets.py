"""Target tables as versioned Parquet snapshots, committed together.

The rows of a table are dealt by a hash of the key into slices. A version names, for
every slice, the folder that holds it, a digest of its rows and the folders of keys
deleted from it since. A change writes new folders for the slices it touches, or only
the deleted keys, and carries the others over. Digests do not depend on the order of
rows, so a slice whose staged rows have the digest of its target rows is known to be
unchanged without reading it. Slices of a table that has many lie sorted in the files
of a few groups, and a reader takes its slices out of them.

Versions of tables become current through one small file per commit at the root,
which names the version of every table. Tables changed in a ``transaction`` are
therefore seen changed together or not at all, and a job that dies half-way leaves
the tables as they were. Folders are never read and overwritten at once.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import asdict, dataclass, field, replace
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import CommitConflictError
from tidemark.sources.files import create_text, delete_file, delete_folder, list_names, read_text
from tidemark.spec import TableSpec

# Names of commit files; whatever else lies beside them is no commit.
_COMMIT = re.compile(r"\d{20}\.json$")

SLICE = "slice"
# Slices of a table at most, so that a version stays a small file.
MAX_SLICES = 4096
# Tables of more slices than this keep them in so many groups; so many folders are listed without a job.
GROUPS = 32
# The folder of a group and the slice of a row in its files, and the end of the name of a folder of groups.
_GROUP, _MEMBER = "_group", "_slice"
_GROUPED = re.compile(r"\.g(\d+)$")
# A slice is rewritten once more than this share of its rows, or this many times, was deleted by keys.
FOLD_SHARE, FOLD_LISTS = 0.1, 8
# Keys are broadcast only if they were counted and are not more.
BROADCAST_KEYS = 200_000
# Attempts to commit while other writers commit other tables, and root commits that are kept.
_ATTEMPTS, _ROOT_COMMITS = 50, 100


@dataclass(frozen=True)
class Slice:
    """What a version says about one slice.

    ``stored`` rows lie in the folder, ``rows`` of them are not deleted. ``digest`` is of
    the rows that are left, and ``top`` their highest key, if it is known.
    """

    folder: str
    rows: int
    stored: int
    digest: tuple[int, int, int]
    top: int | None = None
    deletes: tuple[str, ...] = ()


@dataclass(frozen=True)
class Version:
    """What a version file says about a table. Without slices its rows are all that lies in ``folder``."""

    number: int
    folder: str
    rows: int
    buckets: int = 0
    high_water: int | None = None
    tags: Mapping[str, object] = field(default_factory=dict)
    committed_utc: str = ""
    slice_count: int = 0
    slices: Mapping[int, Slice] = field(default_factory=dict)
    file: str = ""
    parent: str | None = None

    @staticmethod
    def parsed(text: str, file: str) -> Version:
        found = json.loads(text)
        slices = {
            int(k): Slice(**{**s, "digest": tuple(s["digest"]), "deletes": tuple(s["deletes"])})
            for k, s in found.get("slices", {}).items()
        }
        return Version(**{**found, "slices": slices, "file": file})

    @property
    def folders(self) -> frozenset[str]:
        """Every folder that a reader of this version needs."""
        if not self.slice_count:
            return frozenset([self.folder])
        return frozenset(f for s in self.slices.values() for f in (s.folder, *s.deletes))


def slice_of(key: str, count: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(count)).cast("int")


def digest_columns(names: Iterable[str], where: Column | None = None) -> list[Column]:
    """Aggregates that are equal for equal bags of rows, or of rows ``where``: ``rows, xor, high, low``."""
    # a hash passes over NULLs, so each value is followed by whether it is one
    values = [c for n in names for c in (F.col(n), F.isnull(n))]
    one, two = F.xxhash64(F.lit(1), *values), F.xxhash64(F.lit(2), *values)
    if where is not None:
        one, two = F.when(where, one), F.when(where, two)
    none = F.lit(0).cast("bigint")
    return [
        F.count(F.lit(1) if where is None else one).alias("rows"),
        F.coalesce(F.bit_xor(one), none).alias("xor"),
        # halves of the hash, whose sums cannot overflow
        F.coalesce(F.sum(F.shiftright(two, 32)), none).alias("high"),
        F.coalesce(F.sum(two.bitwiseAND(F.lit(0xFFFFFFFF))), none).alias("low"),
    ]


def slice_columns(spec: TableSpec, where: Column | None = None) -> list[Column]:
    """Aggregates from which ``slice_from`` makes the slice of all rows, or of rows ``where``."""
    key = F.col(spec.key) if where is None else F.when(where, F.col(spec.key))
    return [*digest_columns(spec.column_names, where), F.max(key).cast("bigint").alias("top")]


def slice_from(found: Row, folder: str) -> Slice:
    return Slice(folder, found["rows"], found["rows"], (found["xor"], found["high"], found["low"]), found["top"])


class TargetStore:
    """The target tables below one root folder.

    A new table gets one slice for every ``slice_rows`` expected rows, and more when it
    has outgrown them four times. Tables of ``bucket_rows`` rows or more, if that is
    set, are instead written whole and bucketed by key into as many buckets as the
    session has shuffle partitions, so that a merge reads them without a shuffle;
    Spark buckets through the session catalog.
    """

    def __init__(self, spark: SparkSession, root: str, bucket_rows: int | None = None, slice_rows: int = 250_000):
        self.spark = spark
        self.root = root.rstrip("/")
        self.bucket_rows = bucket_rows
        self.slice_rows = slice_rows
        self._pending: dict[str, tuple[Version | None, Version]] | None = None

    # Versions and commits.

    def _commits(self, name: str) -> str:
        return f"{self.root}/{name}/_commits"

    def _root(self) -> tuple[int, dict[str, str]]:
        """Number of the newest root commit, and the version file of each table in it."""
        names = [n for n in list_names(self.spark, f"{self.root}/_commits", directories=False) if _COMMIT.match(n)]
        if not names:
            return 0, {}
        newest = max(names)
        return int(newest[:20]), json.loads(read_text(self.spark, f"{self.root}/_commits/{newest}"))["tables"]

    def _file_of(self, name: str, tables: Mapping[str, str]) -> str | None:
        if name in tables:
            return tables[name]
        # a table that was last written before tables were committed together
        return max((n for n in list_names(self.spark, self._commits(name), directories=False) if _COMMIT.match(n)), default=None)

    def _version(self, name: str, file: str) -> Version:
        return Version.parsed(read_text(self.spark, f"{self._commits(name)}/{file}"), file)

    def current(self, name: str) -> Version | None:
        """The newest version; within a transaction, the one it will commit."""
        if self._pending and name in self._pending:
            return self._pending[name][1]
        file = self._file_of(name, self._root()[1])
        return self._version(name, file) if file else None

    @contextmanager
    def transaction(self) -> Iterator[TargetStore]:
        """Commits made inside become visible together at the end, or not at all."""
        if self._pending is not None:
            yield self
            return
        self._pending = {}
        try:
            yield self
            if self._pending:
                self._publish(self._pending)
        finally:
            self._pending = None

    def _publish(self, changes: Mapping[str, tuple[Version | None, Version]]) -> None:
        for name, (_, version) in changes.items():
            text = json.dumps({k: v for k, v in asdict(version).items() if k != "file"})
            create_text(self.spark, f"{self._commits(name)}/{version.file}", text)
        for _ in range(_ATTEMPTS):
            number, tables = self._root()
            for name, (base, version) in changes.items():
                if self._file_of(name, tables) != (base.file if base else None):
                    raise CommitConflictError(
                        f"Version {version.number} of {name} was committed by another writer."
                    )
            merged = {**tables, **{name: version.file for name, (_, version) in changes.items()}}
            if create_text(self.spark, f"{self.root}/_commits/{number + 1:020d}.json", json.dumps({"tables": merged})):
                return
        raise CommitConflictError("Other writers committed without a pause; the tables were not changed.")

    def _commit_version(self, name: str, previous: Version | None, version: Version) -> Version:
        number = (previous.number if previous else 0) + 1
        version = replace(
            version,
            number=number,
            committed_utc=datetime.now(timezone.utc).isoformat(timespec="milliseconds"),
            file=f"{number:020d}-{uuid.uuid4().hex}.json",
            parent=previous.file if previous else None,
        )
        if self._pending is None:
            self._publish({name: (previous, version)})
        else:
            base = self._pending[name][0] if name in self._pending else previous
            if name in self._pending:
                version = replace(version, number=(base.number if base else 0) + 1, parent=base.file if base else None)
            self._pending[name] = (base, version)
        return version

    def commit(
        self,
        spec: TableSpec,
        previous: Version | None,
        folder: str,
        rows: int,
        buckets: int,
        high_water: int | None = None,
        tags: Mapping[str, object] | None = None,
    ) -> Version:
        """Make a whole folder the current version, unless another writer was first.

        The folder of the previous version stands for its slices, so that a mark or a tag
        can be set alone.
        """
        same = previous is not None and folder == previous.folder
        version = Version(
            number=0,
            folder=folder,
            rows=rows,
            buckets=buckets,
            high_water=high_water,
            tags={**(previous.tags if previous else {}), **(tags or {})},
            slice_count=previous.slice_count if same else 0,
            slices=previous.slices if same else {},
        )
        return self._commit_version(spec.name, previous, version)

    def commit_slices(
        self,
        spec: TableSpec,
        previous: Version | None,
        slices: Mapping[int, Slice],
        slice_count: int,
        folder: str,
        buckets: int = 0,
        high_water: int | None = None,
        tags: Mapping[str, object] | None = None,
    ) -> Version:
        version = Version(
            number=0,
            folder=folder,
            rows=sum(s.rows for s in slices.values()),
            buckets=buckets,
            high_water=high_water,
            tags={**(previous.tags if previous else {}), **(tags or {})},
            slice_count=slice_count,
            slices={k: s for k, s in sorted(slices.items()) if s.rows},
        )
        return self._commit_version(spec.name, previous, version)

    # Reading.

    def _path(self, spec: TableSpec, folder: str, number: int, version: Version) -> str:
        whole = f"{self.root}/{spec.name}/{folder}"
        if version.slice_count == 1:
            return whole
        groups = _GROUPED.search(folder)
        return f"{whole}/{_GROUP}={number * int(groups[1]) // version.slice_count}" if groups else f"{whole}/{SLICE}={number}"

    def _rows_of(self, spec: TableSpec, version: Version, schema: T.StructType, places: Iterable[tuple[str, int]]) -> DataFrame:
        """The rows of slices, each given with the folder to take it from."""
        alone, grouped = [], {}
        for folder, number in places:
            if _GROUPED.search(folder):
                grouped.setdefault(folder, set()).add(number)
            else:
                alone.append(self._path(spec, folder, number, version))
        parts = [self.spark.read.schema(schema).parquet(*alone)] if alone else []
        for folder, numbers in grouped.items():
            paths = sorted({self._path(spec, folder, k, version) for k in numbers})
            rows = self.spark.read.schema(T.StructType([*schema, T.StructField(_MEMBER, T.IntegerType())])).parquet(*paths)
            if len(numbers) < version.slice_count:
                # the other slices of these groups lie in other folders by now, or are not asked for
                rows = rows.where(F.expr(f"{_MEMBER} IN ({', '.join(map(str, sorted(numbers)))})"))
            parts.append(rows.select(*[F.col(f"`{name}`") for name in schema.names]))
        return reduce(DataFrame.unionByName, parts)

    def read(self, spec: TableSpec) -> DataFrame:
        """The current rows; a table that was never loaded is empty."""
        version = self.current(spec.name)
        return self.read_version(spec, version)

    def read_version(self, spec: TableSpec, version: Version | None, only: Iterable[int] | None = None) -> DataFrame:
        """The rows of a version, or those of some of its slices; no file that holds none of them is opened."""
        if version is not None and not version.slice_count:
            return self.spark.read.schema(spec.schema).parquet(f"{self.root}/{spec.name}/{version.folder}")
        wanted = {} if version is None else version.slices if only is None else {k: version.slices[k] for k in only if k in version.slices}
        if not wanted:
            return self.spark.createDataFrame([], spec.schema)
        rows = self._rows_of(spec, version, spec.schema, [(s.folder, k) for k, s in wanted.items()])
        return self._without_deleted(spec, version, wanted, rows)

    def _without_deleted(self, spec: TableSpec, version: Version, wanted: Mapping[int, Slice], rows: DataFrame) -> DataFrame:
        places = [(f, k) for k, s in wanted.items() for f in s.deletes]
        if not places:
            return rows
        keys = self._rows_of(spec, version, T.StructType([spec.schema[spec.key]]), places)
        if sum(s.stored - s.rows for s in wanted.values()) <= BROADCAST_KEYS:
            keys = F.broadcast(keys)
        return rows.join(keys, spec.key, "left_anti")

    def read_by_key(self, spec: TableSpec) -> DataFrame:
        """The current rows in a form that joins on the key without a shuffle, if bucketed.

        For joins on other columns use ``read``: only a shuffled side can be
        split when a value is skewed.
        """
        version = self.current(spec.name)
        if version is None or not version.buckets:
            return self.read(spec)
        table = f"tidemark_{uuid.uuid4().hex}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spec.schema)
        folder = f"{self.root}/{spec.name}/{version.folder}".replace("'", "\\'")
        self.spark.sql(
            f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY (`{spec.key}`) "
            f"SORTED BY (`{spec.key}`) INTO {version.buckets} BUCKETS LOCATION '{folder}'"
        )
        try:
            return self._without_deleted(spec, version, version.slices, self.spark.table(table))
        finally:
            # The catalog entry is needed to resolve the table, not to read it.
            self.spark.sql(f"DROP TABLE {table}")

    # Writing.

    def slices_for(self, previous: Version | None, expected_rows: int) -> int:
        """How many slices a table should have; it keeps those it has until it has outgrown them."""
        if self._bucketed(expected_rows):
            return 1
        wanted = min(MAX_SLICES, 1 << max(0, -(-expected_rows // self.slice_rows) - 1).bit_length())
        held = previous.slice_count if previous and not previous.buckets else 0
        return held if held and wanted <= 4 * held else wanted

    def _bucketed(self, expected_rows: int) -> bool:
        return self.bucket_rows is not None and expected_rows >= self.bucket_rows

    def new_folder(self, slice_count: int = 1, kind: str = "version") -> str:
        return f"{kind}-{uuid.uuid4().hex}" + (f".g{GROUPS}" if slice_count > GROUPS else "")

    def _write_slices(self, spec: TableSpec, df: DataFrame, slice_count: int, path: str) -> None:
        """One more shuffle, of the rows to be written, gives each slice or group a few files of good size."""
        number = slice_of(spec.key, slice_count)
        if slice_count <= GROUPS:
            df.withColumn(SLICE, number).hint("rebalance", SLICE).write.partitionBy(SLICE).parquet(path)
            return
        dealt = df.withColumn(_MEMBER, number).withColumn(_GROUP, F.expr(f"int({_MEMBER} * {GROUPS} div {slice_count})"))
        dealt.hint("rebalance", _GROUP).sortWithinPartitions(_GROUP, _MEMBER).write.partitionBy(_GROUP).parquet(path)

    def write(self, spec: TableSpec, df: DataFrame, expected_rows: int, slice_count: int = 1) -> tuple[str, int]:
        """Write a new, uncommitted folder; its name and its number of buckets."""
        folder = self.new_folder(slice_count)
        path = f"{self.root}/{spec.name}/{folder}"
        if slice_count > 1:
            self._write_slices(spec, df, slice_count, path)
            return folder, 0
        if not self._bucketed(expected_rows):
            df.write.parquet(path)
            return folder, 0
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        table = f"tidemark_{uuid.uuid4().hex}"
        (
            df.write.format("parquet")
            .bucketBy(buckets, spec.key)
            .sortBy(spec.key)
            .option("path", path)
            .saveAsTable(table)
        )
        self.spark.sql(f"DROP TABLE {table}")
        return folder, buckets

    def digest(self, spec: TableSpec, folder: str, slice_count: int) -> dict[int, Slice]:
        """The slices of a written folder, by one scan of it; at most ``MAX_SLICES`` rows come to the driver."""
        rows = self.spark.read.schema(spec.schema).parquet(f"{self.root}/{spec.name}/{folder}")
        found = rows.groupBy(slice_of(spec.key, slice_count).alias(SLICE)).agg(*slice_columns(spec))
        return {r[SLICE]: slice_from(r, folder) for r in found.collect()}

    def delete(self, spec: TableSpec, previous: Version, hits: DataFrame) -> tuple[int, DataFrame]:
        """Delete rows of a version, given as ``hits``; how many, and their keys.

        Only the keys are written. Slices that have lost much by such lists are rewritten
        without them. A version without slices gets them by being rewritten.
        """
        kind = spec.schema[spec.key].dataType.simpleString()
        count = previous.slice_count or self.slices_for(None, previous.rows)
        folder = self.new_folder(count, "deletes")
        path = f"{self.root}/{spec.name}/{folder}"
        if count == 1:
            hits.write.parquet(path)
        else:
            self._write_slices(spec, hits, count, path)
        gone = self.digest(spec, folder, count)
        lost = sum(s.rows for s in gone.values())
        keys = self.spark.read.schema(f"`{spec.key}` {kind}").parquet(path)
        if not lost:
            self.discard(spec, folder)
            return 0, self.spark.createDataFrame([], keys.schema)
        slices = dict(previous.slices)
        folded = set() if previous.slice_count else set(range(count))
        for k, g in gone.items() if previous.slice_count else ():
            old = slices[k]
            digest = (old.digest[0] ^ g.digest[0], old.digest[1] - g.digest[1], old.digest[2] - g.digest[2])
            top = old.top if old.top is not None and g.top is not None and g.top < old.top else None
            slices[k] = Slice(old.folder, old.rows - g.rows, old.stored, digest, top, (*old.deletes, folder))
            if old.stored - slices[k].rows > FOLD_SHARE * old.stored or len(slices[k].deletes) > FOLD_LISTS:
                folded.add(k)
        name, buckets = previous.folder, previous.buckets
        if folded:
            only = folded if previous.slice_count else None
            left = self.read_version(spec, previous, only).join(keys, spec.key, "left_anti")
            name, buckets = self.write(spec, left, previous.rows, count)
            slices = {k: s for k, s in slices.items() if k not in folded} | self.digest(spec, name, count)
        self.commit_slices(spec, previous, slices, count, name, buckets, previous.high_water)
        return lost, keys

    def highest_key(self, spec: TableSpec, version: Version | None) -> int:
        """The highest key, or 0. Only slices whose highest key was deleted are read."""
        if version is None:
            return 0
        unknown = [k for k, s in version.slices.items() if s.top is None]
        known = max((s.top for s in version.slices.values() if s.top is not None), default=0)
        if version.slice_count and not unknown:
            return known
        rows = self.read_version(spec, version, unknown if version.slice_count else None)
        read = rows.agg(F.coalesce(F.max(F.col(spec.key)), F.lit(0)).cast("bigint").alias("top")).first()["top"]
        return max(read, known)

    # Clean-up.

    def discard(self, spec: TableSpec, folder: str) -> None:
        """Remove a folder that was written but will not be committed."""
        delete_folder(self.spark, f"{self.root}/{spec.name}/{folder}")

    def _history(self, name: str) -> list[Version]:
        """Committed versions, newest first, as far back as their files are kept."""
        present = set(list_names(self.spark, self._commits(name), directories=False))
        file, found = self._file_of(name, self._root()[1]), []
        while file in present:
            found.append(self._version(name, file))
            file = found[-1].parent
            if file is None and _COMMIT.match(found[-1].file):
                file = max((n for n in present if _COMMIT.match(n) and n < found[-1].file), default=None)
        return found

    def drop_old_versions(self, spec: TableSpec, keep_last: int = 2) -> list[str]:
        """Delete the folders of older commits that none of the last commits names.

        A folder that no commit names may be another writer's work and stays.
        """
        history = self._history(spec.name)
        # Commits that only move a mark name the same folders again and do not count.
        distinct = list(dict.fromkeys(v.folders for v in history))
        kept = frozenset().union(*distinct[: max(keep_last, 1)])
        named = frozenset().union(*distinct)
        folders = list_names(self.spark, f"{self.root}/{spec.name}", directories=True)
        old = [f for f in folders if f in named - kept]
        for folder in old:
            self.discard(spec, folder)
        for version in history:
            if not version.folders & kept and version.folders:
                delete_file(self.spark, f"{self._commits(spec.name)}/{version.file}")
        roots = sorted(n for n in list_names(self.spark, f"{self.root}/_commits", directories=False) if _COMMIT.match(n))
        for name in roots[:-_ROOT_COMMITS]:
            delete_file(self.spark, f"{self.root}/_commits/{name}")
        return old

    def high_waters(self, specs: list[TableSpec]) -> DataFrame:
        """Stored mark per identity table."""
        rows = [
            (s.name, v.high_water if (v := self.current(s.name)) else None)
            for s in specs
            if s.identity
        ]
        return self.spark.createDataFrame(rows, "TableName string, CurrentIdentity bigint").orderBy(
            F.col("TableName")
        )
