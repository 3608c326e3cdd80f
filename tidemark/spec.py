"""Declarative table descriptions: columns, keys, parents and row filters."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import types as T

from tidemark.errors import ConfigurationError

# The types a declared column may have.
COLUMN_TYPES = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
}


@dataclass(frozen=True)
class ColumnSpec:
    """One target column and the staged names it may come from, best first.

    A NULL in a ``required`` column fails the table; a NULL in a
    ``reject_null`` column drops (and counts) the row; otherwise NULL is kept.
    """

    name: str
    aliases: tuple[str, ...]
    type: str = "int"
    required: bool = False
    reject_null: bool = False
    width: int | None = None
    collation: str | None = None

    @property
    def data_type(self) -> T.DataType:
        return COLUMN_TYPES[self.type]


@dataclass(frozen=True)
class FlagFilter:
    """Drop staged rows whose boolean flag equals ``drop_when``, if ``option`` is on."""

    option: str
    aliases: tuple[str, ...]
    drop_when: bool


@dataclass(frozen=True)
class ParentRef:
    """``column`` must hold a key that exists in ``table``."""

    table: str
    column: str


@dataclass(frozen=True)
class TableSpec:
    name: str
    key: str
    columns: tuple[ColumnSpec, ...]
    folder: str
    parents: tuple[ParentRef, ...] = ()
    flags: tuple[FlagFilter, ...] = ()
    prunable: bool = False
    identity: bool = False
    # Source table name and the columns the extract job takes from it.
    source_table: str | None = None
    extract_columns: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        names = [c.name for c in self.columns]
        if self.key not in names:
            raise ConfigurationError(f"{self.name}: key '{self.key}' is not one of {names}.")
        unknown = [c.type for c in self.columns if c.type not in COLUMN_TYPES]
        if unknown:
            raise ConfigurationError(f"{self.name}: unsupported column types {unknown}.")
        stray = [p.column for p in self.parents if p.column not in names]
        if stray:
            raise ConfigurationError(f"{self.name}: parent columns {stray} are not declared.")

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def value_names(self) -> list[str]:
        return [c.name for c in self.columns if c.name != self.key]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.data_type, True) for c in self.columns])

    @property
    def collations(self) -> dict[str, str]:
        return {c.name: c.collation for c in self.columns if c.collation}

    @property
    def source_columns(self) -> list[str]:
        """Every staged name the mapping may read; nothing else is scanned."""
        groups = [c.aliases for c in self.columns] + [f.aliases for f in self.flags]
        return list(dict.fromkeys(name for group in groups for name in group))

    def with_integer_type(self, type_name: str) -> TableSpec:
        """The same table with every integer column widened (or narrowed) to ``type_name``."""
        return replace(
            self,
            columns=tuple(
                replace(c, type=type_name) if c.type in ("int", "bigint") else c
                for c in self.columns
            ),
        )


def load_order(specs: Iterable[TableSpec]) -> list[TableSpec]:
    """Order tables so that every parent comes before its children.

    Tables keep their given order where the parents allow it. Parents outside
    the given set are taken to be loaded already.
    """
    waiting = list(specs)
    names = {s.name for s in waiting}
    if len(names) != len(waiting):
        raise ConfigurationError("Table names must be unique.")
    ordered: list[TableSpec] = []
    while waiting:
        done = {s.name for s in ordered}
        ready = next(
            (
                s
                for s in waiting
                if all(p.table in done or p.table not in names or p.table == s.name for p in s.parents)
            ),
            None,
        )
        if ready is None:
            raise ConfigurationError(
                f"Tables {[s.name for s in waiting]} reference each other in a cycle."
            )
        waiting.remove(ready)
        ordered.append(ready)
    return ordered


def children_of(name: str, specs: Sequence[TableSpec]) -> list[tuple[TableSpec, str]]:
    """The tables that reference ``name``, each with its foreign-key column."""
    return [(s, p.column) for s in specs for p in s.parents if p.table == name and s.name != name]


def descendants(name: str, specs: Sequence[TableSpec]) -> set[str]:
    """The tables that reference ``name``, directly or through others."""
    found: set[str] = set()
    waiting = [name]
    while waiting:
        for child, _ in children_of(waiting.pop(), specs):
            if child.name not in found and child.name != name:
                found.add(child.name)
                waiting.append(child.name)
    return found
