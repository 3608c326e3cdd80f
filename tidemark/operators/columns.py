"""Finding staged columns by candidate names, at plan time."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from tidemark.errors import MappingError
from tidemark.options import SyncOptions
from tidemark.spec import TableSpec


def find_column(names: Iterable[str], aliases: Sequence[str]) -> str | None:
    """The staged name of the first alias that is present, ignoring case.

    Presence decides, not content: a column full of NULLs still wins over a
    later alias.
    """
    present = {name.lower(): name for name in names}
    return next((present[a.lower()] for a in aliases if a.lower() in present), None)


def has_column(names: Iterable[str], *aliases: str) -> bool:
    return find_column(names, aliases) is not None


def require_column(names: Sequence[str], aliases: Sequence[str]) -> str:
    found = find_column(names, aliases)
    if found is None:
        raise MappingError(
            f"A required column is absent: looked for [{', '.join(aliases)}], found "
            f"[{', '.join(names)}]. Add its staged name to the aliases of the column."
        )
    return found


def flag_warnings(names: Sequence[str], spec: TableSpec, options: SyncOptions) -> list[str]:
    """Filters that are switched on but have no staged column to look at."""
    return [
        f"{spec.name} was loaded without the filter {flag.option}: it looks at {flag.aliases[0]}, "
        f"and the files hold only [{', '.join(names)}]."
        for flag in spec.flags
        if getattr(options, flag.option) and not has_column(names, flag.aliases[0])
    ]
