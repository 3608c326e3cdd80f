"""Width rules for text columns, counted in UTF-16 units."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def utf16_length(column: Column) -> Column:
    return F.shiftright(F.octet_length(F.encode(column, "UTF-16BE")), 1)


def too_wide(column: Column, width: int) -> Column:
    """True when the value needs shortening; NULL counts as short.

    A value never has more UTF-16 units than UTF-8 bytes, so the cheap byte
    length settles almost every row before anything is encoded.
    """
    return F.coalesce(
        (F.octet_length(column) > width) & (utf16_length(column) > width), F.lit(False)
    )


def fit_width(column: Column, width: int) -> Column:
    """Keep the first ``width`` units and never half of a surrogate pair."""
    units = F.encode(column, "UTF-16BE")
    last = F.hex(F.substring(units, 2 * width - 1, 1))
    whole = F.decode(F.substring(units, 1, 2 * width), "UTF-16BE")
    without_half_pair = F.decode(F.substring(units, 1, 2 * width - 2), "UTF-16BE")
    return F.when(
        too_wide(column, width),
        F.when(last.between("D8", "DB"), without_half_pair).otherwise(whole),
    ).otherwise(column)
