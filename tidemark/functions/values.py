"""Value conversions as Column expressions, chosen by the staged data type.

The rules are those of invariant-culture conversions: integers round halves to
even and never wrap, only ``true``/``false`` count as boolean text, booleans
print as ``True``/``False`` and doubles print without a trailing ``.0``.
They do not depend on ``spark.sql.ansi.enabled``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import MappingError

# Inclusive ranges of the two integer types.
INTEGER_RANGE = {
    "int": (-(2**31), 2**31 - 1),
    "bigint": (-(2**63), 2**63 - 1),
}

# White space accepted around a number or a boolean word.
_BLANK = r"[\t-\r ]*"
_INTEGER_TEXT = rf"^{_BLANK}([+-]?[0-9]+){_BLANK}$"
_BOOLEAN_TEXT = rf"^{_BLANK}([A-Za-z]+){_BLANK}$"


def _unsupported(data_type: T.DataType, wanted: str, label: str) -> MappingError:
    return MappingError(
        f"Column '{label}' has type {data_type.simpleString()}, which cannot be read as {wanted}."
    )


def _fail(text: str, column: Column) -> Column:
    return F.raise_error(F.concat(F.lit(text), F.coalesce(column.cast("string"), F.lit("NULL"))))


def to_integer(column: Column, data_type: T.DataType, target: str, label: str) -> Column:
    """Convert to ``int`` or ``bigint``; out-of-range or non-numeric values raise."""
    low, high = INTEGER_RANGE[target]
    problem = f"Column '{label}' holds a value that does not fit {target}: "

    if isinstance(data_type, T.NullType):
        return F.lit(None).cast(target)
    if isinstance(data_type, T.BooleanType):
        return column.cast(target)
    if isinstance(data_type, (T.ByteType, T.ShortType, T.IntegerType)) or (
        isinstance(data_type, T.LongType) and target == "bigint"
    ):
        return column.cast(target)
    if isinstance(data_type, T.StringType):
        parsed = F.regexp_extract(column, _INTEGER_TEXT, 1).try_cast(target)
        return F.when(column.isNotNull() & parsed.isNull(), _fail(problem, column)).otherwise(parsed)

    if isinstance(data_type, T.LongType):
        whole = column
    elif isinstance(data_type, (T.FloatType, T.DoubleType)):
        whole = F.rint(column.cast("double"))
    elif isinstance(data_type, T.DecimalType):
        whole = F.bround(column, 0)
    else:
        raise _unsupported(data_type, target, label)

    # 2^63 - 1 has no double, so the upper bound is tested as "below high + 1".
    in_range = (whole >= F.lit(low)) & (
        whole < F.lit(float(high + 1)) if isinstance(data_type, (T.FloatType, T.DoubleType))
        else whole <= F.lit(high)
    )
    return (
        F.when(whole.isNull(), F.lit(None).cast(target))
        .when(in_range, whole.cast(target))
        .otherwise(_fail(problem, column))
    )


def to_boolean(column: Column, data_type: T.DataType, label: str) -> Column:
    """Convert to boolean: numbers by ``<> 0``, text only from true/false."""
    if isinstance(data_type, T.NullType):
        return F.lit(None).cast("boolean")
    if isinstance(data_type, T.BooleanType):
        return column
    if isinstance(data_type, T.NumericType):
        return column != F.lit(0)
    if isinstance(data_type, T.StringType):
        word = F.lower(F.regexp_extract(column, _BOOLEAN_TEXT, 1))
        return (
            F.when(column.isNull(), F.lit(None).cast("boolean"))
            .when(word == "true", F.lit(True))
            .when(word == "false", F.lit(False))
            .otherwise(_fail(f"Column '{label}' holds text that is not a boolean: ", column))
        )
    raise _unsupported(data_type, "boolean", label)


def _floating_text(column: Column, data_type: T.DataType) -> Column:
    """Shortest text of a float: plain up to 15 (7 for single) digits, else E notation."""
    limit = 1e7 if isinstance(data_type, T.FloatType) else 1e15
    shortest = column.cast("string")
    size = F.abs(column.cast("double"))
    # Digits of the shortest text without exponent, by way of an exact decimal.
    plain = F.regexp_replace(
        F.regexp_replace(shortest.try_cast(T.DecimalType(38, 22)).cast("string"), r"0+$", ""),
        r"\.$", "",
    )
    mantissa = F.regexp_replace(F.regexp_extract(shortest, r"^(-?[0-9.]+)E", 1), r"\.0$", "")
    exponent = F.regexp_extract(shortest, r"E(-?[0-9]+)$", 1).try_cast("int")
    scientific = F.concat(
        mantissa,
        F.when(exponent < 0, F.lit("E-")).otherwise(F.lit("E+")),
        F.lpad(F.abs(exponent).cast("string"), F.greatest(F.lit(2), F.length(F.abs(exponent).cast("string"))), F.lit("0")),
    )
    return (
        F.when(F.isnan(column) | (size == float("inf")), shortest)
        .when(size == 0, F.when(shortest.startswith("-"), F.lit("-0")).otherwise(F.lit("0")))
        .when((size >= 1e-4) & (size < limit), plain)
        .otherwise(scientific)
    )


def to_text(column: Column, data_type: T.DataType, label: str) -> Column:
    """Convert to text; binary and nested values are refused."""
    if isinstance(data_type, T.NullType):
        return F.lit(None).cast("string")
    if isinstance(data_type, T.StringType):
        return column
    if isinstance(data_type, T.BooleanType):
        return F.initcap(column.cast("string"))
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return _floating_text(column, data_type)
    if isinstance(data_type, T.NumericType):
        return column.cast("string")
    if isinstance(data_type, T.DateType):
        return F.date_format(column, "MM/dd/yyyy HH:mm:ss")
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        if isinstance(data_type, T.TimestampType):
            column = F.to_utc_timestamp(column, F.current_timezone())
        return F.date_format(column, "MM/dd/yyyy HH:mm:ss")
    raise _unsupported(data_type, "string", label)


def convert(column: Column, data_type: T.DataType, target: str, label: str) -> Column:
    if target in INTEGER_RANGE:
        return to_integer(column, data_type, target, label)
    if target == "boolean":
        return to_boolean(column, data_type, label)
    return to_text(column, data_type, label)


def required(column: Column, label: str) -> Column:
    """The value itself, or an error that names the column when it is NULL."""
    return F.coalesce(
        column, F.raise_error(F.lit(f"'{label}' is null in a staged row; its target column is NOT NULL."))
    )
