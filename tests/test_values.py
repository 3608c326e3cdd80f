from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import MappingError
from tidemark.functions import fit_width, required, to_boolean, to_integer, to_text, too_wide


def one(spark, values, kind, make):
    df = spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("c", kind)]))
    return [r[0] for r in df.select(make(F.col("c"), kind)).collect()]


def integer(spark, values, kind, target="int"):
    return one(spark, values, kind, lambda c, k: to_integer(c, k, target, "c"))


def test_integers_pass_and_nulls_stay(spark):
    assert integer(spark, [42, None], T.LongType()) == [42, None]
    assert integer(spark, [7, None], T.IntegerType()) == [7, None]
    assert integer(spark, [True, False, None], T.BooleanType()) == [1, 0, None]


def test_halves_round_to_even(spark):
    assert integer(spark, [0.5, 1.5, 2.5, 3.5, -2.5, 2.4], T.DoubleType()) == [0, 2, 2, 4, -2, 2]
    assert integer(spark, [Decimal("2.5"), Decimal("3.5"), None], T.DecimalType(4, 1)) == [2, 4, None]


def test_numeric_text(spark):
    assert integer(spark, [" 12 ", "-5", "+7", None], T.StringType()) == [12, -5, 7, None]


@pytest.mark.parametrize(
    "value, kind",
    [
        (2**31, T.LongType()),
        (2147483647.5, T.DoubleType()),
        (float("nan"), T.DoubleType()),
        ("3.5", T.StringType()),
        ("99999999999", T.StringType()),
        ("", T.StringType()),
    ],
)
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_values_that_do_not_fit_raise(spark, value, kind, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(PySparkException, match="does not fit int"):
            integer(spark, [value], kind)
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_bigint_keeps_64_bits(spark):
    assert integer(spark, [2**62, -(2**63)], T.LongType(), "bigint") == [2**62, -(2**63)]
    with pytest.raises(PySparkException):
        integer(spark, [2.0**63], T.DoubleType(), "bigint")


def test_types_without_a_number_are_refused(spark):
    for kind in (T.TimestampType(), T.BinaryType(), T.DateType(), T.ArrayType(T.IntegerType())):
        with pytest.raises(MappingError):
            to_integer(F.col("c"), kind, "int", "c")


def test_boolean_text_is_strict(spark):
    def flags(values, kind):
        return one(spark, values, kind, lambda c, k: to_boolean(c, k, "c"))

    assert flags([True, False, None], T.BooleanType()) == [True, False, None]
    assert flags([" TRUE ", "false", "False", None], T.StringType()) == [True, False, False, None]
    assert flags([0, 1, -3, None], T.IntegerType()) == [False, True, True, None]
    assert flags([0.0, 0.5], T.DoubleType()) == [False, True]
    for word in ("yes", "1", "t", ""):
        with pytest.raises(PySparkException, match="not a boolean"):
            flags([word], T.StringType())
    with pytest.raises(MappingError):
        to_boolean(F.col("c"), T.TimestampType(), "c")


def text(spark, values, kind):
    return one(spark, values, kind, lambda c, k: to_text(c, k, "c"))


def test_text_of_other_types(spark):
    assert text(spark, [True, False, None], T.BooleanType()) == ["True", "False", None]
    assert text(spark, [12, None], T.IntegerType()) == ["12", None]
    assert text(spark, [Decimal("1.50")], T.DecimalType(4, 2)) == ["1.50"]
    assert text(spark, [datetime(2024, 1, 2, 13, 4, 5)], T.TimestampType()) == ["01/02/2024 13:04:05"]
    assert text(spark, [date(2024, 1, 2)], T.DateType()) == ["01/02/2024 00:00:00"]
    with pytest.raises(MappingError):
        to_text(F.col("c"), T.BinaryType(), "c")


def test_text_of_doubles(spark):
    cases = {
        1.0: "1", -2.5: "-2.5", 0.0: "0", 0.1: "0.1", 1e7: "10000000", 123456789.25: "123456789.25",
        0.0001: "0.0001", 1e-5: "1E-05", 1.5e-7: "1.5E-07", 1e15: "1E+15", 1.25e20: "1.25E+20",
        1e100: "1E+100", float("inf"): "Infinity", float("-inf"): "-Infinity", float("nan"): "NaN",
    }
    assert text(spark, list(cases), T.DoubleType()) == list(cases.values())
    assert text(spark, [1.5, 1e7, None], T.FloatType()) == ["1.5", "1E+07", None]


def fit(spark, values, width):
    df = spark.createDataFrame([(v,) for v in values], "c string")
    return [
        tuple(r) for r in df.select(fit_width(F.col("c"), width), too_wide(F.col("c"), width)).collect()
    ]


def test_width_in_utf16_units(spark):
    emoji = "\U0001f600"
    values = ["x" * 200, "x" * 100, None, "x" * 99 + emoji, "x" * 98 + emoji, "é" * 100, "é" * 101, emoji * 51]
    assert fit(spark, values, 100) == [
        ("x" * 100, True),
        ("x" * 100, False),
        (None, False),
        ("x" * 99, True),
        ("x" * 98 + emoji, False),
        ("é" * 100, False),
        ("é" * 100, True),
        (emoji * 50, True),
    ]


def test_required_names_the_column(spark, tmp_path):
    df = spark.createDataFrame([(1,), (None,)], "c int")
    with pytest.raises(PySparkException, match="'ItemID' is null.*NOT NULL"):
        df.select(required(F.col("c"), "ItemID").alias("c")).write.parquet(str(tmp_path / "out"))
