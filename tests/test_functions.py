from datetime import date, datetime, timedelta, timezone
from decimal import Decimal
import hashlib
import unicodedata
import sys

import pytest
from pyspark.sql import functions as F

from tidemill import functions as fn
from tidemill.functions.text import SPACE_SEPARATORS


def value(spark, text, build, type_name="string"):
    df = spark.createDataFrame([(text,)], f"x {type_name}")
    return df.select(build("x").alias("y")).first()["y"]


def test_separators_are_the_unicode_category():
    assert SPACE_SEPARATORS == "".join(
        chr(c) for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c)) == "Zs"
    )


@pytest.mark.parametrize(
    "text, expected",
    [
        ("\ta   ", "\ta"),
        ("  a b  ", "a b"),
        ("　ção ", "ção"),
        (" \n", "\n"),
        ("", ""),
        ("   ", ""),
        (None, None),
    ],
)
def test_trim(spark, text, expected):
    assert value(spark, text, fn.trim) == expected


def test_trim_every_separator_at_both_ends(spark):
    df = spark.createDataFrame([(c + "é" + c,) for c in SPACE_SEPARATORS], "x string")
    assert {r[0] for r in df.select(fn.trim("x")).collect()} == {"é"}


@pytest.mark.parametrize("text, expected", [("   ", None), ("x ", "x"), ("", None), (None, None), (" ", None)])
def test_blank_to_null(spark, text, expected):
    assert value(spark, text, fn.blank_to_null) == expected


def test_digits_only(spark):
    assert value(spark, " 12.345.678/0001-90", fn.digits_only) == "12345678000190"
    assert value(spark, "٣4", fn.digits_only) == "4"


@pytest.mark.parametrize("text, expected", [(" ", None), ("S/CEP", ""), ("20000-123", "20000123"), (None, None)])
def test_digits_or_null(spark, text, expected):
    assert value(spark, text, fn.digits_or_null) == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        ("109,99", "109.99"),
        ("109,995", "110.00"),
        ("-0,005", "-0.01"),
        (" 7 ", "7.00"),
        ("1e3", "1000.00"),
        (",5", "0.50"),
        ("5,", "5.00"),
        ("1.109,995", None),
        ("", None),
        ("N/D", None),
        ("NaN", None),
        ("123456789,1", None),
        ("1_000", None),
        (None, None),
    ],
)
def test_decimal_comma(spark, text, expected):
    assert value(spark, text, fn.decimal_comma) == (None if expected is None else Decimal(expected))


def test_parse_date(spark):
    assert value(spark, "02/01/2025", fn.parse_date) == date(2025, 1, 2)
    assert value(spark, None, fn.parse_date) is None
    for wrong in ("32/01/2025", "2025-01-02", "1/2/2025", ""):
        with pytest.raises(Exception, match="CANNOT_PARSE|DateTimeException|parse"):
            value(spark, wrong, fn.parse_date)


def test_surrogate_key(spark):
    df = spark.createDataFrame([("a", "b", None)], "a string, b string, c string")
    null = "_dbt_utils_surrogate_key_null_"
    got = df.select(fn.surrogate_key("a", "b"), fn.surrogate_key("a", "c", "b")).first()
    assert got[0] == "8ca2ed590cf2ea2404f2e67641bcdf50"
    assert got[1] == hashlib.md5(f"a-{null}-b".encode()).hexdigest()


def test_surrogate_key_of_a_date_uses_its_iso_text(spark):
    df = spark.createDataFrame([(date(2025, 1, 2),)], "d date")
    assert df.select(fn.surrogate_key("d")).first()[0] == hashlib.md5(b"2025-01-02").hexdigest()


def test_checksums(spark):
    expected = hashlib.sha256("abç".encode()).hexdigest()
    assert value(spark, "abç", fn.text_checksum) == expected
    assert value(spark, bytearray("abç".encode()), fn.bytes_checksum, "binary") == expected


@pytest.mark.parametrize("text, expected", [("1", "01"), ("01", "01"), ("2", "02"), ("02", "02")])
def test_normalize_semester(spark, text, expected):
    assert value(spark, text, fn.normalize_semester) == expected


@pytest.mark.parametrize("text", ["3", "001", "", "a", None])
def test_normalize_semester_rejects(spark, text):
    with pytest.raises(Exception, match="semester must be"):
        value(spark, text, fn.normalize_semester)


def test_periods(spark):
    assert value(spark, date(2025, 6, 30), fn.period_of, "date") == "2025-01"
    assert value(spark, date(2025, 7, 1), fn.period_of, "date") == "2025-02"
    assert value(spark, None, fn.period_of, "date") is None
    assert value(spark, "2025-02", fn.previous_period) == "2025-01"
    assert value(spark, "2025-01", fn.previous_period) == "2024-02"
    assert value(spark, "2025-01", fn.next_period) == "2025-02"
    assert value(spark, "2024-02", fn.next_period) == "2025-01"


def test_landing_path_and_back(spark):
    df = spark.createDataFrame([("2025-01", datetime(2025, 7, 1, 12, 30, 5))], "p string, t timestamp_ntz")
    path = df.select(fn.landing_path("src", "file", "p", fn.batch_stamp("t")).alias("x"))
    assert path.first()[0] == "src/partition=2025-01/file-2025-01-2025-07-01_123005.csv"
    assert path.select(fn.partition_of_path("x")).first()[0] == "2025-01"
    assert value(spark, "src/none/file.csv", fn.partition_of_path) is None


@pytest.mark.parametrize("size", [0, 1, 256, 768, 1280, 1792, 123456, 987654321])
def test_size_kb_rounds_like_python(spark, size):
    assert value(spark, size, fn.size_kb, "long") == round(size / 1024, 1)


def test_wall_clock_is_utc(spark):
    moment = datetime(2025, 7, 1, 2, 30)
    aware = datetime(2025, 6, 30, 23, 30, tzinfo=timezone(timedelta(hours=-3)))
    for given in (moment, aware):
        assert spark.range(1).select(fn.wall_clock(given).alias("t")).first()["t"] == moment


def test_latest_row_orders_nulls_last(spark):
    from tidemill.operators.latest import latest_per_key, newest_first

    df = spark.createDataFrame([("k", 1), ("k", None), ("k", 2)], "k string, v int")
    assert latest_per_key(df, "k", newest_first(["v"])).collect() == [("k", 2)]
    assert df.where(F.col("v").isNull()).count() == 1
