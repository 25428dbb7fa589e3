import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from strataflow.functions import scalars as s


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'string' if v is None else 'double' if isinstance(v, float) else 'int' if isinstance(v, int) else 'string'}" for k, v in values.items()))
    return df.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("text", "number"),
    [("1", 1.0), (" 1 234,5 ", 1234.5), ("-2e3", -2000.0), ("", None), (None, None), ("abc", None), ("1d", None), ("0x1p3", None), ("1_000", None), (".5", 0.5), ("5.", 5.0)],
)
def test_to_number(spark, text, number):
    assert one(spark, s.to_number("t"), t=text) == number


@pytest.mark.parametrize(("value", "sentinel", "out"), [("-999.25", "-999.2500", None), ("12", "-999.25", 12.0), ("nan", None, None), ("-NaN", "-999", None), ("null", "1", None), ("3", None, 3.0), (None, "1", None)])
def test_null_if_sentinel(spark, value, sentinel, out):
    assert one(spark, s.null_if_sentinel("v", "n"), v=value, n=sentinel) == out


@pytest.mark.parametrize(("text", "day"), [("41000", dt.date(2012, 4, 1)), ("41000.99", dt.date(2012, 4, 1)), ("0", None), ("-5", None), ("x", None), ("", None), ("nan", None)])
def test_excel_serial(spark, text, day):
    assert one(spark, s.date_from_excel_serial("t"), t=text) == day


@pytest.mark.parametrize(("text", "day"), [("2016-08-04T00:00:00+02:00", dt.date(2016, 8, 4)), ("2016", None), ("2016-02-30", None), (None, None)])
def test_iso_date(spark, text, day):
    assert one(spark, s.date_from_iso("t"), t=text) == day


def test_row_hash_follows_its_definition(spark):
    expected = hashlib.sha256(b"a\x1f\x00\x1f7\x1f").hexdigest()
    assert one(spark, s.row_hash("a", "b", "c"), a="a", b=None, c=7) == expected


def test_row_hash_tells_null_from_empty(spark):
    assert one(spark, s.row_hash("a"), a=None) != one(spark, s.row_hash("a"), a="")


def test_keys(spark):
    assert one(spark, s.surrogate_key("a", "b"), a="x", b=None) == hashlib.md5(b"x|").hexdigest()
    assert one(spark, s.safe_divide("n", "d"), n=1.0, d=0.0) is None
    assert one(spark, s.date_key(F.lit("2016-09-30").cast("date")), a="x") == 20160930


def test_date_spine_covers_both_ends(spark):
    days = s.date_spine(spark, "2008-06-01", "2016-09-30")
    assert days.count() == 3044
