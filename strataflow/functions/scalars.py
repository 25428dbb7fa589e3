"""Column expressions for text that came from files: numbers, dates, keys and hashes.

Everything is built from Catalyst expressions, so it stays inside generated code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts that a log uses for "no reading" besides its declared sentinel. Fixed values.
NOT_A_READING = ("nan", "-nan", "null")
#: What counts as a number: a sign, digits with one point, an exponent; or the word nan.
NUMERIC = r"^(?i)(?:[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:e[+-]?[0-9]+)?|[+-]?nan)$"
#: All that numbers are made of. What a cast takes besides (suffixes, hexadecimals, infinity) has other letters.
NUMBER_LETTERS = "0123456789+-.eE"
SPREADSHEET_EPOCH = "1899-12-30"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_text(c: Column | str) -> Column:
    return _col(c).cast("string")


def surrogate_key(*columns: Column | str) -> Column:
    """Lower-case MD5 of the columns' texts, nulls as empty, with bars between."""
    return F.md5(F.concat_ws("|", *[F.coalesce(as_text(c), F.lit("")) for c in columns]))


def row_hash(*columns: Column | str) -> Column:
    """SHA-256 over the values in order; a null is one NUL byte, a unit separator ends each value."""
    return F.sha2(F.concat(*[F.concat(F.coalesce(as_text(c), F.lit("\x00")), F.lit("\x1f")) for c in columns]), 256)


def to_number(c: Column | str) -> Column:
    """Text as a double: blanks dropped, a decimal comma taken as a point; anything else is null.

    The cast decides, and a look at the letters on what it takes wrongly; no pattern is matched.
    """
    text = F.translate(F.trim(as_text(c)), ", ", ".")
    usual = F.translate(text, NUMBER_LETTERS, "") == ""
    return F.when(usual | F.lower(text).isin("nan", "+nan", "-nan"), text.try_cast("double"))


def null_if_sentinel(value: Column | str, sentinel: Column | str) -> Column:
    """The number in ``value``, null where it equals the declared sentinel as a number, or isn't one."""
    number, declared = to_number(value), to_number(sentinel)
    absent = F.lower(F.trim(as_text(value))).isin(*NOT_A_READING) | F.coalesce(number == declared, F.lit(False))
    return F.when(~F.coalesce(absent, F.lit(False)), number)


def date_from_excel_serial(c: Column | str) -> Column:
    """Day of a spreadsheet serial; the fraction is cut off, and nothing before day 1 is a date."""
    return date_from_serial(to_number(c))


def date_from_serial(serial: Column | str) -> Column:
    """Day of a serial that is a number already."""
    serial = _col(serial)
    day = F.floor(serial).cast("int")
    usable = (serial >= 1) & (serial < 2958466) & ~F.isnan(serial)
    return F.when(usable, F.date_add(F.lit(SPREADSHEET_EPOCH).cast("date"), day))


def date_from_iso(c: Column | str) -> Column:
    """Date in the first ten characters, without a shift to another zone."""
    head = F.substring(as_text(c), 1, 10)
    return F.when(head.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"), head.try_cast("date"))


def safe_divide(n: Column | str, d: Column | str) -> Column:
    """n / d, null where d is null or zero."""
    n, d = _col(n), _col(d)
    return F.when(F.coalesce(d, F.lit(0)) != 0, n / d)


def month_key(d: Column | str) -> Column:
    return (F.year(_col(d)) * 100 + F.month(_col(d))).cast("int")


def date_key(d: Column | str) -> Column:
    return (month_key(d) * 100 + F.dayofmonth(_col(d))).cast("int")


def position(haystack: Column | str, needle: str) -> Column:
    """Place of the first occurrence, from 1; 0 if there is none."""
    return F.instr(_col(haystack), needle)


def seconds_between(a: Column | str, b: Column | str) -> Column:
    """Whole seconds that have passed from a to b."""
    return F.timestamp_diff("SECOND", _col(a), _col(b))


def micros(ts: Column | str) -> Column:
    """Order key for frames by time: integer microseconds, so that a range frame's bounds are exact."""
    return F.unix_micros(_col(ts).cast("timestamp"))


def minutes_preceding(n: int) -> int:
    """Lower bound of a range frame over ``micros`` that reaches back n minutes, itself included."""
    return -n * 60 * 1_000_000


def date_spine(spark: SparkSession, first: str, last: str) -> DataFrame:
    """One row per day from first to last."""
    days = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(days).alias("day"))
