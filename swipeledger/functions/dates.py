"""TIMEID (``YYYYMMDD`` text) and its parts."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def two_digits(number: Column) -> Column:
    return F.lpad(number.cast("string"), 2, "0")


def timeid(year: Column, month: Column, day: Column) -> Column:
    return F.concat(year.cast("string"), two_digits(month), two_digits(day))


def timeid_date(value: Column) -> Column:
    """Date of a TIMEID; null where the day does not exist."""
    return F.try_to_date(value, "yyyyMMdd")


def year_text(value: Column) -> Column:
    return F.substring(value, 1, 4)


def month_text(value: Column) -> Column:
    return F.substring(value, 5, 2)


def day_text(value: Column) -> Column:
    return F.substring(value, 7, 2)


def year_month(value: Column) -> Column:
    return F.substring(value, 1, 6)


def month_key(year: str | int, month: str | int) -> str:
    """``(2018, 2)`` and ``("2018", "02")`` both give ``201802``."""
    return f"{int(year):04d}{int(month):02d}"


def in_month(df: DataFrame, year: str | int, month: str | int) -> Column:
    """Rows of one month. A stored table is pruned to that month's folder; any
    other gets a prefix test, which is pushed into the scan (a ``substring``
    comparison would not be)."""
    key = month_key(year, month)
    if "YEAR_MONTH" in df.columns:
        return F.col("YEAR_MONTH") == key
    return F.col("TIMEID").startswith(key)


def between_days(df: DataFrame, start: str, end: str) -> Column:
    """Rows from ``start`` to ``end``, both inclusive, compared as text."""
    days = F.col("TIMEID").between(start, end)
    if "YEAR_MONTH" in df.columns:
        return days & F.col("YEAR_MONTH").between(start[:6], end[:6])
    return days
