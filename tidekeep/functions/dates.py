"""Date and time expressions. Every clock-dependent one takes `as_of` instead of reading a clock."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import time_text


def time_literal(df: DataFrame, column: str, when: datetime) -> Column:
    """`when` in the column's own type, so the comparison folds and reaches the scan."""
    return F.lit(when.isoformat(sep=" ")).cast(df.schema[column].dataType)


def audit_time(as_of: datetime) -> Column:
    """The run time as text, the form audit columns are stored in."""
    return F.lit(time_text(as_of))


def format_time(c: Column, pattern: str) -> Column:
    return F.date_format(c, pattern)


def parse_time(c: Column, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Text to a zone-free timestamp; text that does not fit becomes NULL."""
    return F.try_to_timestamp(c, F.lit(pattern)).cast("timestamp_ntz")


def month_int(c: Column) -> Column:
    """yyyyMM as a number, by arithmetic rather than by formatting text."""
    return F.year(c) * 100 + F.month(c)


def day_int(c: Column) -> Column:
    return F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)


def day_text(day: Column) -> Column:
    """A yyyyMMdd number as yyyy-MM-dd text."""
    return F.date_format(F.make_date((day / 10000).cast("int"), (day / 100).cast("int") % 100, day % 100), "yyyy-MM-dd")


def day_int_from_text(c: Column) -> Column:
    """yyyy-MM-dd… text to a yyyyMMdd number."""
    return F.substring(F.regexp_replace(c, "-", ""), 1, 8).cast("int")


def age_seconds(c: Column, as_of: datetime) -> Column:
    """Whole seconds from the column to `as_of`."""
    return F.unix_timestamp(F.lit(time_text(as_of))) - F.unix_timestamp(c.cast("timestamp"))


def days_before(as_of: datetime, n: int) -> Column:
    return F.date_sub(F.lit(time_text(as_of)).cast("date"), n)


def days_between(first: Column, second: Column) -> Column:
    """Calendar days from the first to the second, ignoring the time of day."""
    return F.datediff(second, first)


def day_list(first: Column, last: Column) -> Column:
    """yyyyMMdd texts from first to last, the last day included."""
    start, stop = F.to_date(first), F.to_date(last)
    days = F.when(start < stop, F.sequence(start, stop)).otherwise(F.array(stop))
    return F.transform(days, lambda d: F.date_format(d, "yyyyMMdd"))


def months_before_end(first: Column, last: Column) -> Column:
    """yyyyMM texts from the first month up to, but without, the last one."""
    start, stop = F.trunc(F.to_date(first), "MM"), F.trunc(F.to_date(last), "MM")
    months = F.when(
        start < stop, F.sequence(start, F.add_months(stop, -1), F.expr("interval 1 month"))
    ).otherwise(F.array().cast("array<date>"))
    return F.transform(months, lambda d: F.date_format(d, "yyyyMM"))


def shift_date(c: Column, n: int, unit: str) -> Column:
    """Move by n hours, days or months; months clamp to the month's last day."""
    step = {
        "hour": lambda: F.make_dt_interval(F.lit(0), F.lit(n)),
        "day": lambda: F.make_dt_interval(F.lit(n)),
        "month": lambda: F.make_ym_interval(F.lit(0), F.lit(n)),
    }[unit]()
    return c + step


def begin_of(c: Column, unit: str, ahead: int = 0) -> Column:
    """Start of the column's day or month, moved `ahead` units (1 = next, -1 = previous)."""
    day = F.trunc(F.to_date(c), "MM") if unit == "month" else F.to_date(c)
    return shift_date(day.cast("timestamp_ntz"), ahead, unit)
