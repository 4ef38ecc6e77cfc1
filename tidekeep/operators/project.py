"""Projections, filters and derived columns."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import (
    AUDIT_ODS,
    EXPORT_DAYS,
    LOOKBACK_MONTHS,
    PARTITION_COLUMN,
    SENTINEL,
    day_of,
    export_span,
    lookback_months,
)
from ..functions.dates import audit_time, day_int_from_text, month_int, time_literal
from ..functions.text import has_prefix, strip_suffix

# The usual suffixes of a change-log task's name; a task may have its own.
LOG_SUFFIXES = ("_yg_thl", "_thl")

# The aliases configured columns and filters are qualified by, per stage.
SOURCE_ALIAS, DETAIL_ALIAS, CLEAN_ALIAS, EXPORT_ALIAS = "t", "p", "src_t", "t2"


def project(df: DataFrame, expressions: Sequence[str], alias: str = SOURCE_ALIAS) -> DataFrame:
    """An ordered list of columns or `expression as name`; columns may be qualified by the alias."""
    return df.alias(alias).selectExpr(*expressions)


def apply_filters(df: DataFrame, fragments: Sequence[str], alias: str = SOURCE_ALIAS) -> DataFrame:
    """All fragments must hold. A fragment may start with its own "and", and qualify columns by the alias."""
    df = df.alias(alias)
    for fragment in fragments:
        df = df.where(re.sub(r"^\s*and\s+", "", fragment, flags=re.IGNORECASE))
    return df


def exclude_status(df: DataFrame, column: str, values: Sequence[object]) -> DataFrame:
    """SQL `not in`: rows with a NULL status go too."""
    return df.where(~F.col(column).isin(*values))


def split_by_prefix(df: DataFrame, column: str, prefixes: Mapping[str, str]) -> dict[str, DataFrame]:
    """One frame per line of business; an empty prefix keeps everything."""
    return {
        name: df.where(has_prefix(F.col(column), prefix)) if prefix else df for name, prefix in prefixes.items()
    }


def cdc_window(df: DataFrame, time_column: str, begin: datetime, end: datetime) -> DataFrame:
    """Log rows with begin <= time < end, in partitions from the day of one second before begin.

    The partition bound is a literal on the partition column, so older directories are never listed.
    """
    first_day = day_of(begin - timedelta(seconds=1))
    c = F.col(time_column)
    return df.where(
        (F.col(PARTITION_COLUMN) >= first_day)
        & (c >= time_literal(df, time_column, begin))
        & (c < time_literal(df, time_column, end))
    )


def route(df: DataFrame, db: str, task: str, suffixes: Sequence[str] = LOG_SUFFIXES) -> DataFrame:
    """Log rows of one database and table; the task's name may carry a log suffix."""
    table = task
    for suffix in sorted(suffixes, key=len, reverse=True):
        table = table.replace(suffix, "")
    return df.where((F.col("db_name") == db) & (F.col("table_name") == table))


def table_of_task(c: Column, suffixes: Sequence[str] = LOG_SUFFIXES) -> Column:
    """The table a log task's name stands for."""
    return strip_suffix(c, suffixes)


def drop_sentinels(df: DataFrame) -> DataFrame:
    """Placeholder rows out; rows never audited stay."""
    return df.where(F.coalesce(F.col(AUDIT_ODS), F.lit("999")) != SENTINEL)


def export_filter(df: DataFrame) -> DataFrame:
    """Placeholder rows out, and with them rows whose audit column is NULL."""
    return df.where(F.col(AUDIT_ODS) != SENTINEL)


def in_export_span(df: DataFrame, as_of: datetime, days: int = EXPORT_DAYS, grain: str | None = None) -> DataFrame:
    """Partitions of the last days. Without a grain, months (six digits) and days (eight) each have their own range."""
    place = F.col(PARTITION_COLUMN)
    if grain:
        return df.where(place.between(*export_span(as_of, days, grain)))
    return df.where(place.between(*export_span(as_of, days, "day")) | place.between(*export_span(as_of, days, "month")))


def in_lookback(df: DataFrame, begin: datetime, end: datetime, months: int = LOOKBACK_MONTHS) -> DataFrame:
    return df.where(F.col(PARTITION_COLUMN).between(*lookback_months(begin, end, months)))


def with_audit(df: DataFrame, name: str, as_of: datetime) -> DataFrame:
    return df.withColumn(name, audit_time(as_of))


def with_month(df: DataFrame, time_column: str) -> DataFrame:
    return df.withColumn(PARTITION_COLUMN, month_int(F.col(time_column)))


def with_day(df: DataFrame, text_column: str) -> DataFrame:
    return df.withColumn(PARTITION_COLUMN, day_int_from_text(F.col(text_column).cast("string")))


def align_schema(df: DataFrame, known: Mapping[str, str]) -> DataFrame:
    """The known columns in their order, absent ones NULL, then columns not seen before.

    Names are compared without case; of two that differ in case only, the first wins.
    """
    present: dict[str, str] = {}
    for name in df.columns:
        present.setdefault(name.lower(), name)
    wanted = {name.lower() for name in known}
    kept = [
        F.col(f"`{present[name.lower()]}`").cast(kind).alias(name)
        if name.lower() in present
        else F.lit(None).cast(kind).alias(name)
        for name, kind in known.items()
    ]
    added = [F.col(f"`{name}`") for low, name in present.items() if low not in wanted]
    return df.select(*kept, *added)
