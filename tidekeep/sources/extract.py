"""Pulling rows out of an operational source by time window.

A source is any DataFrame: a JDBC table or a file table. Predicates are written on plain columns with
literals of the column's own type, so Spark pushes them to the database or the file scan.
"""

from __future__ import annotations

from collections.abc import Callable, Collection
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import PARTITION_COLUMN, TaskConfig, day_of, validate_window
from ..functions.dates import time_literal
from ..functions.types import apply_type_overrides
from ..operators.project import apply_filters, project


def _shape(df: DataFrame, columns: tuple[str, ...], cfg: TaskConfig) -> DataFrame:
    if not columns:
        raise ValueError("a task must name the columns it reads")
    return apply_type_overrides(project(df, columns), cfg.type_overrides)


def window_predicate(df: DataFrame, cfg: TaskConfig, begin: datetime, end: datetime) -> Column:
    """Begin included, end excluded.

    A text time column is compared as yyyyMMdd; a window inside one day then means that whole day.
    """
    if not cfg.sync_time_column:
        raise ValueError("an incremental task needs a time column")
    c = F.col(cfg.sync_time_column)
    if cfg.time_type == "str":
        last = end + timedelta(days=1) if day_of(begin) == day_of(end) else end
        return (c >= str(day_of(begin))) & (c < str(day_of(last)))
    if cfg.time_type != "timestamp":
        raise ValueError(f"unsupported time column type {cfg.time_type!r}")
    return (c >= time_literal(df, cfg.sync_time_column, begin)) & (c < time_literal(df, cfg.sync_time_column, end))


def extract_full(src: DataFrame, cfg: TaskConfig) -> DataFrame:
    """Every row the configured filters let through."""
    return _shape(apply_filters(src, cfg.filters), cfg.select_columns, cfg)


def extract_incremental(src: DataFrame, cfg: TaskConfig, begin: datetime, end: datetime) -> DataFrame:
    """The rows of one window of at most a day."""
    validate_window(begin, end)
    rows = src.where(window_predicate(src, cfg, begin, end))
    return _shape(apply_filters(rows, cfg.filters), cfg.select_columns, cfg)


def extract_with_history(
    live: DataFrame,
    history: DataFrame,
    cfg: TaskConfig,
    flagged_days: Collection[int],
    begin: datetime,
    end: datetime,
) -> DataFrame:
    """The window from the live table, and from the history table when its day was flagged.

    Configured filters concern the live branch only; history may have its own column list.
    """
    rows = extract_incremental(live, cfg, begin, end)
    if day_of(begin) not in flagged_days:
        return rows
    moved = history.where(window_predicate(history, cfg, begin, end))
    moved = _shape(moved, cfg.history_columns or cfg.select_columns, cfg)
    return rows.union(moved)


def backfilled_rows(history: DataFrame, state: DataFrame, table: str) -> DataFrame:
    """Rows of a day-partitioned history table on the table's backfill days.

    A semi-join on the partition column against the few days of one table: Spark reads only those directories.
    """
    days = state.where(F.col("table_name") == table).select(F.col("backfill_day").alias("__day"))
    return history.join(days, F.col(PARTITION_COLUMN) == F.col("__day"), "left_semi")


def extract_with_backfill(
    live: DataFrame,
    history: DataFrame,
    state: DataFrame,
    table: str,
    cfg: TaskConfig,
    begin: datetime,
    end: datetime,
) -> DataFrame:
    """The window from the live table, and its rows in the history table on days that the stored state flags.

    As `extract_with_history`, with the days taken from the state as data: no list of days passes through the driver.
    """
    rows = extract_incremental(live, cfg, begin, end)
    moved = backfilled_rows(history, state, table).where(window_predicate(history, cfg, begin, end))
    return rows.union(_shape(moved, cfg.history_columns or cfg.select_columns, cfg))


def boundaries(df: DataFrame, column: str) -> DataFrame:
    """Smallest and largest value of the split column, one row."""
    return df.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))


def slice_position(df: DataFrame, column: str, time_type: str) -> Callable[[Column], Column]:
    """What a split column is cut by: times by microseconds, yyyyMMdd texts by days, numbers by value."""
    if time_type == "str":
        return lambda c: F.unix_date(F.to_date(F.substring(c, 1, 8), "yyyyMMdd"))
    if isinstance(df.schema[column].dataType, T.NumericType):
        return lambda c: c
    return lambda c: F.unix_micros(c.cast("timestamp"))


def extract_partitioned(
    src: DataFrame,
    cfg: TaskConfig,
    begin: datetime,
    end: datetime,
    readers: int,
    history: DataFrame | None = None,
    flagged_days: Collection[int] = (),
) -> DataFrame:
    """The window, each row tagged with the slice, and so the reader, it falls to.

    The one-row boundary query is the only thing that reaches the driver. A window that the history table takes part in is read
    by one reader.
    """
    if history is not None and day_of(begin) in flagged_days:
        whole = extract_with_history(src, history, cfg, flagged_days, begin, end)
        return whole.withColumn("slice_no", F.lit(0))
    rows = src.where(window_predicate(src, cfg, begin, end))
    rows = apply_filters(rows, cfg.filters)
    place = slice_position(src, cfg.sync_time_column, cfg.time_type)
    lo, hi = boundaries(rows, cfg.sync_time_column).select(place(F.col("lo")), place(F.col("hi"))).first()
    if lo is None or lo == hi:
        slice_no = F.lit(0)
    else:
        position = ((place(F.col(cfg.sync_time_column)) - F.lit(lo)).cast("double") * readers / float(hi - lo)).cast("int")
        slice_no = F.least(position, F.lit(readers - 1))
    return _shape(rows.withColumn("slice_no", slice_no), (*cfg.select_columns, "slice_no"), cfg)


def valid_window(begin: Column, end: Column) -> Column:
    """`validate_window` for windows held in columns."""
    return (end > begin) & (end <= begin + F.make_dt_interval(F.lit(1)))
