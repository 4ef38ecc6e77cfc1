"""Change logs: routing one multi-table log, and finding days that were changed after the fact."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import PARTITION_COLUMN, TaskConfig, day_of, end_day, shift_months
from ..functions.dates import day_int
from ..functions.text import strip_suffix
from ..operators.joins import without
from ..operators.project import CLEAN_ALIAS, LOG_SUFFIXES, apply_filters, cdc_window, project, route
from ..operators.setops import union_all, untouched
from ..sinks.tables import overwrite_partitions

HISTORY_SUFFIX = "_his"


def cdc_demux(log: DataFrame, cfg: TaskConfig, begin: datetime, end: datetime) -> DataFrame:
    """One table's rows of the shared log; the window does not apply to a full load."""
    rows = log if cfg.full_load else cdc_window(log, cfg.sync_time_column, begin, end)
    suffixes = LOG_SUFFIXES if cfg.log_suffixes is None else cfg.log_suffixes
    rows = route(apply_filters(rows, cfg.filters, CLEAN_ALIAS), cfg.group, cfg.trigger, suffixes)
    return project(rows, cfg.select_columns, CLEAN_ALIAS)


def whole_days(begin: datetime, end: datetime) -> tuple[datetime, datetime]:
    """The window widened to whole days, since whole day partitions are replaced."""
    midnight = {"hour": 0, "minute": 0, "second": 0, "microsecond": 0}
    last = end.replace(**midnight)
    return begin.replace(**midnight), last if last == end else last + timedelta(days=1)


def run_cdc_demux(log: DataFrame, cfg: TaskConfig, begin: datetime, end: datetime, path: str) -> None:
    """Replace the day partitions of one table's log that the window touches."""
    overwrite_partitions(cdc_demux(log, cfg, *whole_days(begin, end)), path)


def cdc_demux_all(log: DataFrame, time_column: str, begin: datetime, end: datetime, path: str) -> None:
    """Route every table in a single pass over the log, into one directory per database and table.

    The days that the window touches are replaced whole.
    """
    rows = cdc_window(log, time_column, *whole_days(begin, end))
    keys = ["db_name", "table_name", PARTITION_COLUMN]
    writer = rows.hint("rebalance", *[F.col(k) for k in keys]).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def backfill_days(
    log: DataFrame, as_of: datetime, begin: datetime | None = None, end: datetime | None = None
) -> DataFrame:
    """(table, day) pairs inserted or updated by the log, history tables counted as their live one.

    The window defaults to the year before `as_of`; days older than that year are forgotten.
    """
    begin, end = begin or shift_months(as_of, -12), end or as_of
    changed = log.where(F.col(PARTITION_COLUMN).between(day_of(begin), end_day(end))).where("dml_type != 0")
    moment = F.col("dml_event_time") - F.expr("interval 1 second")
    pairs = changed.select(
        strip_suffix(F.col("table_name"), (HISTORY_SUFFIX,)).alias("table_name"),
        day_int(moment).alias("backfill_day"),
    )
    return pairs.where(F.col("backfill_day") >= day_of(shift_months(as_of, -12))).distinct()


def backfill_state(
    configured: DataFrame, log: DataFrame, as_of: datetime, begin: datetime | None = None, end: datetime | None = None
) -> DataFrame:
    """Backfill days of the configured tables; a table the log does not mention gets the marker 0."""
    days = backfill_days(log, as_of, begin, end)
    known = days.join(configured.select("table_name").distinct(), "table_name", "left_semi")
    return union_all(known, untouched(configured, days, ["table_name"]))


def merge_backfill(state: DataFrame, found: DataFrame, as_of: datetime) -> DataFrame:
    """The rolling set: what was known and what was found, without days older than a year."""
    oldest = day_of(shift_months(as_of, -12))
    known = state.where(F.col("backfill_day") >= oldest)
    return union_all(found, without(known, found, ["table_name", "backfill_day"]))
