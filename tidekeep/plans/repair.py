"""Removing rows whose delete was logged but not applied."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import PARTITION_COLUMN, day_of
from ..functions.dates import time_literal
from ..operators.aggregates import pending_delete_ranges
from ..operators.joins import delete_exists, logged_days, logged_deletes, rebuild_without
from ..sinks.files import FileTree, recover
from ..sinks.tables import replace_partitions, write_full
from ..sources.scans import read_table


def update_where(df: DataFrame, predicate: Column, changes: Mapping[str, Column]) -> DataFrame:
    """`update … set … where …`: rows the predicate does not hold for, or is unknown for, keep their values."""
    return df.withColumns(
        {c: F.when(predicate, v).otherwise(F.col(c)).cast(df.schema[c].dataType) for c, v in changes.items()}
    )


def _pending(log: DataFrame, table: str, begin: datetime, end: datetime, time_column: str) -> Column:
    c = F.col(time_column)
    return (
        (F.col("table_name") == table)
        & (c >= time_literal(log, time_column, begin))
        & (c <= time_literal(log, time_column, end))
        & (F.col("process_status") == 0)
    )


def mark_processed(
    log: DataFrame, table: str, begin: datetime, end: datetime, time_column: str = "yw_update_time"
) -> DataFrame:
    """The log with one table's deletes between two times, both included, marked as done."""
    return update_where(log, _pending(log, table, begin, end, time_column), {"process_status": F.lit(1)})


def _rewrite(path: str, table: DataFrame, hit: DataFrame, change: Callable[[DataFrame], DataFrame]) -> None:
    """Apply a change to a stored table; of a partitioned one, only to the partitions of the hit rows.

    The list of those partitions, at most one number per partition, is all that reaches the driver.
    """
    if not FileTree(table.sparkSession).is_partitioned(path, PARTITION_COLUMN):
        write_full(change(table), path)
        return
    places = [row[0] for row in hit.select(PARTITION_COLUMN).distinct().collect()]
    if not places:
        return
    place = F.col(PARTITION_COLUMN)
    inside = place.isin(*[p for p in places if p is not None])
    if None in places:
        inside = place.isNull() | inside
    replace_partitions(change(table.where(inside)), path, places, beyond="refuse")


def delete_repair(
    spark: SparkSession, path: str, log: DataFrame, pk: str, table: str, lo_day: int, hi_day: int
) -> None:
    """Rebuild a table without the logged keys; the old table comes back if anything fails.

    Which partitions hold such a key is found by reading two columns.
    """
    target, logged = read_table(spark, path), logged_days(log, table, lo_day, hi_day)
    hit = target
    if PARTITION_COLUMN in target.columns:
        hit = delete_exists(target.select(pk, PARTITION_COLUMN), logged, pk, keep_deleted=True)
    _rewrite(path, target, hit, lambda rows: rebuild_without(rows, log, pk, table, lo_day, hi_day))


def delete_repair_run(
    spark: SparkSession,
    warehouse_path: str,
    report_path: str,
    log_path: str,
    pk: str,
    table: str,
    time_column: str = "yw_update_time",
) -> bool:
    """One table's pending deletes: warehouse, then reporting copy, then mark the log.

    The range of the pending deletes is one row. The log is marked last, so a failed run starts over.
    """
    for path in (warehouse_path, report_path, log_path):
        recover(FileTree(spark), path)
    log = read_table(spark, log_path)
    pending = pending_delete_ranges(log, time_column).where(F.col("table_name") == table).first()
    if pending is None:
        return False
    begin, end = pending["min_time"], pending["max_time"]
    delete_repair(spark, warehouse_path, log, pk, table, day_of(begin), day_of(end))
    deletes = logged_deletes(log, table, time_column, begin, end)
    report = read_table(spark, report_path)
    hit = report
    if PARTITION_COLUMN in report.columns:
        hit = delete_exists(report.select(pk, PARTITION_COLUMN), deletes, pk, keep_deleted=True)
    _rewrite(report_path, report, hit, lambda rows: delete_exists(rows, deletes, pk))
    marked = log.where(_pending(log, table, begin, end, time_column))
    _rewrite(log_path, log, marked, lambda rows: mark_processed(rows, table, begin, end, time_column))
    return True
