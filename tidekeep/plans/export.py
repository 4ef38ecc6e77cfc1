"""Exports to a reporting store."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import TaskConfig, time_text
from ..operators.project import EXPORT_ALIAS, apply_filters, export_filter, in_export_span, project
from ..sinks.files import FileTree, recover
from ..sinks.tables import upsert, write_full
from ..sources.scans import read_table


def export_snapshot(df: DataFrame, cfg: TaskConfig, as_of: datetime, is_log: bool = False) -> DataFrame:
    """The rows an export carries: no placeholders, the last days only, the business filters.

    Change logs hold no placeholders; a full export ignores the span. Day and month tables are told apart by their
    partition values.
    """
    if not cfg.select_columns:
        raise ValueError("an export must name its columns")
    rows = df if is_log else export_filter(df)
    if not cfg.full_load:
        rows = in_export_span(rows, as_of, cfg.export_days)
    return project(apply_filters(rows, cfg.filters, EXPORT_ALIAS), cfg.select_columns, EXPORT_ALIAS)


def task_status(spark: SparkSession, cfg: TaskConfig, status: str, as_of: datetime) -> DataFrame:
    """One row: how a task ended."""
    row = spark.range(1)
    return row.select(
        F.lit(cfg.group).alias("group_name"),
        F.lit(cfg.trigger).alias("task_name"),
        F.lit(time_text(as_of)).cast("timestamp_ntz").alias("finshed_time"),
        F.lit(status).alias("status"),
    )


def export(
    df: DataFrame,
    cfg: TaskConfig,
    as_of: datetime,
    deliver: Callable[[DataFrame], None],
    status_path: str,
    is_log: bool = False,
) -> None:
    """Deliver the snapshot, then record the task's status; `deliver` truncates its target and fills it."""
    spark = df.sparkSession
    try:
        deliver(export_snapshot(df, cfg, as_of, is_log))
        status = "FINISHED"
    except Exception:
        status = "INTERRUPTED"
        raise
    finally:
        changes = task_status(spark, cfg, status, as_of)
        recover(FileTree(spark), status_path)  # before the read: a run that died may have left the table aside
        write_full(upsert(read_table(spark, status_path), changes, ["group_name", "task_name"]), status_path)
