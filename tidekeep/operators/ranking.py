"""Newest row per key and other ranked picks.

Every pick filters `row_number` by a constant, so Spark ranks within each map task first and ships at
most that many rows per key and task: a hot key does not travel whole. Spark does so for picks of up
to spark.sql.optimizer.windowGroupLimitThreshold rows (1000); larger ones need that setting raised.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import time_literal

_RANK = "__rank"

# What the two newest run times default to when a task never ran.
NEVER_PREVIOUS = "1970-01-01 08:00:00"
NEVER_LATEST = "2099-01-01 00:00:00"


def total_order(df: DataFrame, keys: Sequence[str], newest: str) -> list[Column]:
    """Newest first; ties fall to the remaining columns, so the pick never depends on task order."""
    rest = [c for c in df.columns if c not in {*keys, newest}]
    return [F.col(newest).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in rest]]


def ranked(df: DataFrame, keys: Sequence[str], newest: str) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*total_order(df, keys, newest))
    return df.withColumn(_RANK, F.row_number().over(window))


def latest_per_key(df: DataFrame, keys: Sequence[str], newest: str) -> DataFrame:
    """One row per key: the newest."""
    return ranked(df, keys, newest).where(F.col(_RANK) == 1).drop(_RANK)


def nth_latest(df: DataFrame, keys: Sequence[str], newest: str, n: int) -> DataFrame:
    """The n-th newest row of each key that has that many."""
    return ranked(df, keys, newest).where(F.col(_RANK) == n).drop(_RANK)


def top_k_per_group(df: DataFrame, keys: Sequence[str], newest: str, k: int) -> DataFrame:
    """The k newest rows of each key."""
    return ranked(df, keys, newest).where(F.col(_RANK) <= k).drop(_RANK)


def _runs(log: DataFrame, scheduler: str, group: str, status: str) -> DataFrame:
    return log.where(
        (F.col("scheduler_name") == scheduler) & (F.col("group_name") == group) & (F.col("task_status") == status)
    )


def latest_run(log: DataFrame, scheduler: str, group: str, status: str, since: datetime) -> DataFrame:
    """The run with the newest end, among those created after `since`."""
    runs = _runs(log, scheduler, group, status).where(F.col("create_time") > time_literal(log, "create_time", since))
    return runs.orderBy(F.col("sync_end_time").desc(), F.col("id")).limit(1)


def runs_since(log: DataFrame, scheduler: str, group: str, status: str, since: datetime) -> DataFrame:
    """Runs ending after `since`, oldest first."""
    after = F.col("sync_end_time") > time_literal(log, "sync_end_time", since)
    return _runs(log, scheduler, group, status).where(after).orderBy("sync_end_time", "id")


def run_window(log: DataFrame, scheduler: str) -> DataFrame:
    """Ends of the two newest finished exports of a task, with defaults when there are fewer."""
    ends = (
        log.where(
            (F.col("scheduler_name") == scheduler)
            & F.col("group_name").like("%_hive")
            & (F.col("task_status") == "FINISHED")
        )
        .select("sync_end_time")
        .orderBy(F.col("sync_end_time").desc())
    )

    ends = ends.select(F.col("sync_end_time").alias("latest_end")).limit(1).unionByName(
        ends.select(F.col("sync_end_time").alias("previous_end")).offset(1).limit(1), allowMissingColumns=True
    )
    return ends.agg(
        F.coalesce(F.max("previous_end"), F.lit(NEVER_PREVIOUS).cast("timestamp_ntz")).alias("previous_end"),
        F.coalesce(F.max("latest_end"), F.lit(NEVER_LATEST).cast("timestamp_ntz")).alias("latest_end"),
    )
