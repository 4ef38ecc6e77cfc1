"""Unions and differences."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import without
from .ranking import latest_run


def union_all(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, columns matched by name, absent ones NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def latest_with_dependency(
    log: DataFrame, task: tuple[str, str], dependency: tuple[str, str] | None, status: str, since: datetime
) -> DataFrame:
    """Newest run of a task, and of the task it depends on; one row when they are the same."""
    own = latest_run(log, *task, status, since)
    if dependency is None:
        return own
    return own.union(latest_run(log, *dependency, status, since)).distinct()


def untouched(configured: DataFrame, touched: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Configured tables the log does not mention, with the reset marker 0."""
    return without(configured.select(*keys), touched, keys).withColumn("backfill_day", F.lit(0))
