"""Checks between source and warehouse: daily counts, duplicate keys, window counts."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import (
    DUPLICATE_DAYS,
    PARTITION_COLUMN,
    SIGMA_DAYS,
    SIGMA_FACTOR,
    TRACE_DAYS,
    TaskConfig,
    day_of,
    time_text,
)
from ..functions.dates import day_text, time_literal
from ..functions.text import key_label
from ..operators.aggregates import (
    check_days,
    daily_counts,
    daily_counts_union,
    duplicates_since,
    partition_counts,
    sigma_check,
)
from ..operators.joins import merge_counts
from ..operators.project import DETAIL_ALIAS, SOURCE_ALIAS, apply_filters
from ..operators.setops import union_all
from ..sinks.files import FileTree
from ..sinks.tables import upsert
from ..sources.scans import read_table

RESULT_KEYS = ["group_name", "task_name", "syn_date"]


def verify_sync(
    source: DataFrame,
    target: DataFrame,
    time_column: str,
    as_of: datetime,
    history: DataFrame | None = None,
    by: Sequence[str] = ("group_name", "task_name"),
    days: int = SIGMA_DAYS,
    factor: float = SIGMA_FACTOR,
    trace: int = TRACE_DAYS,
) -> DataFrame:
    """Rows per day in the source against rows per day partition in the target, with the sigma flag."""
    if history is None:
        ours = daily_counts(source, time_column, as_of, days, trace, by)
    else:
        ours = daily_counts_union(source, history, time_column, as_of, days, trace, by)
    first, last = check_days(as_of, days, trace)
    counted = partition_counts(target, day_of(first), day_of(last), by)
    theirs = counted.select(*by, day_text(F.col(PARTITION_COLUMN)).alias("syn_date"), "target_count")
    merged = merge_counts(ours, theirs, [*by, "syn_date"])
    return sigma_check(merged, by, days, factor).withColumn("create_date", F.lit(time_text(as_of)))


def save_results(results: DataFrame, found: DataFrame) -> DataFrame:
    """The result table with the freshly checked days replaced."""
    return upsert(results, found, RESULT_KEYS)


@dataclass(frozen=True)
class CheckedTable:
    """A key that must be unique in a table. Checks of the same frame share a scan; a disabled one is not run."""

    group: str
    name: str
    rows: DataFrame
    primary_keys: tuple[str, ...]
    enabled: bool = True


# Tables that one plan checks at most; the plan's size does not grow with the number of tables.
TABLES_PER_PLAN = 16
CHECK_DAY, CHECK_BATCH = "check_day", "check_batch"


def enabled_names(registry: DataFrame) -> set[tuple[str, str]]:
    """(group, table) of the registered checks that are not disabled: a short list, as the registry is configuration."""
    rows = registry.where("is_disable = 0").select("group_name", "table_name").distinct()
    return {tuple(r) for r in rows.collect()}


def _checks_of_one_table(checks: Sequence[CheckedTable], since: int) -> DataFrame:
    """Repeated keys of several checks of one table, from one scan of it.

    Each row offers one key per check; keys are grouped by check and by their parts as text, not by their label.
    """
    rows = checks[0].rows.where(F.col(PARTITION_COLUMN) >= since)
    offers = []
    for i, check in enumerate(checks):
        parts = F.array(*[F.col(k).cast("string") for k in check.primary_keys])
        offers.append(F.struct(F.lit(i).alias("check"), parts.alias("parts"), key_label(check.primary_keys).alias("label")))
    offered = rows.select(F.explode(F.array(*offers)).alias("k")).select("k.*")
    # A label is NULL when a part is, which disqualifies the key.
    counted = offered.where("label is not null").groupBy("check", "parts", "label").agg(F.count(F.lit(1)).alias("occurrences"))
    named = [
        F.when(F.col("check") == i, F.lit(text))
        for i, text in enumerate(",".join(c.primary_keys) for c in checks)
    ]
    return counted.where("occurrences > 1").select(
        F.lit(checks[0].group).alias("group_name"),
        F.lit(checks[0].name).alias("table_name"),
        F.coalesce(*named).alias("primary_key"),
        F.col("label").alias("primary_value"),
        "occurrences",
    )


def _by_table(checks: Iterable[CheckedTable]) -> list[list[CheckedTable]]:
    """The enabled checks, those of the same frame together."""
    groups: dict[tuple[str, str, int], list[CheckedTable]] = {}
    for check in checks:
        if check.enabled:
            groups.setdefault((check.group, check.name, id(check.rows)), []).append(check)
    return list(groups.values())


def verify_duplicates(tables: Iterable[CheckedTable], as_of: datetime, days: int = DUPLICATE_DAYS) -> DataFrame:
    """Repeated keys of every enabled table, in one plan; `run_duplicate_checks` is for many tables."""
    since = duplicates_since(as_of, days)
    return union_all(*[_checks_of_one_table(own, since) for own in _by_table(tables)])


def _run_in_batches(parts: Sequence[Callable[[], DataFrame]], path: str, as_of: datetime, per_plan: int) -> int:
    """Run plans of a few parts each and store their rows under the day of the check. A batch that is repeated replaces itself;
    batches that an earlier, longer run of the day left are dropped. Tells how many plans ran."""
    day, batches = day_of(as_of), [parts[i : i + per_plan] for i in range(0, len(parts), per_plan)]
    spark = None
    for number, batch in enumerate(batches):
        rows = union_all(*[part() for part in batch])
        spark = rows.sparkSession
        placed = rows.withColumns({CHECK_DAY: F.lit(day), CHECK_BATCH: F.lit(number)})
        writer = placed.hint("rebalance").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        # A batch that found nothing leaves an empty partition behind, so the old one is removed first.
        FileTree(spark).remove(f"{path}/{CHECK_DAY}={day}/{CHECK_BATCH}={number}")
        writer.partitionBy(CHECK_DAY, CHECK_BATCH).parquet(path)
    if spark is not None:
        tree = FileTree(spark)
        for name in tree.names(f"{path}/{CHECK_DAY}={day}"):
            number = name.partition("=")[2]
            if name.startswith(f"{CHECK_BATCH}=") and int(number) >= len(batches):
                tree.remove(f"{path}/{CHECK_DAY}={day}/{name}")
    return len(batches)


def run_duplicate_checks(
    tables: Iterable[CheckedTable],
    as_of: datetime,
    path: str,
    days: int = DUPLICATE_DAYS,
    per_plan: int = TABLES_PER_PLAN,
) -> int:
    """Check any number of tables, a few per plan, and store the repeated keys by day of the check.

    Read them with `read_check_results`. Running a day again replaces its results. Tells how many plans were run.
    """
    since = duplicates_since(as_of, days)
    parts = [lambda own=own: _checks_of_one_table(own, since) for own in _by_table(tables)]
    return _run_in_batches(parts, path, as_of, per_plan)


def run_count_checks(
    tasks: Iterable[CountedTask], begin: datetime, end: datetime, path: str, per_plan: int = TABLES_PER_PLAN
) -> int:
    """Reconcile the counts of any number of tasks, a few per plan, and store those that differ by the window's first day."""
    parts = [lambda task=task: reconcile_counts([task], begin, end) for task in tasks]
    return _run_in_batches(parts, path, begin, per_plan)


def read_check_results(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Stored results of all checks, without the number of their batch."""
    places = f"{CHECK_DAY} int, {CHECK_BATCH} int"
    fields = T.StructType.fromDDL(f"{schema or DUPLICATE_SCHEMA}, {places}")
    return read_table(spark, path, schema=fields).drop(CHECK_BATCH)


DUPLICATE_SCHEMA = "group_name string, table_name string, primary_key string, primary_value string, occurrences bigint"
COUNT_SCHEMA = "group_name string, task_name string, source_count bigint, target_count bigint"


@dataclass(frozen=True)
class CountedTask:
    """One table to reconcile. With a master, rows count once per matching master row in the window.

    A filter of a detail task concerns the master when it qualifies columns by its alias.
    """

    cfg: TaskConfig
    source: DataFrame
    target: DataFrame
    time_column: str = ""
    source_master: DataFrame | None = None
    target_master: DataFrame | None = None
    pairs: tuple[tuple[str, str], ...] = ()


def _in_window(df: DataFrame, column: str, begin: datetime, end: datetime) -> DataFrame:
    c = F.col(column)
    return df.where((c >= time_literal(df, column, begin)) & (c < time_literal(df, column, end)))


def _matching_rows(
    detail: DataFrame, master: DataFrame, pairs: Sequence[tuple[str, str]], column: str, begin: datetime, end: datetime
) -> DataFrame:
    """Size of the inner join, from per-key counts: a hot key is multiplied, not joined row by row."""
    names = [f"__key_{i}" for i in range(len(pairs))]
    ours = detail.select(*[F.col(d).alias(n) for (d, _), n in zip(pairs, names)])
    theirs = _in_window(master, column, begin, end).select(*[F.col(m).alias(n) for (_, m), n in zip(pairs, names)])
    left = ours.na.drop().groupBy(*names).agg(F.count(F.lit(1)).alias("__details"))
    right = theirs.na.drop().groupBy(*names).agg(F.count(F.lit(1)).alias("__masters"))
    return left.join(right, names).agg(F.coalesce(F.sum(F.col("__details") * F.col("__masters")), F.lit(0)).alias("n"))


def _filtered_source(task: CountedTask) -> tuple[DataFrame, DataFrame | None]:
    """Source and its master, each with the configured filters that concern it."""
    if task.source_master is None:
        return apply_filters(task.source, task.cfg.filters), None
    on_master = [f for f in task.cfg.filters if re.search(rf"\b{SOURCE_ALIAS}\.", f)]
    on_detail = [f for f in task.cfg.filters if f not in on_master]
    return (
        apply_filters(task.source, on_detail, DETAIL_ALIAS),
        apply_filters(task.source_master, on_master, SOURCE_ALIAS),
    )


def _count(task: CountedTask, df: DataFrame, master: DataFrame | None, begin: datetime, end: datetime) -> DataFrame:
    if task.cfg.full_load:
        return df.agg(F.count(F.lit(1)).alias("n"))
    if master is None:
        return _in_window(df, task.time_column, begin, end).agg(F.count(F.lit(1)).alias("n"))
    return _matching_rows(df, master, task.pairs, task.time_column, begin, end)


def count_tasks(tasks: Iterable[CountedTask], begin: datetime, end: datetime) -> DataFrame:
    """Source and target count per task. Configured filters concern the source side."""
    parts = []
    for task in tasks:
        name = [F.lit(task.cfg.group).alias("group_name"), F.lit(task.cfg.trigger).alias("task_name")]
        nothing = F.lit(0).cast("bigint")
        ours = _count(task, *_filtered_source(task), begin, end)
        theirs = _count(task, task.target, task.target_master, begin, end)
        parts.append(ours.select(*name, F.col("n").alias("source_count"), nothing.alias("target_count")))
        parts.append(theirs.select(*name, nothing.alias("source_count"), F.col("n").alias("target_count")))
    sums = [F.sum(c).alias(c) for c in ("source_count", "target_count")]
    return union_all(*parts).groupBy("group_name", "task_name").agg(*sums)


def reconcile_counts(tasks: Iterable[CountedTask], begin: datetime, end: datetime) -> DataFrame:
    """Only the tasks whose counts differ."""
    return count_tasks(tasks, begin, end).where("source_count != target_count")
