"""Counts, checks and run-log summaries. Every grouping pre-aggregates before its shuffle."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import (
    DUPLICATE_DAYS,
    HALF_YEAR_SECONDS,
    PARTITION_COLUMN,
    SIGMA_DAYS,
    SIGMA_FACTOR,
    TRACE_DAYS,
    day_of,
    time_text,
)
from ..functions.dates import age_seconds, time_literal
from ..functions.text import key_label, threshold_text
from ..session import scratch_path
from .joins import enrich, latest_by_join


# How the scheduler's names tell tasks apart, unless a caller says otherwise.
CLEAN_TASKS, EXPORT_GROUPS, COMMON_GROUP, FINAL_GROUPS = "%cln", "%hive", "dc_common", "%_hive"


def check_days(as_of: datetime, days: int, trace: int) -> tuple[datetime, datetime]:
    """First and last moment of the checked days, `trace` days back; days + 1 calendar days."""
    midnight = as_of.replace(hour=0, minute=0, second=0, microsecond=0)
    return midnight - timedelta(days=days + trace), midnight - timedelta(days=trace) + timedelta(
        hours=23, minutes=59, seconds=59
    )


def daily_counts(
    df: DataFrame,
    time_column: str,
    as_of: datetime,
    days: int = SIGMA_DAYS,
    trace: int = TRACE_DAYS,
    by: Sequence[str] = (),
    name: str = "source_count",
) -> DataFrame:
    """Rows per day of the time column over the checked days."""
    first, last = check_days(as_of, days, trace)
    c = F.col(time_column)
    after = last + timedelta(seconds=1)
    inside = (c >= time_literal(df, time_column, first)) & (c < time_literal(df, time_column, after))
    counts = df.where(inside).groupBy(*by, F.to_date(c).alias("__day")).agg(F.count(F.lit(1)).alias(name))
    return counts.select(*by, F.date_format("__day", "yyyy-MM-dd").alias("syn_date"), name)


def daily_counts_union(
    live: DataFrame,
    history: DataFrame,
    time_column: str,
    as_of: datetime,
    days: int = SIGMA_DAYS,
    trace: int = TRACE_DAYS,
    by: Sequence[str] = (),
    name: str = "source_count",
) -> DataFrame:
    """Daily counts of the live and the history table added up."""
    parts = [daily_counts(t, time_column, as_of, days, trace, by, "n") for t in (live, history)]
    return parts[0].unionByName(parts[1]).groupBy(*by, "syn_date").agg(F.sum("n").alias(name))


def partition_counts(
    df: DataFrame, lo: int, hi: int, by: Sequence[str] = (), name: str = "target_count"
) -> DataFrame:
    """Rows per partition, both ends of the range included."""
    rows = df.where(F.col(PARTITION_COLUMN).between(lo, hi))
    return rows.groupBy(*by, PARTITION_COLUMN).agg(F.count(F.lit(1)).alias(name))


def sigma_check(
    counts: DataFrame, by: Sequence[str], days: int = SIGMA_DAYS, factor: float = SIGMA_FACTOR
) -> DataFrame:
    """Flag days whose difference lies outside mean ± factor · deviation.

    Mean and population deviation run over `days` days; a day without a row counts as a difference of
    0, and the divisor is `days` even if more rows are present. The input has one row per task and
    day, so a window per task holds at most a few dozen rows.
    """
    task = Window.partitionBy(*by)
    diff = (F.col("target_count") - F.col("source_count")).alias("diff")
    rows = counts.select("*", diff)
    rows = rows.withColumn("__mean", F.sum("diff").over(task) / F.lit(float(days)))
    spread = F.sum(F.pow(F.col("diff") - F.col("__mean"), 2)).over(task)
    absent = F.greatest(F.lit(days) - F.count(F.lit(1)).over(task), F.lit(0))
    deviation = F.sqrt((spread + absent * F.pow("__mean", 2)) / F.lit(float(days)))
    rows = rows.withColumn("__low", F.col("__mean") - factor * deviation)
    rows = rows.withColumn("__high", F.col("__mean") + factor * deviation)
    return rows.select(
        *counts.columns,
        "diff",
        threshold_text(F.col("__low"), F.col("__high")).alias("threshold"),
        F.when(F.col("diff").between(F.col("__low"), F.col("__high")), 0).otherwise(1).alias("flag"),
    )


def duplicate_keys(df: DataFrame, pks: Sequence[str], since: int) -> DataFrame:
    """Keys that occur more than once in partitions from `since` on; a NULL part disqualifies a key."""
    rows = df.where(F.col(PARTITION_COLUMN) >= since).na.drop(subset=list(pks))
    repeated = rows.groupBy(*pks).agg(F.count(F.lit(1)).alias("occurrences")).where("occurrences > 1")
    return repeated.select(
        F.lit(",".join(pks)).alias("primary_key"), key_label(pks).alias("primary_value"), "occurrences"
    )


def duplicates_since(as_of: datetime, days: int = DUPLICATE_DAYS) -> int:
    return day_of(as_of - timedelta(days=days))


def row_count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def count_if_distinct(predicate: Column, value: Column) -> Column:
    """Distinct values among the rows the predicate holds for."""
    return F.count_distinct(F.when(predicate, value))


def _since_midnight(log: DataFrame, as_of: datetime) -> DataFrame:
    midnight = as_of.replace(hour=0, minute=0, second=0, microsecond=0)
    return log.where(
        (F.col("create_time") >= time_literal(log, "create_time", midnight))
        & (F.col("create_time") <= time_literal(log, "create_time", as_of))
    )


def latest_failures(log: DataFrame, as_of: datetime) -> DataFrame:
    """Tasks whose newest run of the day was interrupted."""
    newest = latest_by_join(_since_midnight(log, as_of), ["group_name", "scheduler_name"], "create_time")
    return newest.where("task_status = 'INTERRUPTED'").select("group_name", "scheduler_name").distinct()


def run_summary(
    log: DataFrame,
    as_of: datetime,
    clean_like: str = CLEAN_TASKS,
    export_like: str = EXPORT_GROUPS,
    common_like: str = COMMON_GROUP,
) -> DataFrame:
    """The day in one row: finished imports, cleans and exports, and tasks left interrupted. The patterns tell them apart:
    cleans by their scheduler, exports by their group, and a group whose runs count as none of the three."""
    group, scheduler = F.col("group_name"), F.col("scheduler_name")
    task = F.concat(scheduler, group)
    cleaning, exporting = scheduler.like(clean_like), group.like(export_like)
    finished = _since_midnight(log, as_of).where("task_status = 'FINISHED'")
    done = finished.agg(
        count_if_distinct(~exporting & ~group.like(common_like) & ~cleaning, task).alias("import_success"),
        count_if_distinct(~exporting & cleaning, task).alias("remove_success"),
        count_if_distinct(exporting & ~cleaning, task).alias("export_success"),
    )
    failures = latest_failures(log, as_of).agg(F.count(F.lit(1)).alias("exception_count"))
    parts = done.unionByName(failures, allowMissingColumns=True)
    return parts.agg(*[F.max(c).alias(c) for c in parts.columns])


def max_seq(log: DataFrame) -> DataFrame:
    """High-water mark of the deletes in a log."""
    return log.where("dml_type = 0").agg(F.max("seq_no").alias("max_seq_no"))


def newest_delete(log: DataFrame) -> DataFrame:
    """The newest delete of a log, one row or none: its sequence number and its partition."""
    place = F.col(PARTITION_COLUMN) if PARTITION_COLUMN in log.columns else F.lit(None).cast("int")
    last = F.max(F.struct("seq_no", place.alias(PARTITION_COLUMN))).alias("last")
    found = log.where("dml_type = 0 and seq_no is not null").agg(last).where("last is not null")
    return found.select("last.seq_no", f"last.{PARTITION_COLUMN}")


def pending_delete_ranges(log: DataFrame, time_column: str = "yw_update_time") -> DataFrame:
    """Time range of the unprocessed deletes of each table."""
    return (
        log.where("process_status = 0")
        .groupBy("table_name")
        .agg(F.min(time_column).alias("min_time"), F.max(time_column).alias("max_time"))
    )


def sequential_ids(df: DataFrame, order: Sequence[str], name: str = "id") -> DataFrame:
    """Number the rows 1..n in the given order, however many share a value.

    Rows are dealt to tasks by ranges of the order and sorted there; rows that agree in it are told apart by their other columns,
    and equal rows by chance, so a crowded value is spread over tasks as well. The sorted rows are kept in the shared folder,
    since the numbers rest on where each row lies: a task's rows are numbered from the rows before it, one sum per task.
    """
    spark = df.sparkSession
    rest = [c for c in df.columns if c not in order]
    keys = [*[F.col(c) for c in order], *([F.xxhash64(*rest)] if rest else []), F.rand(7)]
    named = {f"__k{i}": k for i, k in enumerate(keys)}
    ranged = df.withColumns(named).repartitionByRange(*named).sortWithinPartitions(*named).drop(*named)
    # The upper bits of this number are the task's, the lower ones the row's place in it.
    ranged = ranged.withColumn("__at", F.monotonically_increasing_id())
    path = scratch_path(spark, "numbered")
    ranged.write.parquet(path)
    kept = spark.read.schema(ranged.schema).parquet(path)
    kept = kept.withColumn("__task", F.shiftright("__at", 33))
    sizes = kept.groupBy("__task").agg(F.count(F.lit(1)).alias("__n"))
    # One row per task, so one window over all of them is small.
    before = Window.orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__task", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    place = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    numbered = kept.join(offsets, "__task").withColumn(name, F.col("__before") + place + 1)
    return numbered.select(*df.columns, name)


def final_status(log: DataFrame, targets: DataFrame, as_of: datetime, group_like: str = FINAL_GROUPS) -> DataFrame:
    """Last finished export of each task today, with its target table and a running id."""
    midnight = as_of.replace(hour=0, minute=0, second=0, microsecond=0)
    done = (
        log.where(
            F.col("group_name").like(group_like)
            & (F.col("task_status") == "FINISHED")
            & (F.col("create_time") > time_literal(log, "create_time", midnight))
            & (F.col("create_time") <= time_literal(log, "create_time", as_of))
        )
        .groupBy("scheduler_name", "group_name")
        .agg(F.max("sync_end_time").alias("sync_end_time"), F.max("create_time").alias("create_time"))
    )
    named = enrich(done, targets, ["scheduler_name", "group_name"])
    return sequential_ids(named, ["group_name", "scheduler_name"]).select(
        "id", "target_table", F.lit(1).alias("status"), "sync_end_time", "create_time",
        F.lit(time_text(as_of)).alias("refresh_time"),
    )


def daily_profile(df: DataFrame, time_column: str, as_of: datetime) -> DataFrame:
    """Rows per day over the half year before `as_of`, newest day first."""
    young = age_seconds(F.col(time_column), as_of) <= HALF_YEAR_SECONDS
    # The plain bound lets the scan skip old files; the exact test is the one on the age.
    floor = time_literal(df, time_column, as_of - timedelta(seconds=HALF_YEAR_SECONDS + 1))
    rows = df.where((F.col(time_column) >= floor) & young)
    counts = rows.groupBy(F.to_date(time_column).alias("__day")).agg(F.count(F.lit(1)).alias("rows"))
    return counts.select(F.date_format("__day", "yyyy-MM-dd").alias("day"), "rows").orderBy(F.col("day").desc())


def recent_finished(log: DataFrame, task_id: str, as_of: datetime, days: int = 2) -> DataFrame:
    """Finished runs of one task whose day lies after `days` days ago."""
    since = (as_of - timedelta(days=days)).date().isoformat()
    rows = log.where(
        (F.col("task_id") == task_id)
        & (F.col("task_status") == "FINISHED")
        & (F.to_date("create_time") > F.lit(since).cast("date"))
    )
    return rows.agg(F.count(F.lit(1)).alias("finished_runs"))


def uniqueness(df: DataFrame, key: str) -> DataFrame:
    """Row count against distinct key count."""
    return df.agg(F.count(F.lit(1)).alias("total_rows"), F.count_distinct(key).alias("distinct_keys"))


def distinct_of(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()
