"""Cleaning: merging a window's landed rows and delete log into a table.

Two families differ on purpose. The overwriting cleans keep a key that occurs in both the delta and
the log, and keep its newest version only. The incremental clean drops such a key, and keeps every
landed version of the others.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import (
    AUDIT_ODS,
    PARTITION_COLUMN,
    SyncType,
    TaskConfig,
    day_of,
    end_day,
    lookback_months,
    months_between,
    shift_months,
)
from ..operators.aggregates import newest_delete
from ..operators.joins import (
    KEY_TEXT,
    anti_by_delta_and_log,
    delete_in,
    delta_minus_deletes,
    id_values,
    ids_as,
    key_texts,
    log_range,
    match_key,
    within,
)
from ..operators.project import CLEAN_ALIAS, apply_filters, drop_sentinels, in_lookback, project, with_audit, with_month
from ..operators.ranking import latest_per_key
from ..operators.setops import union_all
from ..sinks.files import FileTree, recover
from ..sinks.tables import replace_partitions, write_full
from ..sources.scans import read_partitions, read_table
from ..streaming.positions import POSITION_SCHEMA, Position, position_row, read_position, save_position


def _shape(rows: DataFrame, cfg: TaskConfig, as_of: datetime | None) -> DataFrame:
    """The configured columns, the audit time, and the month the row belongs to."""
    out = project(rows, cfg.select_columns, CLEAN_ALIAS)
    if as_of is not None:
        out = with_audit(out, AUDIT_ODS, as_of)
    return with_month(out, cfg.sync_time_column)


def _merge(
    target: DataFrame,
    delta: DataFrame,
    log: DataFrame | None,
    cfg: TaskConfig,
    begin: datetime,
    end: datetime,
    as_of: datetime | None,
    beyond: Sequence[int | None] = (),
) -> DataFrame:
    """Kept target rows of the look-back months, and the newest landed row of each key.

    Landed and logged days are both included at either end, so overlapping windows may be re-run. Of the months beyond,
    all rows but those of landed and logged keys are kept as they are.
    """
    days = day_of(begin), day_of(end)
    landed = read_partitions(delta, *days)
    logged = read_partitions(log, *days) if log is not None else None
    old = in_lookback(target, begin, end, cfg.lookback_months)
    kept = anti_by_delta_and_log(apply_filters(old, cfg.filters, CLEAN_ALIAS), landed, logged, cfg.primary_keys)
    fresh = _shape(apply_filters(landed, cfg.filters, CLEAN_ALIAS), cfg, as_of)
    newest = latest_per_key(fresh, cfg.primary_keys, cfg.sync_time_column)
    out = union_all(_shape(kept, cfg, as_of), newest)
    if beyond:
        place = F.col(PARTITION_COLUMN)
        there = place.isin([m for m in beyond if m is not None])
        others = target.where(there | place.isNull() if None in beyond else there)
        others = anti_by_delta_and_log(others, landed, logged, cfg.primary_keys)
        out = out.unionByName(others.select(*out.columns))
    return out


def months_beyond(delta: DataFrame, cfg: TaskConfig, begin: datetime, end: datetime) -> list[int | None]:
    """The months outside the look-back that the window's landed rows fall into: a short list."""
    lo, hi = lookback_months(begin, end, cfg.lookback_months)
    landed = apply_filters(read_partitions(delta, day_of(begin), day_of(end)), cfg.filters, CLEAN_ALIAS)
    found = with_month(landed, cfg.sync_time_column).select(PARTITION_COLUMN).distinct().collect()
    return [r[0] for r in found if r[0] is None or not lo <= r[0] <= hi]


def clean_rewrite(
    target: DataFrame,
    delta: DataFrame,
    log: DataFrame | None,
    cfg: TaskConfig,
    begin: datetime,
    end: datetime,
    as_of: datetime | None = None,
    beyond: Sequence[int | None] = (),
) -> DataFrame:
    """Content of the look-back months, and of the months beyond, when they are dropped and written again."""
    return _merge(target, delta, log, cfg, begin, end, as_of, beyond)


def clean_overwrite(
    target: DataFrame,
    delta: DataFrame,
    log: DataFrame | None,
    cfg: TaskConfig,
    begin: datetime,
    end: datetime,
    as_of: datetime | None = None,
    beyond: Sequence[int | None] = (),
) -> DataFrame:
    """Content of the look-back months, and of the months beyond, when they are overwritten; placeholder rows are not
    carried over."""
    return _merge(drop_sentinels(target), delta, log, cfg, begin, end, as_of, beyond)


def run_clean(
    spark: SparkSession,
    path: str,
    delta: DataFrame,
    log: DataFrame | None,
    cfg: TaskConfig,
    begin: datetime,
    end: datetime,
    as_of: datetime | None = None,
    schema: T.StructType | None = None,
) -> None:
    """Clean a month-partitioned table in place, the way its configuration asks for.

    The schema is needed only when the table may be empty or missing. Running a window again changes
    nothing, so a run that died is simply repeated. Months outside the look-back that landed rows fall into are read and
    written too, so none of their other rows is lost and no landed row is stored twice.
    """
    recover(FileTree(spark), path)
    target = read_table(spark, path, schema=schema)
    lo, hi = lookback_months(begin, end, cfg.lookback_months)
    cleans = {SyncType.REWRITE: clean_rewrite, SyncType.OVERWRITE: clean_overwrite}
    if cfg.sync_type not in cleans:
        raise ValueError("the incremental clean keeps a position; use clean_incremental")
    beyond = months_beyond(delta, cfg, begin, end)
    rows = cleans[cfg.sync_type](target, delta, log, cfg, begin, end, as_of, beyond)
    # Kept rows whose time points to another month than their partition move there, and are added.
    replace_partitions(rows, path, [*months_between(lo, hi), *beyond], beyond="append")


@dataclass(frozen=True)
class IncrementalClean:
    """Result of an incremental clean, and the position the next one starts from."""

    table: DataFrame
    position: int


@dataclass(frozen=True)
class _Changes:
    """One incremental window. keys: texts of the keys that go, as `__key`; inserted: the landed rows that come."""

    keys: DataFrame
    inserted: DataFrame
    oldest: int
    position: Position


def _changes(
    delta: DataFrame, log: DataFrame | None, cfg: TaskConfig, position: Position, begin: datetime, end: datetime
) -> _Changes:
    landed = read_partitions(delta, day_of(begin), end_day(end))
    keys = key_texts(apply_filters(landed, cfg.filters, CLEAN_ALIAS), cfg.primary_keys)
    inserted, newest = landed, position
    if log is not None:
        if position.log_day is not None:
            log = log.where(F.col(PARTITION_COLUMN) >= position.log_day)
        found = newest_delete(log).first()
        if found is not None and found[0] < 0 and position.seq_no > found[0]:
            raise ValueError(f"log position went back from {position.seq_no} to {found[0]}")
        if found is not None and found[0] >= position.seq_no:
            newest = Position(*found)
        keys = keys.union(id_values(log_range(log, position.seq_no, newest.seq_no)))
        inserted = delta_minus_deletes(landed, log, cfg.primary_keys, position.seq_no, newest.seq_no)
    added = project(apply_filters(inserted, cfg.filters, CLEAN_ALIAS), cfg.select_columns, CLEAN_ALIAS)
    return _Changes(keys, added, day_of(shift_months(begin, -cfg.lookback_months)), newest)


def clean_incremental(
    target: DataFrame,
    delta: DataFrame,
    log: DataFrame | None,
    cfg: TaskConfig,
    position: int,
    begin: datetime,
    end: datetime,
) -> IncrementalClean:
    """Delete changed and deleted keys, then insert the landed rows that were not deleted.

    The log is read from the saved position to its newest delete, both included. Without a log, and in a log without
    deletes, the position stays. The new position is one number, the only thing the driver sees.
    """
    change = _changes(delta, log, cfg, Position(position), begin, end)
    kept = delete_in(target, change.keys, cfg.primary_keys, change.oldest)
    return IncrementalClean(union_all(kept, change.inserted), change.position.seq_no)


def run_clean_incremental(
    spark: SparkSession,
    path: str,
    positions_path: str,
    delta: DataFrame,
    log: DataFrame | None,
    cfg: TaskConfig,
    begin: datetime,
    end: datetime,
    as_of: datetime,
    schema: T.StructType | None = None,
) -> Position:
    """Run one window of the incremental clean on a stored, day-partitioned table, and save the log position.

    The system and table of the position are the configuration's group and target table (or trigger). Only partitions that hold
    a deleted key or get a landed row are written: which ones is found from the keys and the partition column. The log is read
    from the partition of the saved position on, so its partitions must follow its sequence numbers. The table is switched
    first and the position saved last. A run that dies in between is repeated with the old position, and does no harm: the
    window's rows are deleted by their keys before they are inserted again, so landed rows must not lie before the look-back.
    """
    name = cfg.target_table or cfg.trigger
    for place in (path, positions_path):
        recover(FileTree(spark), place)
    state = read_table(spark, positions_path, schema=T.StructType.fromDDL(POSITION_SCHEMA))
    change = _changes(delta, log, cfg, read_position(state, cfg.group, name), begin, end)
    target = read_table(spark, path, schema=schema or change.inserted.schema)
    place = F.col(PARTITION_COLUMN)
    scope = target.where(place >= change.oldest)
    hit = scope.select(*cfg.primary_keys, place).withColumn(KEY_TEXT, match_key(target, cfg.primary_keys))
    hit = within(hit, ids_as(change.keys, target, cfg.primary_keys), [KEY_TEXT]).select(place)
    # One number per partition reaches the driver.
    places = [r[0] for r in hit.union(change.inserted.select(place)).distinct().collect()]
    early = [p for p in places if p is None or p < change.oldest]
    if early:
        raise ValueError(f"landed rows in partitions {early}, before the look-back that starts at {change.oldest}")
    if places:
        kept = delete_in(target.where(place.isin(places)), change.keys, cfg.primary_keys, change.oldest)
        replace_partitions(union_all(kept, change.inserted), path, places, beyond="refuse")
    row = position_row(spark, cfg.group, name, change.position, as_of)
    write_full(save_position(state, row), positions_path)
    return change.position


def clean_full(src: DataFrame, cfg: TaskConfig) -> DataFrame:
    """Content of a table that is truncated and loaded anew."""
    return project(apply_filters(src, cfg.filters), cfg.select_columns)


def run_clean_full(src: DataFrame, cfg: TaskConfig, path: str, column: str | None = None) -> None:
    write_full(clean_full(src, cfg), path, column)
