"""Task settings and the window arithmetic that is done once per run, on the driver."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime, timedelta
from enum import IntEnum

# Names every layer of the warehouse agrees on.
PARTITION_COLUMN = "partition_date"
AUDIT_SRC = "src_update_time"
AUDIT_ODS = "ods_update_time"
AUDIT_BUSINESS = "yw_update_time"
SENTINEL = "999999"
NULL_MARKER = "\\N"
FIELD_DELIMITER = "\u0001"
LINE_DELIMITER = "\n"
TIME_FORMAT = "%Y-%m-%d %H:%M:%S"

# Defaults of the tool's settings.
LOOKBACK_MONTHS = 12
EXPORT_DAYS = 40
EXPORT_WRITERS = 5
SIGMA_DAYS = 60
SIGMA_FACTOR = 2.0
TRACE_DAYS = 1
DUPLICATE_DAYS = 365
BACKFILL_DAYS_KEPT = 365
RETAINED_SNAPSHOTS = 2
BACKUP_DAYS = 10
HALF_YEAR_SECONDS = 15_768_000


class SyncType(IntEnum):
    """How a cleaned table is maintained."""

    ACID = 0
    REWRITE = 1
    OVERWRITE = 2


@dataclass(frozen=True)
class TaskConfig:
    """One table at one stage; everything an operator needs to know about it."""

    group: str = ""
    trigger: str = ""
    target_table: str = ""
    primary_keys: tuple[str, ...] = ()
    relation_columns: tuple[str, ...] = ()
    select_columns: tuple[str, ...] = ()
    history_columns: tuple[str, ...] = ()
    sync_time_column: str = ""
    time_type: str = "timestamp"
    filters: tuple[str, ...] = ()
    full_load: bool = False
    sync_type: SyncType = SyncType.OVERWRITE
    lookback_months: int = LOOKBACK_MONTHS
    export_days: int = EXPORT_DAYS
    type_overrides: Mapping[str, str] = field(default_factory=dict)
    # What the trigger of a change-log task ends with; None means the usual ones.
    log_suffixes: tuple[str, ...] | None = None


def shift_months(when: datetime, months: int) -> datetime:
    """Move by whole months, clamping to the last day of the month."""
    index = when.year * 12 + when.month - 1 + months
    year, month = divmod(index, 12)
    first = when.replace(year=year, month=month + 1, day=1)
    following = (first + timedelta(days=31)).replace(day=1)
    return first.replace(day=min(when.day, (following - timedelta(days=1)).day))


def time_text(when: datetime) -> str:
    return when.strftime(TIME_FORMAT)


def day_of(when: datetime) -> int:
    return int(when.strftime("%Y%m%d"))


def month_of(when: datetime) -> int:
    return int(when.strftime("%Y%m"))


def end_day(end: datetime) -> int:
    """Partition day of an exclusive window end: midnight belongs to the day before."""
    return day_of(end - timedelta(seconds=1))


def lookback_months(begin: datetime, end: datetime, months: int = LOOKBACK_MONTHS) -> tuple[int, int]:
    """Inclusive month range a clean may rewrite."""
    return month_of(shift_months(begin, -months)), month_of(end)


def months_between(lo: int, hi: int) -> list[int]:
    """Every yyyyMM from lo to hi, both included."""
    first = lo // 100 * 12 + lo % 100 - 1
    last = hi // 100 * 12 + hi % 100 - 1
    return [m // 12 * 100 + m % 12 + 1 for m in range(first, last + 1)]


def export_span(as_of: datetime, days: int = EXPORT_DAYS, grain: str = "day") -> tuple[int, int]:
    """Inclusive partition range of the last `days` days, by day or by month partition."""
    part = {"day": day_of, "month": month_of}[grain]
    return part(as_of - timedelta(days=days)), part(as_of)


def validate_window(begin: datetime, end: datetime) -> None:
    """Extract windows must be longer than zero and no longer than a day."""
    if end <= begin:
        raise ValueError(f"window end {end} must lie after its begin {begin}")
    if end - begin > timedelta(days=1):
        raise ValueError(f"window {begin} - {end} is longer than one day")
