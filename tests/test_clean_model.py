"""The cleans against their definition, written out in plain Python over random small tables."""

from datetime import datetime, timedelta

from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st

from tidekeep import TaskConfig
from tidekeep.config import day_of, month_of
from tidekeep.plans import clean

BEGIN, END = datetime(2024, 3, 10), datetime(2024, 3, 12)
CFG = TaskConfig(
    primary_keys=("a", "b"),
    select_columns=("a", "b", "v", "at", "ods_update_time"),
    sync_time_column="at",
    lookback_months=2,
)
DAILY = TaskConfig(primary_keys=("a", "b"), select_columns=("a", "b", "v", "partition_date"), lookback_months=2)
TABLE = "a string, b string, v int, at timestamp_ntz, ods_update_time string, partition_date int"
LOG = "seq_no bigint, dml_type int, id_column_value string, partition_date int"

part = st.sampled_from(["x", "y", "x,y", None])
old_time = st.datetimes(datetime(2023, 12, 1), datetime(2024, 4, 1)).map(lambda t: t.replace(microsecond=0))
new_time = st.integers(0, 4 * 24).map(lambda h: datetime(2024, 3, 9) + timedelta(hours=h))
audit = st.sampled_from([None, "999999", "2024-01-01 00:00:00"])
old_rows = st.lists(st.tuples(part, part, st.integers(0, 9), old_time, audit), max_size=12)
new_rows = st.lists(st.tuples(part, part, st.integers(0, 9), new_time, st.none()), max_size=12)
ids = st.sampled_from(["x,y", "y,x", "x,x", "x,y,y", "x,x,y", None])
log_rows = st.lists(st.tuples(st.integers(1, 30), st.integers(0, 2), ids, new_time), max_size=6)


def key_text(row):
    return None if None in row[:2] else f"{row[0]},{row[1]}"


def shape(row):
    return (*row[:4], month_of(row[3]))


def model_overwrite(old, new, log):
    """Kept rows of the look-back months, then the newest landed row per key."""
    days = range(day_of(BEGIN), day_of(END) + 1)
    landed = [r for r in new if day_of(r[3]) in days]
    keys = {r[:2] for r in landed if None not in r[:2]}
    logged = {i for _, _, i, t in log if day_of(t) in days} - {None}
    kept = [
        r
        for r in old
        if 202401 <= month_of(r[3]) <= 202403 and r[4] != "999999" and r[:2] not in keys and key_text(r) not in logged
    ]
    newest = {}
    for r in sorted(landed, key=lambda r: (r[3], -r[2])):
        newest[r[:2]] = r
    return [shape(r) for r in kept] + [shape(r) for r in newest.values()]


def model_incremental(old, new, log, position):
    """Deleted and changed keys out, then the landed rows that were not deleted, all versions."""
    landed = [r for r in new if day_of(BEGIN) <= day_of(r[3]) <= 20240311]
    newest = max((n for n, kind, _, _ in log if kind == 0), default=0)
    logged = {i for n, _, i, _ in log if position <= n <= newest} - {None}
    gone = logged | {key_text(r) for r in landed} - {None}
    kept = [r for r in old if day_of(r[3]) < 20240110 or key_text(r) is None or key_text(r) not in gone]
    return [(*r[:3], day_of(r[3])) for r in kept + [r for r in landed if key_text(r) not in logged]]


def frames(spark, old, new, log, part_of):
    return (
        spark.createDataFrame([(*r, part_of(r[3])) for r in old], TABLE),
        spark.createDataFrame([(*r, day_of(r[3])) for r in new], TABLE),
        spark.createDataFrame([(n, kind, i, day_of(t)) for n, kind, i, t in log], LOG),
    )


@settings(max_examples=12, deadline=None)
@given(old_rows, new_rows, log_rows)
def test_overwrite_follows_its_definition(spark, old, new, log):
    out = clean.clean_overwrite(*frames(spark, old, new, log, month_of), CFG, BEGIN, END)
    assert rows(out, "a", "b", "v", "at", "partition_date") == sorted(model_overwrite(old, new, log), key=repr)


@settings(max_examples=12, deadline=None)
@given(old_rows, new_rows, log_rows, st.integers(0, 20))
def test_incremental_follows_its_definition(spark, old, new, log, position):
    done = clean.clean_incremental(*frames(spark, old, new, log, day_of), DAILY, position, BEGIN, END)
    expected = model_incremental(old, new, log, position)
    assert rows(done.table, "a", "b", "v", "partition_date") == sorted(expected, key=repr)
