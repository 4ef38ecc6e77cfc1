"""The incremental clean on a stored table, the change-log stream, and what drives the history read."""

from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidekeep import SyncType, TaskConfig
from tidekeep.plans import cdc, clean
from tidekeep.session import scratch_path
from tidekeep.sinks.files import FileTree
from tidekeep.sinks.tables import append_partitions, write_full
from tidekeep.sources import extract
from tidekeep.sources.scans import read_table
from tidekeep.streaming import demux
from tidekeep.streaming.positions import POSITION_SCHEMA, Position, position_row, read_position

ROW = "k int, v string, at timestamp_ntz, partition_date int"
LOG = "seq_no bigint, dml_type int, id_column_value string, partition_date int"
CFG = TaskConfig(
    group="retail",
    target_table="orders",
    primary_keys=("k",),
    select_columns=("k", "v", "at", "partition_date"),
    sync_type=SyncType.ACID,
    lookback_months=2,
)
DAY = [datetime(2024, 3, d) for d in range(1, 15)]


def at(day, hour=1):
    return datetime(2024, 3, day, hour)


@pytest.fixture
def stored(spark):
    """A table, its position, landed rows of two days, and a log partitioned by day."""
    path, saved, log = (scratch_path(spark, n) for n in ("table", "position", "log"))
    old = [(k, "old", datetime(2024, 2, k), 20240200 + k) for k in range(1, 6)]
    append_partitions(spark.createDataFrame([*old, (6, "ancient", datetime(2023, 1, 1), 20230101)], ROW), path)
    write_full(position_row(spark, "retail", "orders", Position(10, 20240309), DAY[0]), saved)
    logged = [
        (3, 0, "5", 20240301),  # before the position: not read
        (10, 0, "99", 20240309),
        (11, 0, "2", 20240310),
        (12, 1, "3", 20240310),  # an update takes its key out too, but is no position
        (20, 0, "7", 20240311),
        (20, 0, "6", 20240311),  # too old to be touched
    ]
    append_partitions(spark.createDataFrame(logged, LOG), log)
    landed = [
        (1, "v1", at(10), 20240310), (1, "v2", at(10, 2), 20240310), (7, "new", at(10, 3), 20240310),
        (3, "late", at(11), 20240311), (8, "eight", at(11), 20240311),
    ]
    return path, saved, spark.createDataFrame(landed, ROW), read_table(spark, log)


def run(spark, stored, day, seen=None):
    path, saved, landed, log = stored
    known = log.where(F.col("partition_date") <= (seen or int(DAY[day - 1].strftime("%Y%m%d"))))
    return clean.run_clean_incremental(spark, path, saved, landed, known, CFG, DAY[day - 1], DAY[day], DAY[day])


# The update of key 3 comes after the newest delete of the first window, so it counts in the second one.
FIRST = [
    (1, "v1", 20240310), (1, "v2", 20240310), (3, "old", 20240203), (4, "old", 20240204), (5, "old", 20240205), (6, "ancient", 20230101),
    (7, "new", 20240310),
]
SECOND = [
    (1, "v1", 20240310), (1, "v2", 20240310), (4, "old", 20240204), (5, "old", 20240205), (6, "ancient", 20230101),
    (8, "eight", 20240311),
]


def test_two_windows_leave_table_and_position(spark, stored):
    path, saved, _, _ = stored
    assert run(spark, stored, 10) == Position(11, 20240310)
    assert rows(read_table(spark, path), "k", "v", "partition_date") == FIRST
    assert run(spark, stored, 11) == Position(20, 20240311)
    assert rows(read_table(spark, path), "k", "v", "partition_date") == SECOND
    assert rows(read_table(spark, saved), "sys_name", "table_name", "seq_no", "log_day") == [("retail", "orders", 20, 20240311)]


def test_a_window_whose_position_was_not_saved_is_repeated_without_harm(spark, stored):
    path, saved, _, _ = stored
    run(spark, stored, 10)
    before = spark.createDataFrame(read_table(spark, saved).collect(), POSITION_SCHEMA)
    run(spark, stored, 11)
    write_full(before, saved)
    assert run(spark, stored, 11) == Position(20, 20240311)
    assert rows(read_table(spark, path), "k", "v", "partition_date") == SECOND


def test_only_touched_partitions_are_written(spark, stored):
    path, _, _, _ = stored
    before = {f.place: f for f in FileTree(spark).data_files(path)}
    run(spark, stored, 10)
    kept = {f.place: f for f in FileTree(spark).data_files(path) if f.place in before}
    assert {f.folder for f in kept.values()} == {f"partition_date={d}" for d in (20230101, 20240203, 20240204, 20240205)}
    assert all(f == before[p] for p, f in kept.items())


def test_the_log_scan_is_pruned_by_the_position(spark, stored):
    _, _, landed, log = stored
    change = clean._changes(landed, log, CFG, Position(10, 20240309), DAY[9], DAY[10])
    plan = change.keys._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line and "id_column_value" in line]
    assert scans and all("(partition_date#" in s.split("PartitionFilters")[1].split("PushedFilters")[0] for s in scans)
    assert all(">= 20240309" in s for s in scans)


def test_a_first_run_and_one_without_a_log(spark, stored):
    path, saved = scratch_path(spark, "fresh"), scratch_path(spark, "no_position")
    _, _, landed, log = stored
    done = clean.run_clean_incremental(spark, path, saved, landed, None, CFG, DAY[9], DAY[10], DAY[10])
    assert done == Position() and read_table(spark, path).count() == 3
    assert read_position(read_table(spark, saved), "retail", "other") == Position()
    quiet = clean.run_clean_incremental(spark, path, saved, landed, log.where("dml_type = 9"), CFG, DAY[2], DAY[3], DAY[3])
    assert quiet == Position(0, None) and read_table(spark, path).count() == 3


def test_landed_rows_before_the_look_back_are_refused(spark, stored):
    path, saved, landed, log = stored
    odd = landed.withColumn("partition_date", F.when(F.col("k") == 8, 20230101).otherwise(F.col("partition_date")))
    cfg = TaskConfig(**{**CFG.__dict__, "select_columns": ("k", "v", "at", "cast(date_format(at, 'yyyy') as int) as partition_date")})
    with pytest.raises(ValueError, match="look-back"):
        clean.run_clean_incremental(spark, path, saved, odd, log, cfg, DAY[9], DAY[10], DAY[10])
    assert read_table(spark, path).count() == 6


# ---- the stream

CDC = "seq_no bigint, db_name string, table_name string, partition_date int"


def test_a_retried_batch_replaces_itself(spark):
    path = scratch_path(spark, "routed")
    batch = spark.createDataFrame([(1, "r", "a", 20240101), (2, "r", "a", 20240101), (3, None, "b", 20240102)], CDC)
    for _ in range(2):
        demux.write_batch(batch, 0, path)
    demux.write_batch(batch.where("seq_no = 1"), 1, path)
    assert rows(demux.read_routed(spark, path), "seq_no") == [(1,), (1,), (2,), (3,)]
    assert len(FileTree(spark).data_files(path)) == 3


def test_a_crowded_day_is_written_by_several_tasks(spark, conf):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    path = scratch_path(spark, "crowded")
    batch = spark.range(0, 1000, 1, 20).select(
        F.col("id").alias("seq_no"), F.lit("r").alias("db_name"), F.when(F.col("id") % 10 == 0, "few").otherwise("many").alias("table_name"),
        F.lit(20240101).alias("partition_date"),
    )
    demux.write_batch(batch, 0, path, rows_per_file=200)
    files = [f.folder for f in FileTree(spark).data_files(path)]
    many = sum("table_name=many" in f for f in files)
    assert sum("table_name=few" in f for f in files) == 1 and 2 <= many <= 5
    assert demux.read_routed(spark, path).count() == 1000


def test_files_that_land_between_runs(spark):
    landed, path, progress = (scratch_path(spark, n) for n in ("in", "out", "progress"))
    kind = spark.createDataFrame([], CDC).schema
    for n in (1, 2):
        spark.createDataFrame([(n, "r", "a", 20240101)], CDC).write.mode("append").parquet(landed)
        demux.route_new_rows(spark.readStream.schema(kind).parquet(landed), path, progress)
    demux.route_new_rows(spark.readStream.schema(kind).parquet(landed), path, progress)
    assert rows(demux.read_routed(spark, path, kind), "seq_no") == [(1,), (2,)]


# ---- backfill days and the history read


def test_history_directories_are_pruned_by_the_stored_days(spark):
    history, state = scratch_path(spark, "his"), scratch_path(spark, "state")
    days = [20240100 + d for d in range(1, 9)]
    append_partitions(spark.createDataFrame([(d, d) for d in days], "v int, partition_date int"), history)
    marks = [("orders", 20240103), ("orders", 20240199), ("stock", 20240105), ("empty", 0)]
    write_full(spark.createDataFrame(marks, "table_name string, backfill_day int"), state)
    read = extract.backfilled_rows(read_table(spark, history), read_table(spark, state), "orders")
    assert rows(read) == [(20240103, 20240103)]
    assert "dynamicpruning" in read._jdf.queryExecution().executedPlan().toString().lower()
    assert rows(extract.backfilled_rows(read_table(spark, history), read_table(spark, state), "empty")) == []


def test_merge_backfill_forgets_and_keeps(spark):
    kind = "table_name string, backfill_day int"
    state = spark.createDataFrame([("a", 20230101), ("a", 20240101), ("b", 20240102)], kind)
    found = spark.createDataFrame([("a", 20240101), ("c", 20240103)], kind)
    assert rows(cdc.merge_backfill(state, found, datetime(2024, 2, 1))) == [
        ("a", 20240101), ("b", 20240102), ("c", 20240103)
    ]


def test_extract_follows_the_state(spark):
    kind = "v int, at timestamp_ntz, partition_date int"
    live = spark.createDataFrame([(1, at(10), 20240310), (2, at(11), 20240311)], kind)
    history = spark.createDataFrame([(3, at(10), 20240310), (4, at(11), 20240311)], kind)
    state = spark.createDataFrame([("t", 20240311), ("u", 20240310)], "table_name string, backfill_day int")
    cfg = TaskConfig(select_columns=("v",), sync_time_column="at", filters=("v < 3",))
    for day, expected in ((10, [(1,)]), (11, [(2,), (4,)])):
        window = DAY[day - 1], DAY[day]
        assert rows(extract.extract_with_backfill(live, history, state, "t", cfg, *window)) == expected
