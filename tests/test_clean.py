from dataclasses import replace
from datetime import datetime

import pytest
from conftest import rows

from tidekeep import SyncType, TaskConfig
from tidekeep.plans import clean
from tidekeep.session import scratch_path
from tidekeep.sinks.tables import append_partitions
from tidekeep.sources.scans import read_table

BEGIN, END = datetime(2024, 3, 10), datetime(2024, 3, 11)
CFG = TaskConfig(primary_keys=("k",), select_columns=("k", "v", "at", "ods_update_time"), sync_time_column="at")
ROW = "k int, v string, at timestamp_ntz, ods_update_time string, partition_date int"
LOG = "seq_no bigint, dml_type int, id_column_value string, partition_date int"


def row(k, v, at, part, audit=None):
    return k, v, at, audit, part


@pytest.fixture
def frames(spark):
    target = spark.createDataFrame(
        [
            row(1, "old", datetime(2024, 2, 1), 202402),
            row(2, "kept", datetime(2024, 2, 2), 202402),
            row(3, "logged", datetime(2024, 1, 3), 202401),
            row(4, "both", datetime(2024, 3, 1), 202403),
            row(5, "too old", datetime(2022, 1, 1), 202201),
            row(6, "sentinel", datetime(2024, 2, 1), 202402, "999999"),
            row(None, "no key", datetime(2024, 2, 3), 202402),
        ],
        ROW,
    )
    delta = spark.createDataFrame(
        [
            row(1, "v1", datetime(2024, 3, 10, 1), 20240310),
            row(1, "v2", datetime(2024, 3, 10, 2), 20240310),
            row(4, "both new", datetime(2024, 3, 10, 3), 20240310),
            row(5, "revived", datetime(2024, 3, 11, 1), 20240311),
            row(7, "other day", datetime(2024, 3, 12), 20240312),
        ],
        ROW,
    )
    log = spark.createDataFrame(
        [(10, 0, "3", 20240310), (11, 0, "4", 20240310), (12, 1, "2", 20240312), (13, 2, "99", 20240310)], LOG
    )
    return target, delta, log


def test_overwrite_semantics(frames):
    out = rows(clean.clean_overwrite(*frames, CFG, BEGIN, END), "k", "v", "partition_date")
    assert out == [
        (1, "v2", 202403),
        (2, "kept", 202402),
        (4, "both new", 202403),
        (5, "revived", 202403),
        (None, "no key", 202402),
    ]


def test_rewrite_keeps_placeholders_and_otherwise_agrees(frames):
    rewritten = rows(clean.clean_rewrite(*frames, CFG, BEGIN, END), "k", "v", "partition_date")
    overwritten = rows(clean.clean_overwrite(*frames, CFG, BEGIN, END), "k", "v", "partition_date")
    assert set(rewritten) - set(overwritten) == {(6, "sentinel", 202402)}
    assert not set(overwritten) - set(rewritten)


def test_rewrite_and_overwrite_agree_without_placeholders(frames):
    target, delta, log = frames
    target = target.where("k is null or k <> 6")
    assert rows(clean.clean_rewrite(target, delta, log, CFG, BEGIN, END)) == rows(
        clean.clean_overwrite(target, delta, log, CFG, BEGIN, END)
    )


def test_filters_apply_to_kept_and_landed_rows(frames):
    cfg = replace(CFG, filters=("and v not like 'kept%'", "v <> 'v2'"))
    out = dict(rows(clean.clean_overwrite(*frames, cfg, BEGIN, END), "k", "v"))
    assert out[1] == "v1" and 2 not in out


def test_without_a_log_only_the_delta_decides(frames):
    target, delta, _ = frames
    out = dict(rows(clean.clean_overwrite(target, delta, None, CFG, BEGIN, END), "k", "v"))
    assert out[3] == "logged"


@pytest.mark.parametrize("sync_type", [SyncType.REWRITE, SyncType.OVERWRITE])
def test_table_is_cleaned_in_place_and_again_without_change(spark, frames, sync_type):
    target, delta, log = frames
    path = scratch_path(spark, "clean")
    append_partitions(target, path)
    cfg = replace(CFG, sync_type=sync_type)
    clean.run_clean(spark, path, delta, log, cfg, BEGIN, END)
    once = rows(read_table(spark, path), "k", "v", "partition_date")
    assert (3, "logged", 202401) not in once, "January lost its only row and must be cleared"
    assert (5, "too old", 202201) in once and (5, "revived", 202403) in once, "late duplicates survive"
    clean.run_clean(spark, path, delta, log, cfg, BEGIN, END)
    assert rows(read_table(spark, path), "k", "v", "partition_date") == once


def test_first_clean_of_a_missing_table(spark, frames):
    _, delta, log = frames
    path = scratch_path(spark, "first")
    clean.run_clean(spark, path, delta, log, CFG, BEGIN, END, schema=delta.schema)
    assert rows(read_table(spark, path), "k", "v") == [(1, "v2"), (4, "both new"), (5, "revived")]


def test_incremental_drops_keys_in_both_and_keeps_every_version(spark, frames):
    target, delta, log = frames
    target = target.withColumn("partition_date", target.partition_date * 100 + 1)
    cfg = replace(CFG, select_columns=(*CFG.select_columns, "partition_date"))
    done = clean.clean_incremental(target, delta, log, cfg, 10, BEGIN, datetime(2024, 3, 12))
    assert done.position == 11
    assert rows(done.table, "k", "v") == [
        (1, "v1"),
        (1, "v2"),
        (2, "kept"),
        (5, "revived"),
        (5, "too old"),
        (6, "sentinel"),
        (None, "no key"),
    ]


def test_incremental_without_a_log_takes_the_window_only(spark, frames):
    target, delta, _ = frames
    cfg = replace(CFG, select_columns=(*CFG.select_columns, "partition_date"))
    done = clean.clean_incremental(target, delta, None, cfg, 3, BEGIN, datetime(2024, 3, 12))
    assert done.position == 3
    assert (7, "other day") not in rows(done.table, "k", "v")


@pytest.mark.parametrize("position", [0, 900])
def test_incremental_position_stays_when_nothing_was_deleted(spark, frames, position):
    target, delta, log = frames
    cfg = replace(CFG, select_columns=(*CFG.select_columns, "partition_date"))
    done = clean.clean_incremental(target, delta, log.where("dml_type <> 0"), cfg, position, BEGIN, END)
    assert done.position == position


@pytest.mark.parametrize("sync_type", [SyncType.REWRITE, SyncType.OVERWRITE])
def test_late_rows_neither_wipe_their_month_nor_double(spark, sync_type):
    schema = "k int, v string, at timestamp_ntz, ods_update_time string, partition_date int"
    old, late = datetime(2020, 1, 5), datetime(2020, 1, 9)
    path = scratch_path(spark, "late")
    held = [(i, "old", old, "x", 202001) for i in range(10)] + [(50, "undated", None, "x", None), (60, "in", BEGIN, "x", 202403)]
    spark.createDataFrame(held, schema).write.partitionBy("partition_date").parquet(path)
    day = int(BEGIN.strftime("%Y%m%d"))
    landed = [(3, "late", late, None, day), (51, "no time", None, None, day), (60, "new", BEGIN, None, day)]
    delta = spark.createDataFrame(landed, schema)
    want = [(i, "late" if i == 3 else "old") for i in range(10)] + [(50, "undated"), (51, "no time"), (60, "new")]
    for _ in range(2):
        clean.run_clean(spark, path, delta, None, replace(CFG, sync_type=sync_type), BEGIN, END)
        assert rows(read_table(spark, path), "k", "v") == sorted(want, key=repr)


def test_incremental_refuses_run_clean(spark, frames):
    path = scratch_path(spark, "acid")
    append_partitions(frames[0], path)
    with pytest.raises(ValueError):
        clean.run_clean(spark, path, frames[1], frames[2], replace(CFG, sync_type=SyncType.ACID), BEGIN, END)
