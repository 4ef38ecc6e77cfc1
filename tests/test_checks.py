import math
from datetime import datetime, timedelta

import pytest
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidekeep import TaskConfig
from tidekeep.operators import aggregates as a
from tidekeep.plans import cdc, repair, sqltask, verify
from tidekeep.session import scratch_path
from tidekeep.sinks.tables import append_partitions, write_full
from tidekeep.sources.scans import read_table
from tidekeep.streaming import positions

COUNTS = "task string, syn_date string, source_count bigint, target_count bigint"


def expected_limits(diffs, days, factor):
    """The definition, written out: absent days are zeros, the divisor never changes."""
    mean = sum(diffs) / days
    square = sum((d - mean) ** 2 for d in diffs) + max(days - len(diffs), 0) * mean**2
    deviation = math.sqrt(square / days)
    return mean - factor * deviation, mean + factor * deviation


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(st.integers(-500, 500), min_size=1, max_size=9), min_size=1, max_size=4))
def test_sigma_check_by_definition(spark, tasks):
    data = [
        (f"t{i}", f"2024-01-{n + 1:02d}", 1000, 1000 + d) for i, diffs in enumerate(tasks) for n, d in enumerate(diffs)
    ]
    out = a.sigma_check(spark.createDataFrame(data, COUNTS), ["task"], days=7, factor=1.3).collect()
    assert len(out) == len(data)
    for r in out:
        low, high = expected_limits(tasks[int(r.task[1:])], 7, 1.3)
        if min(abs(r["diff"] - low), abs(r["diff"] - high)) > 1e-6:
            assert r.flag == (0 if low <= r["diff"] <= high else 1)
        numbers = [float(x) for x in r.threshold.strip("[]").split(" , ")]
        assert numbers == pytest.approx([low, high], abs=0.0051)


def test_daily_counts_hold_the_whole_last_second(spark):
    last = datetime(2024, 1, 10, 23, 59, 59)
    at = [datetime(2024, 1, 8, 23, 59, 59), datetime(2024, 1, 9), last, last.replace(microsecond=1), datetime(2024, 1, 11)]
    df = spark.createDataFrame([(t,) for t in at], "at timestamp_ntz")
    counted = a.daily_counts(df, "at", datetime(2024, 1, 11, 9), days=1, trace=1)
    assert rows(counted) == [("2024-01-09", 1), ("2024-01-10", 2)]


def test_verify_sync_fills_the_missing_side(spark):
    task = "group_name string, task_name string"
    src = spark.createDataFrame([("g", "t", datetime(2024, 1, 9, 5))] * 3, f"{task}, at timestamp_ntz")
    tgt = spark.createDataFrame([("g", "t", 20240110)] * 2, f"{task}, partition_date int")
    found = verify.verify_sync(src, tgt, "at", datetime(2024, 1, 11), days=5)
    assert rows(found, "syn_date", "source_count", "target_count", "diff") == [
        ("2024-01-09", 3, 0, -3),
        ("2024-01-10", 0, 2, 2),
    ]
    saved = verify.save_results(found.withColumn("flag", F.lit(7)), found.where("syn_date = '2024-01-10'"))
    assert sorted(r.flag == 7 for r in saved.collect()) == [False, True]


def test_duplicate_keys_ignore_nulls_and_old_partitions(spark):
    data = [(1, "a", 20240101)] * 2 + [(1, None, 20240101)] * 2 + [(2, "b", 20200101)] * 2 + [(3, "c", 20240101)]
    df = spark.createDataFrame(data, "k int, s string, partition_date int")
    found = a.duplicate_keys(df, ["k", "s"], a.duplicates_since(datetime(2024, 6, 1)))
    assert rows(found) == [("k,s", "[k=1][s=a]", 2)]


def test_matching_rows_equal_the_joined_rows(spark):
    detail = spark.createDataFrame([(1,)] * 4 + [(2,)] * 3 + [(None,)], "bill_no int")
    day = datetime(2024, 1, 1)
    bills = [(1, day), (1, day), (2, day), (3, day), (2, day + timedelta(days=9))]
    master = spark.createDataFrame(bills, "bill_no int, at timestamp_ntz")
    pair, nothing = (("bill_no", "bill_no"),), detail.limit(0)
    task = verify.CountedTask(TaskConfig("g", "t"), detail, nothing, "at", master, master, pair)
    assert rows(verify.reconcile_counts([task], day, day + timedelta(days=1))) == [("g", "t", 11, 0)]
    cfg = TaskConfig("g", "t", filters=("and t.bill_no not in (2)", "p.bill_no < 9"))
    fewer = verify.CountedTask(cfg, detail, nothing, "at", master, master, pair)
    assert rows(verify.reconcile_counts([fewer], day, day + timedelta(days=1))) == [("g", "t", 8, 0)]
    same = verify.CountedTask(TaskConfig("g", "t"), detail, detail, "at", master, master, pair)
    assert rows(verify.reconcile_counts([same], day, day + timedelta(days=1))) == []


def test_sequential_ids_are_dense_and_ordered(spark):
    data = [(g, n) for g in "cab" for n in range(g.encode()[0] - 94)]
    out = a.sequential_ids(spark.createDataFrame(data, "g string, n int").repartition(6), ["g", "n"])
    assert rows(out, "id", "g", "n") == sorted(((i + 1, g, n) for i, (g, n) in enumerate(sorted(data))), key=repr)


LOG = "db_name string, table_name string, dml_type int, seq_no bigint, dml_event_time timestamp_ntz, partition_date int"


def test_backfill_days(spark):
    moments = [
        ("r", "orders_his", 2, 1, datetime(2024, 1, 2), 20240102),
        ("r", "orders", 1, 2, datetime(2024, 1, 2, 0, 0, 1), 20240102),
        ("r", "orders", 0, 3, datetime(2024, 1, 3, 5), 20240103),
        ("r", "stock", 1, 4, datetime(2020, 1, 3, 5), 20240103),
        ("r", "late", 1, 5, datetime(2024, 1, 20), 20240120),
    ]
    log = spark.createDataFrame(moments, LOG)
    tables = spark.createDataFrame([("orders",), ("stock",), ("late",)], "table_name string")
    as_of = datetime(2024, 2, 1)
    state = cdc.backfill_state(tables, log, as_of, datetime(2024, 1, 1), datetime(2024, 1, 10))
    assert rows(state) == [("late", 0), ("orders", 20240101), ("orders", 20240102), ("stock", 0)]
    known = [("orders", 20230101), ("orders", 20240101), ("x", 20231231)]
    known = spark.createDataFrame(known, "table_name string, backfill_day int")
    merged = cdc.merge_backfill(known, state.where("backfill_day > 0"), as_of)
    assert rows(merged) == [("orders", 20240101), ("orders", 20240102), ("x", 20231231)]


def test_positions(spark):
    moves = [("a", 0, 5), ("a", 1, 9), ("b", 0, 2), ("n", 0, -4)]
    log = spark.createDataFrame([("r", *m, None, 1) for m in moves], LOG)
    state = positions.positions_of(log, datetime(2024, 1, 1))
    assert [positions.load_position(state, "r", t) for t in ("a", "b", "n", "never")] == [5, 2, 0, 0]
    moved = log.where("table_name = 'a'").withColumn("seq_no", F.lit(8).cast("bigint"))
    later = positions.positions_of(moved, datetime(2024, 1, 2))
    assert positions.load_position(positions.save_position(state, later), "r", "a") == 8


PENDING = (
    "seq_no bigint, process_status int, table_name string, id_column_value string, "
    "yw_update_time timestamp_ntz, partition_date int"
)


def test_repair_applies_pending_deletes_once(spark):
    warehouse, report, deletes = (scratch_path(spark, n) for n in ("w", "r", "d"))
    table = spark.createDataFrame([(1, 202401), (2, 202401), (3, 202402), (4, None)], "k int, partition_date int")
    append_partitions(table, warehouse)
    write_full(table, report)
    at = datetime(2024, 1, 5, 1, 2, 3, 456789)
    log = [(1, 0, "t", "1", at, 20240105), (2, 1, "t", "2", at, 20240101)]
    log += [(3, 0, "other", "3", at, 20240105), (4, 0, "t", "4", at, 20240105)]
    append_partitions(spark.createDataFrame(log, PENDING), deletes)
    assert repair.delete_repair_run(spark, warehouse, report, deletes, "k", "t")
    assert rows(read_table(spark, warehouse), "k") == rows(read_table(spark, report), "k") == [(2,), (3,)]
    assert rows(read_table(spark, deletes), "seq_no", "process_status") == [(1, 1), (2, 1), (3, 0), (4, 1)]
    assert not repair.delete_repair_run(spark, warehouse, report, deletes, "k", "t")


def test_repair_of_rows_without_a_partition(spark):
    path = scratch_path(spark, "nulls")
    append_partitions(spark.createDataFrame([(1, 202401), (2, None), (3, None)], "k int, partition_date int"), path)
    log = spark.createDataFrame([("t", "2", 20240101)], "table_name string, id_column_value string, partition_date int")
    repair.delete_repair(spark, path, log, "k", "t", 20240101, 20240101)
    assert rows(read_table(spark, path)) == [(1, 202401), (3, None)]


def test_update_where_keeps_rows_the_predicate_is_unknown_for(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string")
    assert rows(repair.update_where(df, F.col("k") == 1, {"v": F.lit("x")})) == [(1, "x"), (None, "b")]


def test_sql_task_parameters(spark):
    begin, end = datetime(2024, 1, 1), datetime(2024, 1, 2)
    assert sqltask.time_arguments(("b",), begin, end) == {"b": "2024-01-01 00:00:00"}
    assert sqltask.time_arguments(("b", "e", "bm", "em"), begin, end) == {
        "b": "2024-01-01 00:00:00",
        "e": "2024-01-02 00:00:00",
        "bm": 1704067200000,
        "em": 1704153600000,
    }
    table = spark.range(1).selectExpr("id AS v")
    out = sqltask.run_sql_task(spark, "SELECT :b AS b, v FROM {t}", begin, end, ("b",), {"t": table})
    assert rows(out) == [("2024-01-01 00:00:00", 0)]


def test_parameters_are_values_not_text(spark):
    sqltask.register_function(spark, "shout", "w STRING", "STRING", "upper(w)")
    assert spark.sql("SELECT shout('a') AS s").first().s == "A"
    assert spark.sql("SELECT :v AS v", args={"v": "x'; drop table t; --"}).first().v == "x'; drop table t; --"


def test_numbering_spreads_a_crowded_group(spark, conf, monkeypatch):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    paths = []
    monkeypatch.setattr(a, "scratch_path", lambda *args: paths.append(scratch_path(*args)) or paths[-1])
    n = 40_000
    df = spark.range(0, n, 1, 16).select(F.when(F.col("id") % 5 == 0, F.col("id")).otherwise(-1).alias("g"), F.lit("x").alias("same"))
    out = a.sequential_ids(df, ["g"])
    found = out.agg(F.count("*"), F.min("id"), F.max("id"), F.count_distinct("id")).first()
    assert tuple(found) == (n, 1, n, n)
    order = out.groupBy("g").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count("*").alias("n"))
    assert order.where("hi - lo + 1 <> n").isEmpty(), "rows of a group are numbered in a row"
    ordered = [r[0] for r in order.orderBy("lo").select("g").collect()]
    assert ordered == sorted(ordered)
    sorted_rows = spark.read.parquet(paths[0]).where("g = -1").groupBy(F.shiftright("__at", 33)).count()
    assert sorted_rows.agg(F.max("count")).first()[0] < 0.5 * n, "no task sorts and numbers the crowded group alone"
    assert a.sequential_ids(df.where("g < -1"), ["g"]).isEmpty()


def test_many_registered_tables_run_in_bounded_plans(spark):
    path = scratch_path(spark, "many_checks")
    rows_of = [spark.createDataFrame([(i, 20240101)] * (1 + i % 2), "k int, partition_date int") for i in range(200)]
    checks = [verify.CheckedTable("g", f"t{i}", df, ("k",), enabled=i != 1) for i, df in enumerate(rows_of)]
    sizes, whole = [], verify.union_all

    def watched(*parts):
        sizes.append(len(parts))
        return whole(*parts)

    verify.union_all = watched
    try:
        assert verify.run_duplicate_checks(checks, datetime(2024, 2, 1), path) == 13
    finally:
        verify.union_all = whole
    assert max(sizes) <= verify.TABLES_PER_PLAN
    found = verify.read_check_results(spark, path)
    assert sorted(r["table_name"] for r in found.collect()) == sorted(f"t{i}" for i in range(3, 200, 2))
    assert verify.run_duplicate_checks(checks[:4], datetime(2024, 2, 1), path) == 1
    assert rows(verify.read_check_results(spark, path), "table_name", "occurrences", "check_day") == [("t3", 2, 20240201)]


def test_checks_of_one_table_share_its_scan(spark):
    path = scratch_path(spark, "scanned")
    data = [(1, "a", None, 20240101), (1, "b", None, 20240101), (2, "b", 5, 20240101), (1, "a", 5, 20230101)]
    append_partitions(spark.createDataFrame(data, "x int, y string, z int, partition_date int"), path)
    df = read_table(spark, path)
    checks = [verify.CheckedTable("g", "t", df, keys) for keys in (("x",), ("y",), ("z",), ("x", "y"))]
    out = verify.verify_duplicates(checks, datetime(2024, 6, 1))
    assert rows(out, "primary_key", "primary_value", "occurrences") == [("x", "[x=1]", 2), ("y", "[y=b]", 2)]
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_counts_in_batches(spark):
    path, day = scratch_path(spark, "count_checks"), datetime(2024, 1, 10)
    two = spark.createDataFrame([(day,), (day,)], "at timestamp_ntz")
    one = two.limit(1)
    tasks = [verify.CountedTask(TaskConfig("g", f"t{i}"), two, one if i == 2 else two, "at") for i in range(5)]
    assert verify.run_count_checks(tasks, day, day + timedelta(days=1), path, per_plan=2) == 3
    assert rows(verify.read_check_results(spark, path, verify.COUNT_SCHEMA)) == [("g", "t2", 2, 1, 20240110)]


def test_the_registry_names_what_is_enabled(spark):
    kind = "id int, table_name string, group_name string, is_disable int"
    registry = spark.createDataFrame([(1, "a", "g", 0), (2, "b", "g", 1), (3, "c", "g", None)], kind)
    assert verify.enabled_names(registry) == {("g", "a")}


def test_export_puts_a_status_table_back_that_a_dead_run_left_aside(spark):
    from tidekeep.plans import export
    from tidekeep.sinks.files import FileTree, Swap

    path, sent = scratch_path(spark, "status"), []
    cfg = TaskConfig("g", "t", select_columns=("v",), full_load=True)
    write_full(export.task_status(spark, TaskConfig("g", "other"), "FINISHED", datetime(2024, 1, 1)), path)
    Swap(FileTree(spark), path).take_out(path)
    df = spark.createDataFrame([(1, "x")], "v int, ods_update_time string")
    export.export(df, cfg, datetime(2024, 1, 2), lambda d: sent.extend(d.collect()), path)
    assert rows(read_table(spark, path), "task_name", "status") == [("other", "FINISHED"), ("t", "FINISHED")]
    assert [tuple(r) for r in sent] == [(1,)]


def test_repair_of_a_partitioned_report(spark):
    log = [(1, "orders", "2", datetime(2024, 1, 5), 0, 20240105)]
    kind = "seq_no int, table_name string, id_column_value string, yw_update_time timestamp_ntz, process_status int, partition_date int"
    warehouse, report, logged = (scratch_path(spark, n) for n in ("w", "r", "l"))
    table = spark.createDataFrame([(1, 202401), (2, 202401), (2, 202402), (3, 202403)], "k int, partition_date int")
    for path in (warehouse, report):
        append_partitions(table, path)
    append_partitions(spark.createDataFrame(log, kind), logged)
    assert repair.delete_repair_run(spark, warehouse, report, logged, "k", "orders")
    for path in (warehouse, report):
        assert rows(read_table(spark, path)) == [(1, 202401), (3, 202403)]
    assert rows(read_table(spark, logged), "process_status") == [(1,)]
    assert not repair.delete_repair_run(spark, warehouse, report, logged, "k", "orders")
