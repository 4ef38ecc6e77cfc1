from datetime import datetime

from conftest import rows
from pyspark.sql import functions as F

from tidekeep import TaskConfig
from tidekeep.operators import joins, ranking, setops


def test_null_keys_never_match(spark):
    target = spark.createDataFrame([(1, "a"), (None, "b"), (2, "c")], "k int, v string")
    delta = spark.createDataFrame([(1,), (None,)], "k int")
    assert rows(joins.anti_by_keys(target, delta, ["k"]), "v") == [("b",), ("c",)]


def test_composite_key_text_is_null_when_a_part_is(spark):
    target = spark.createDataFrame([("x", None), ("x", "y")], "a string, b string")
    log = spark.createDataFrame([("x,y",), ("x",), (None,)], "id_column_value string")
    assert rows(joins.anti_by_id_value(target, log, ["a", "b"])) == [("x", None)]


def test_combined_anti_join_equals_the_two_single_ones(spark):
    target = spark.createDataFrame(
        [("a,b", "c"), ("a", "b,c"), ("a", "c"), (None, "c"), ("z", "z")], "a string, b string"
    )
    delta = spark.createDataFrame([("a,b", "c"), ("a", None)], "a string, b string")
    log = spark.createDataFrame([("z,z",), (None,)], "id_column_value string")
    both = joins.anti_by_delta_and_log(target, delta, log, ["a", "b"])
    single = joins.anti_by_id_value(joins.anti_by_keys(target, delta, ["a", "b"]), log, ["a", "b"])
    assert rows(both) == rows(single) == [("a", "b,c"), ("a", "c"), (None, "c")]


def test_combined_anti_join_casts_delta_keys_to_the_target(spark):
    target = spark.range(1, 3).selectExpr("cast(id AS decimal(10,2)) AS k")
    delta = spark.createDataFrame([(1,)], "k int")
    left = joins.anti_by_delta_and_log(target, delta, None, ["k"]).collect()
    assert [int(r.k) for r in left] == [2]


def test_helper_columns_do_not_hide_table_columns(spark):
    target = spark.createDataFrame([(1, "x", 7)], "k int, _id string, _rank int")
    log = spark.createDataFrame([("2",)], "id_column_value string")
    out = ranking.latest_per_key(joins.anti_by_delta_and_log(target, target.limit(0), log, ["k"]), ["k"], "_rank")
    assert rows(out) == [(1, "x", 7)]


def test_delete_in_leaves_other_partitions_and_null_partitions(spark):
    target = spark.createDataFrame(
        [(1, 202401), (1, 202301), (1, None), (2, 202401)], "k int, partition_date int"
    )
    keys = spark.createDataFrame([("1",)], f"{joins.KEY_TEXT} string")
    left = joins.delete_in(target, keys, ["k"], 202312)
    assert rows(left) == [(1, 202301), (1, None), (2, 202401)]


def test_latest_by_join_keeps_ties(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 5), ("a", 3, 4), ("b", 4, 1)], "g string, id int, t int")
    assert rows(joins.latest_by_join(df, ["g"], "t"), "id") == [(1,), (2,), (4,)]


def test_relation_pairs():
    bare, a, b = TaskConfig(), TaskConfig(relation_columns=("a",)), TaskConfig(relation_columns=("x", "y"))
    assert joins.relation_pairs(bare, bare) == [("bill_no", "bill_no")]
    assert joins.relation_pairs(bare, a) == [("a", "a")]
    assert joins.relation_pairs(b, bare) == [("x", "x"), ("y", "y")]
    assert joins.relation_pairs(b, a) == [("x", "a")]


def test_latest_per_key_breaks_ties_the_same_way_every_time(spark):
    df = spark.createDataFrame(
        [(1, 10, "b"), (1, 10, "a"), (1, 9, "z"), (2, None, "n"), (2, 1, "o")], "k int, t int, v string"
    )
    assert rows(ranking.latest_per_key(df, ["k"], "t")) == [(1, 10, "a"), (2, 1, "o")]
    assert rows(ranking.nth_latest(df, ["k"], "t", 3)) == [(1, 9, "z")]
    shuffled = df.repartition(5).orderBy(F.rand(3))
    assert rows(ranking.latest_per_key(shuffled, ["k"], "t")) == [(1, 10, "a"), (2, 1, "o")]


RUN = (
    "id int, scheduler_name string, group_name string, task_status string, "
    "create_time timestamp_ntz, sync_end_time timestamp_ntz"
)


def _run(i, task, end, status="FINISHED", group="g_hive"):
    return i, task, group, status, end, end


def test_run_window_defaults(spark):
    log = spark.createDataFrame([_run(1, "t", datetime(2024, 1, 1))], RUN)
    only = ranking.run_window(log, "t").first()
    assert (only.latest_end, only.previous_end) == (datetime(2024, 1, 1), datetime(1970, 1, 1, 8))
    never = ranking.run_window(log, "other").first()
    assert (never.latest_end, never.previous_end) == (datetime(2099, 1, 1), datetime(1970, 1, 1, 8))


def test_dependency_that_is_the_task_itself_gives_one_row(spark):
    log = spark.createDataFrame([_run(1, "t", datetime(2024, 1, 1)), _run(2, "t", datetime(2024, 1, 2))], RUN)
    same = setops.latest_with_dependency(log, ("t", "g_hive"), ("t", "g_hive"), "FINISHED", datetime(2023, 1, 1))
    assert rows(same, "id") == [(2,)]
    none = setops.latest_with_dependency(log, ("t", "g_hive"), None, "FINISHED", datetime(2023, 1, 1))
    assert rows(none, "id") == [(2,)]


def test_union_fills_absent_columns(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([(2,)], "k int")
    assert rows(setops.union_all(a, b)) == [(1, "x"), (2, None)]


def test_whole_number_keys_are_matched_as_numbers(spark):
    """Texts that only look like the number match nothing, as they would not as text."""
    odd = ["1", "02", " 3", "+4", "5.0", "x", None, "-6", "9223372036854775808"]
    log = spark.createDataFrame([(t,) for t in odd], "id_column_value string")
    for kind in ("int", "bigint", "smallint", "string"):
        target = spark.createDataFrame([(k,) for k in (1, 2, 3, 4, 5, -6, None)], "n int").select(F.col("n").cast(kind).alias("k"))
        kept = [r["k"] for r in joins.anti_by_id_value(target, log, ["k"]).collect()]
        assert sorted(map(str, kept)) == ["2", "3", "4", "5", "None"]
        both = joins.anti_by_delta_and_log(target, target.where("k in (2, 3)"), log, ["k"])
        assert sorted(str(r["k"]) for r in both.collect()) == ["4", "5", "None"]
        gone = joins.delete_exists(target, log, "k", keep_deleted=True)
        assert sorted(str(r["k"]) for r in gone.collect()) == ["-6", "1"]
    plan = joins.anti_by_id_value(target.select(F.col("k").cast("int")), log, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert "cast(k" in plan and "bigint" in plan
