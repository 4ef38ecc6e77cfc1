"""One key holding a third of the rows: results stay whole, and no task gets the whole key."""

import pytest
from pyspark.sql import functions as F

from tidekeep.operators import joins, ranking
from tidekeep.session import scratch_path
from tidekeep.sinks.files import FileTree
from tidekeep.sinks.tables import append_partitions
from tidekeep.sources.scans import read_table

HOT = 60_000


def executed(df):
    """The plan as adaptive execution finally ran it."""
    query = df._jdf.queryExecution()
    query.toRdd().count()
    return query.executedPlan().toString().partition("Initial Plan")[0]


def split_join(plan):
    """Whether adaptive execution split an oversized partition of the join's table side."""
    return "Join(skew=true)" in plan and "skewed" in plan


@pytest.fixture
def small_partitions(conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="100k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="100k",
    )


def skewed(spark, n=3 * HOT):
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
    payload = F.sha2(F.col("id").cast("string"), 256).alias("v")
    return spark.range(0, n, 1, 16).select(key.cast("int").alias("k"), "id", payload)


@pytest.mark.parametrize("hot_deleted", [True, False])
def test_anti_join_splits_a_hot_target_key(spark, small_partitions, hot_deleted):
    target = skewed(spark)
    gone = spark.range(0, HOT, 1, 8).select((F.col("id") * 3 + 1).cast("int").alias("k"))
    hot = spark.range(0, HOT, 1, 8).select(F.lit(0 if hot_deleted else -1).alias("k"))
    kept = joins.anti_by_keys(target, gone.union(hot), ["k"])
    expected = 3 * HOT - HOT - (HOT if hot_deleted else 0)
    assert kept.count() == expected
    assert split_join(executed(kept))


def test_semi_join_splits_a_hot_group_of_ties(spark, small_partitions):
    rows = skewed(spark).withColumn("t", F.when(F.col("k") == 0, 7).otherwise(F.col("id")))
    newest = joins.latest_by_join(rows, ["k"], "t")
    assert newest.count() == 3 * HOT
    assert split_join(executed(newest))


def test_hot_keys_are_thinned_before_the_shuffle(spark):
    ranked = ranking.latest_per_key(skewed(spark), ["k"], "id")._jdf.queryExecution().toString()
    assert "row_number(), 1, Partial" in ranked
    second = ranking.nth_latest(skewed(spark), ["k"], "id", 2)._jdf.queryExecution().toString()
    assert "row_number(), 2, Partial" in second
    keys = joins.distinct_keys(skewed(spark).where("k = 0"), "k")
    assert keys.count() <= joins.SPREAD


def test_marks_are_not_broadcast_without_a_size_check(spark, small_partitions):
    target = skewed(spark)
    log = spark.range(10).select(F.col("id").cast("string").alias("id_column_value"))
    plan = executed(joins.anti_by_delta_and_log(target, target.where("k > 100"), log, ["k"]))
    assert "Broadcast" not in plan


def test_small_marks_are_broadcast_once_measured(spark):
    target = skewed(spark)
    log = spark.range(10).select(F.col("id").cast("string").alias("id_column_value"))
    plan = executed(joins.anti_by_id_value(target, log, ["k"]))
    assert "BroadcastHashJoin" in plan


def test_an_oversized_partition_is_written_by_several_tasks(spark, conf):
    conf(spark__sql__adaptive__advisoryPartitionSizeInBytes="200k")
    rows = skewed(spark).select("id", "v", (F.col("k") == 0).cast("int").alias("partition_date"))
    path = scratch_path(spark, "split")
    append_partitions(rows, path)
    files = [n for n in FileTree(spark).names(f"{path}/partition_date=0") if n.endswith(".parquet")]
    assert len(files) > 1
    assert read_table(spark, path).count() == 3 * HOT


def test_partition_range_prunes_directories(spark):
    path = scratch_path(spark, "prune")
    append_partitions(spark.createDataFrame([(1, 202401), (2, 202402)], "v int, partition_date int"), path)
    rows = read_table(spark, path).where(F.col("partition_date").between(202402, 202403))
    plan = rows._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(partition_date" in plan and rows.count() == 1
