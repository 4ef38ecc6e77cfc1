"""Counts, checks and run-log reports: the A rows of the survey."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidekeep import TaskConfig
from tidekeep.functions.dates import day_text
from tidekeep.operators import aggregates as a
from tidekeep.operators.joins import merge_counts
from tidekeep.plans import verify
from tidekeep.sources.extract import boundaries

from .feeds import counted_source, counted_target, lines, ods, pending, runs, table, thl, with_feeds
from .registry import query

AS_OF = datetime(2024, 1, 31, 10)
RUN_DAY = datetime(2024, 1, 20, 18, 30)

SOURCE_DAYS = """SELECT group_name, task_name, strftime(update_time, '%Y-%m-%d') AS syn_date, count(*) AS source_count
    FROM counted_source WHERE update_time >= TIMESTAMP '2024-01-10 00:00:00' AND update_time <= TIMESTAMP '2024-01-30 23:59:59'
    GROUP BY ALL"""
TARGET_DAYS = """SELECT group_name, task_name, partition_date, count(*) AS target_count FROM counted_target
    WHERE partition_date BETWEEN 20240110 AND 20240130 GROUP BY ALL"""
MERGED = f"""s AS ({SOURCE_DAYS}), t AS (SELECT group_name, task_name,
        strftime(strptime(CAST(partition_date AS VARCHAR), '%Y%m%d'), '%Y-%m-%d') AS syn_date, target_count FROM ({TARGET_DAYS})),
    merged AS (SELECT group_name, task_name, syn_date, coalesce(source_count, 0) AS source_count,
        coalesce(target_count, 0) AS target_count, coalesce(target_count, 0) - coalesce(source_count, 0) AS diff
        FROM s FULL JOIN t USING (group_name, task_name, syn_date))"""
CHECKED = """stats AS (SELECT group_name, task_name, count(*) AS n, CAST(sum(diff) AS DOUBLE) / {days} AS mean
        FROM merged GROUP BY ALL),
    limits AS (SELECT group_name, task_name, any_value(mean) AS mean,
        sqrt((sum((diff - mean) ^ 2) + greatest({days} - any_value(n), 0) * any_value(mean) ^ 2) / {days}) AS sd
        FROM merged JOIN stats USING (group_name, task_name) GROUP BY ALL),
    checked AS (SELECT merged.*, printf('[%.2f , %.2f]', mean - {factor} * sd, mean + {factor} * sd) AS threshold,
        CASE WHEN diff BETWEEN mean - {factor} * sd AND mean + {factor} * sd THEN 0 ELSE 1 END AS flag
        FROM merged JOIN limits USING (group_name, task_name))"""


def checked_sql(days: int, factor: float) -> str:
    return CHECKED.format(days=days, factor=factor)


@query("a1_daily_counts", with_feeds("counted_source") + SOURCE_DAYS)
def a1(spark, sf_dir):
    return a.daily_counts(counted_source(spark, sf_dir), "update_time", AS_OF, 20, 1, ["group_name", "task_name"])


@query(
    "a2_daily_counts_union",
    """SELECT strftime(moment, '%Y-%m-%d') AS syn_date, count(*) AS source_count FROM (
        SELECT o_orderdate AS moment FROM orders UNION ALL SELECT l_shipdate FROM lineitem WHERE l_returnflag <> 'N')
    WHERE moment >= TIMESTAMP '1999-12-20' AND moment <= TIMESTAMP '2000-12-18 23:59:59' GROUP BY 1""",
)
def a2(spark, sf_dir):
    live = table(spark, sf_dir, "orders").selectExpr("o_orderdate as moment")
    moved = table(spark, sf_dir, "lineitem").where("l_returnflag <> 'N'").selectExpr("l_shipdate as moment")
    return a.daily_counts_union(live, moved, "moment", datetime(2000, 12, 20, 5), 364, 2)


@query("a3_partition_counts", with_feeds("counted_target") + TARGET_DAYS)
def a3(spark, sf_dir):
    return a.partition_counts(counted_target(spark, sf_dir), 20240110, 20240130, ["group_name", "task_name"])


@query(
    "a4_sigma_check",
    with_feeds("counted_source", "counted_target") + f", {MERGED}, {checked_sql(20, 1.5)} SELECT * FROM checked",
)
def a4(spark, sf_dir):
    by = ["group_name", "task_name"]
    theirs = a3(spark, sf_dir).select(*by, day_text(F.col("partition_date")).alias("syn_date"), "target_count")
    return a.sigma_check(merge_counts(a1(spark, sf_dir), theirs, [*by, "syn_date"]), by, 20, 1.5)


@query(
    "a5_duplicate_keys",
    with_feeds("lines")
    + """SELECT 'order_key,line_no' AS primary_key, '[order_key=' || order_key || '][line_no=' || line_no || ']' AS primary_value,
        count(*) AS occurrences FROM lines WHERE partition_date >= 20000801 GROUP BY order_key, line_no HAVING count(*) > 1""",
)
def a5(spark, sf_dir):
    since = a.duplicates_since(datetime(2001, 8, 1))
    return a.duplicate_keys(lines(spark, sf_dir), ["order_key", "line_no"], since)


@query(
    "a6_reconcile_counts",
    """WITH c AS (
        SELECT 'retail' AS group_name, 'customer' AS task_name,
            (SELECT count(*) FROM customer WHERE c_acctbal > 0) AS source_count, (SELECT count(*) FROM customer) AS target_count
        UNION ALL SELECT 'retail', 'orders',
            (SELECT count(*) FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1999-01-01'),
            (SELECT count(*) FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1999-01-01')
        UNION ALL SELECT 'retail', 'lineitem',
            (SELECT count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey
                WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1999-01-01'),
            (SELECT count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag <> 'R'
                AND o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1999-01-01'))
    SELECT * FROM c WHERE source_count <> target_count""",
)
def a6(spark, sf_dir):
    customer, orders, lineitem = (table(spark, sf_dir, n) for n in ("customer", "orders", "lineitem"))
    tasks = [
        verify.CountedTask(
            TaskConfig(group="retail", trigger="customer", full_load=True, filters=("and c_acctbal > 0",)),
            customer,
            customer,
        ),
        verify.CountedTask(TaskConfig(group="retail", trigger="orders"), orders, orders, "o_orderdate"),
        verify.CountedTask(
            TaskConfig(group="retail", trigger="lineitem"),
            lineitem,
            lineitem.where("l_returnflag <> 'R'"),
            "o_orderdate",
            orders,
            orders,
            (("l_orderkey", "o_orderkey"),),
        ),
    ]
    return verify.reconcile_counts(tasks, datetime(1998, 1, 1), datetime(1999, 1, 1))


TODAY = "create_time >= TIMESTAMP '2024-01-20' AND create_time <= TIMESTAMP '2024-01-20 18:30:00'"
FAILED = f"""SELECT DISTINCT c.group_name, c.scheduler_name FROM runs c JOIN (SELECT group_name, scheduler_name,
        max(create_time) AS create_time FROM runs WHERE {TODAY} GROUP BY ALL) b USING (group_name, scheduler_name, create_time)
    WHERE c.task_status = 'INTERRUPTED' AND {TODAY.replace('create_time', 'c.create_time')}"""


@query(
    "a7_run_summary",
    with_feeds("runs")
    + f"""SELECT count(DISTINCT CASE WHEN group_name NOT LIKE '%hive' AND group_name NOT LIKE 'dc_common'
            AND scheduler_name NOT LIKE '%cln' THEN scheduler_name || group_name END) AS import_success,
        count(DISTINCT CASE WHEN group_name NOT LIKE '%hive' AND scheduler_name LIKE '%cln'
            THEN scheduler_name || group_name END) AS remove_success,
        count(DISTINCT CASE WHEN group_name LIKE '%hive' AND scheduler_name NOT LIKE '%cln'
            THEN scheduler_name || group_name END) AS export_success,
        (SELECT count(*) FROM ({FAILED})) AS exception_count
    FROM runs WHERE {TODAY} AND task_status = 'FINISHED'""",
)
def a7(spark, sf_dir):
    return a.run_summary(runs(spark, sf_dir), RUN_DAY)


@query("a8_latest_failures", with_feeds("runs") + FAILED)
def a8(spark, sf_dir):
    return a.latest_failures(runs(spark, sf_dir), RUN_DAY)


@query("a9_max_seq", with_feeds("thl") + "SELECT max(seq_no) AS max_seq_no FROM thl WHERE dml_type = 0")
def a9(spark, sf_dir):
    return a.max_seq(thl(spark, sf_dir))


@query(
    "a10_pending_delete_ranges",
    with_feeds("thl", "pending")
    + """SELECT table_name, min(yw_update_time) AS min_time, max(yw_update_time) AS max_time FROM pending
    WHERE process_status = 0 GROUP BY table_name""",
)
def a10(spark, sf_dir):
    return a.pending_delete_ranges(pending(spark, sf_dir))


@query("a11_boundaries", "SELECT min(l_shipdate) AS lo, max(l_shipdate) AS hi FROM lineitem")
def a11(spark, sf_dir):
    return boundaries(table(spark, sf_dir, "lineitem"), "l_shipdate")


@query(
    "a12_final_status",
    with_feeds("runs")
    + """SELECT row_number() OVER (ORDER BY group_name, scheduler_name) AS id,
        group_name || '_' || scheduler_name || '_ods' AS target_table, 1 AS status, max(sync_end_time) AS sync_end_time,
        max(create_time) AS create_time, '2024-01-20 18:30:00' AS refresh_time
    FROM runs WHERE group_name LIKE '%_hive' AND task_status = 'FINISHED' AND create_time > TIMESTAMP '2024-01-20'
        AND create_time <= TIMESTAMP '2024-01-20 18:30:00' GROUP BY group_name, scheduler_name""",
)
def a12(spark, sf_dir):
    log = runs(spark, sf_dir)
    name = F.concat("group_name", F.lit("_"), "scheduler_name", F.lit("_ods")).alias("target_table")
    targets = log.select("scheduler_name", "group_name", name).distinct()
    return a.final_status(log, targets, RUN_DAY)


@query(
    "a13_daily_profile",
    """SELECT strftime(l_shipdate, '%Y-%m-%d') AS day, count(*) AS rows FROM lineitem
    WHERE epoch(TIMESTAMP '2001-06-01') - floor(epoch(l_shipdate)) <= 15768000 GROUP BY 1""",
)
def a13(spark, sf_dir):
    return a.daily_profile(table(spark, sf_dir, "lineitem"), "l_shipdate", datetime(2001, 6, 1))


@query(
    "a14_recent_finished",
    with_feeds("runs")
    + """SELECT count(*) AS finished_runs FROM runs WHERE DATE '2024-01-20' - INTERVAL 2 DAY < CAST(create_time AS DATE)
        AND task_id = '8' AND task_status = 'FINISHED'""",
)
def a14(spark, sf_dir):
    return a.recent_finished(runs(spark, sf_dir), "8", RUN_DAY)


@query(
    "a15_uniqueness",
    "SELECT count(*) AS total_rows, count(DISTINCT l_orderkey) AS distinct_keys FROM lineitem",
)
def a15(spark, sf_dir):
    return a.uniqueness(table(spark, sf_dir, "lineitem"), "l_orderkey")


@query("a16_distinct_of", with_feeds("ods") + "SELECT DISTINCT status, partition_date FROM ods")
def a16(spark, sf_dir):
    return a.distinct_of(ods(spark, sf_dir), ["status", "partition_date"])
