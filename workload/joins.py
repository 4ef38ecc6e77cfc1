"""Joins, ranked picks and set operations: the J, N, T and U rows of the survey."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidekeep import TaskConfig
from tidekeep.operators import joins, ranking, setops
from tidekeep.sources.scans import read_partitions

from .feeds import landing, line_log, lines, ods, pending, runs, table, thl, with_feeds
from .registry import query

QUARTER = (19980101, 19980331)


@query(
    "j1_anti_by_keys",
    with_feeds("ods", "landing")
    + """SELECT * FROM ods t WHERE NOT EXISTS (SELECT 1 FROM landing d
        WHERE d.partition_date BETWEEN 19980101 AND 19980331 AND d.order_key = t.order_key)""",
)
def j1(spark, sf_dir):
    return joins.anti_by_keys(ods(spark, sf_dir), read_partitions(landing(spark, sf_dir), *QUARTER), ["order_key"])


@query(
    "j2_anti_by_id_value",
    with_feeds("lines", "line_log")
    + """SELECT * FROM lines t WHERE NOT EXISTS (SELECT 1 FROM line_log p WHERE p.partition_date
        BETWEEN 19980101 AND 19991231 AND p.id_column_value = concat(t.order_key, ',', t.line_no))""",
)
def j2(spark, sf_dir):
    log = read_partitions(line_log(spark, sf_dir), 19980101, 19991231)
    return joins.anti_by_id_value(lines(spark, sf_dir), log, ["order_key", "line_no"])


@query(
    "j3_delete_in",
    with_feeds("ods", "landing", "thl")
    + """SELECT * FROM ods t WHERE NOT (partition_date >= 199701 AND partition_date <= 199912
        AND CAST(order_key AS VARCHAR) IN (
            SELECT CAST(order_key AS VARCHAR) FROM landing WHERE partition_date BETWEEN 19980101 AND 19980331
            UNION ALL SELECT id_column_value FROM thl WHERE partition_date BETWEEN 19980101 AND 19980331))""",
)
def j3(spark, sf_dir):
    delta = read_partitions(landing(spark, sf_dir), *QUARTER)
    log = read_partitions(thl(spark, sf_dir), *QUARTER)
    keys = joins.key_texts(delta, ["order_key"]).union(joins.id_values(log))
    return joins.delete_in(ods(spark, sf_dir), keys, ["order_key"], 199701, 199912)


@query(
    "j4_delta_minus_deletes",
    with_feeds("landing", "thl")
    + """SELECT * FROM landing d WHERE NOT EXISTS (SELECT 1 FROM thl p WHERE p.seq_no
        BETWEEN epoch(TIMESTAMP '1998-01-01') AND epoch(TIMESTAMP '2000-01-01')
        AND p.id_column_value = CAST(d.order_key AS VARCHAR))""",
)
def j4(spark, sf_dir):
    return joins.delta_minus_deletes(
        landing(spark, sf_dir), thl(spark, sf_dir), ["order_key"], 883612800, 946684800
    )


@query(
    "j5_master_detail_join",
    """SELECT l_orderkey, l_linenumber, l_quantity, o_custkey, o_orderdate FROM lineitem JOIN orders
        ON l_orderkey = o_orderkey WHERE o_orderdate >= TIMESTAMP '1997-06-01' AND o_orderdate < TIMESTAMP '1999-06-01'""",
)
def j5(spark, sf_dir):
    detail, master = TaskConfig(relation_columns=("l_orderkey",)), TaskConfig(relation_columns=("o_orderkey",))
    joined = joins.master_detail_join(
        table(spark, sf_dir, "lineitem"),
        table(spark, sf_dir, "orders"),
        joins.relation_pairs(detail, master),
        "o_orderdate",
        datetime(1997, 6, 1),
        datetime(1999, 6, 1),
    )
    return joined.select("l_orderkey", "l_linenumber", "l_quantity", "o_custkey", "o_orderdate")


@query(
    "j6_latest_by_join",
    """SELECT l.l_suppkey, l.l_orderkey, l.l_linenumber, l.l_shipdate FROM lineitem l JOIN
        (SELECT l_suppkey, max(l_shipdate) AS newest FROM lineitem GROUP BY l_suppkey) m
        ON l.l_suppkey = m.l_suppkey AND l.l_shipdate = m.newest""",
)
def j6(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_shipdate")
    return joins.latest_by_join(rows, ["l_suppkey"], "l_shipdate")


@query(
    "j7_merge_counts",
    """WITH s AS (SELECT strftime(o_orderdate, '%Y-%m-%d') AS syn_date, count(*) AS source_count FROM orders GROUP BY 1),
    t AS (SELECT strftime(l_shipdate, '%Y-%m-%d') AS syn_date, count(*) AS target_count FROM lineitem GROUP BY 1)
    SELECT coalesce(s.syn_date, t.syn_date) AS syn_date, coalesce(source_count, 0) AS source_count,
           coalesce(target_count, 0) AS target_count FROM s FULL JOIN t ON s.syn_date = t.syn_date""",
)
def j7(spark, sf_dir):
    def per_day(name, column, count):
        day = F.date_format(column, "yyyy-MM-dd").alias("syn_date")
        return table(spark, sf_dir, name).groupBy(day).agg(F.count(F.lit(1)).alias(count))

    source = per_day("orders", "o_orderdate", "source_count")
    return joins.merge_counts(source, per_day("lineitem", "l_shipdate", "target_count"), ["syn_date"])


PENDING_MATCH = """(SELECT 1 FROM pending p WHERE p.table_name = 'orders' AND p.process_status = 0
        AND p.yw_update_time >= TIMESTAMP '1998-01-01' AND p.yw_update_time <= TIMESTAMP '1998-12-31'
        AND p.id_column_value = CAST(t.order_key AS VARCHAR))"""


@query(
    "j8_delete_exists",
    with_feeds("ods", "thl", "pending")
    + f"""SELECT order_key, 'kept' AS fate FROM ods t WHERE NOT EXISTS {PENDING_MATCH}
    UNION ALL SELECT order_key, 'deleted' AS fate FROM ods t WHERE EXISTS {PENDING_MATCH}""",
)
def j8(spark, sf_dir):
    log = joins.logged_deletes(
        pending(spark, sf_dir), "orders", "yw_update_time", datetime(1998, 1, 1), datetime(1998, 12, 31)
    )
    rows = ods(spark, sf_dir).select("order_key")
    kept = joins.delete_exists(rows, log, "order_key").withColumn("fate", F.lit("kept"))
    gone = joins.delete_exists(rows, log, "order_key", keep_deleted=True).withColumn("fate", F.lit("deleted"))
    return kept.unionByName(gone)


@query(
    "j9_rebuild_without",
    with_feeds("ods", "thl")
    + """SELECT * FROM ods t WHERE NOT EXISTS (SELECT 1 FROM thl p WHERE p.table_name = 'orders'
        AND p.partition_date BETWEEN 19960101 AND 19961231 AND p.id_column_value = CAST(t.order_key AS VARCHAR))""",
)
def j9(spark, sf_dir):
    return joins.rebuild_without(ods(spark, sf_dir), thl(spark, sf_dir), "order_key", "orders", 19960101, 19961231)


@query(
    "j10_enrich",
    """SELECT c_custkey, c_acctbal, n_name, n_regionkey FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
)
def j10(spark, sf_dir):
    nations = table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    rows = joins.enrich(table(spark, sf_dir, "customer"), nations, ["c_nationkey"])
    return rows.select("c_custkey", "c_acctbal", "n_name", "n_regionkey")


NEWEST_LANDED = """ORDER BY update_time DESC NULLS LAST, party_key NULLS LAST, status NULLS LAST,
        amount NULLS LAST, partition_date NULLS LAST"""


@query(
    "n1_latest_per_key",
    with_feeds("landing")
    + f"""SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY order_key {NEWEST_LANDED}) AS rn
        FROM landing) WHERE rn = 1""",
)
def n1(spark, sf_dir):
    return ranking.latest_per_key(landing(spark, sf_dir), ["order_key"], "update_time")


@query(
    "n2_nth_latest",
    with_feeds("landing")
    + f"""SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY order_key {NEWEST_LANDED}) AS rn
        FROM landing) WHERE rn = 2""",
)
def n2(spark, sf_dir):
    return ranking.nth_latest(landing(spark, sf_dir), ["order_key"], "update_time", 2)


ONE_TASK = "scheduler_name = 'u8_src' AND group_name = 'crm_hive' AND task_status = 'FINISHED'"


@query(
    "t1_latest_run",
    with_feeds("runs")
    + f"""SELECT * FROM runs WHERE {ONE_TASK} AND create_time > TIMESTAMP '2024-01-02'
        ORDER BY sync_end_time DESC, id LIMIT 1""",
)
def t1(spark, sf_dir):
    return ranking.latest_run(runs(spark, sf_dir), "u8_src", "crm_hive", "FINISHED", datetime(2024, 1, 2))


@query(
    "t2_runs_since",
    with_feeds("runs")
    + f"SELECT * FROM runs WHERE {ONE_TASK} AND sync_end_time > TIMESTAMP '2024-01-10' ORDER BY sync_end_time, id",
)
def t2(spark, sf_dir):
    return ranking.runs_since(runs(spark, sf_dir), "u8_src", "crm_hive", "FINISHED", datetime(2024, 1, 10))


@query(
    "t3_run_window",
    with_feeds("runs")
    + """, e AS (SELECT sync_end_time FROM runs WHERE scheduler_name = 'u8_src' AND group_name LIKE '%_hive'
        AND task_status = 'FINISHED')
    SELECT coalesce((SELECT sync_end_time FROM e ORDER BY sync_end_time DESC LIMIT 1 OFFSET 1),
               TIMESTAMP '1970-01-01 08:00:00') AS previous_end,
           coalesce((SELECT max(sync_end_time) FROM e), TIMESTAMP '2099-01-01') AS latest_end""",
)
def t3(spark, sf_dir):
    return ranking.run_window(runs(spark, sf_dir), "u8_src")


@query(
    "t4_top_k_per_group",
    """SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
        ORDER BY o_orderdate DESC NULLS LAST, o_orderkey NULLS LAST, o_totalprice NULLS LAST) AS rn FROM orders)
    WHERE rn <= 3""",
)
def t4(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return ranking.top_k_per_group(rows, ["o_custkey"], "o_orderdate", 3)


@query(
    "u1_union_all",
    """SELECT o_orderkey AS key, o_orderdate AS at, o_orderstatus AS status FROM orders
    UNION ALL SELECT l_orderkey, l_shipdate, NULL FROM lineitem""",
)
def u1(spark, sf_dir):
    live = table(spark, sf_dir, "orders")
    live = live.selectExpr("o_orderkey as key", "o_orderdate as at", "o_orderstatus as status")
    moved = table(spark, sf_dir, "lineitem").selectExpr("l_shipdate as at", "l_orderkey as key")
    return setops.union_all(live, moved)


@query(
    "u2_latest_with_dependency",
    with_feeds("runs")
    + f"""SELECT * FROM (SELECT * FROM runs WHERE {ONE_TASK} AND create_time > TIMESTAMP '2024-01-02'
        ORDER BY sync_end_time DESC, id LIMIT 1)
    UNION SELECT * FROM (SELECT * FROM runs WHERE {ONE_TASK.replace('u8_src', 'u8_cln')}
        AND create_time > TIMESTAMP '2024-01-02' ORDER BY sync_end_time DESC, id LIMIT 1)""",
)
def u2(spark, sf_dir):
    return setops.latest_with_dependency(
        runs(spark, sf_dir), ("u8_src", "crm_hive"), ("u8_cln", "crm_hive"), "FINISHED", datetime(2024, 1, 2)
    )


@query(
    "u3_untouched",
    """SELECT c_custkey, 0 AS backfill_day FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders
        WHERE o_orderdate >= TIMESTAMP '2000-06-01')""",
)
def u3(spark, sf_dir):
    touched = table(spark, sf_dir, "orders").where("o_orderdate >= timestamp_ntz'2000-06-01'")
    touched = touched.select(F.col("o_custkey").alias("c_custkey"))
    return setops.untouched(table(spark, sf_dir, "customer"), touched, ["c_custkey"])
