"""Reading and writing: the R and W rows of the survey."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidekeep import TaskConfig
from tidekeep.config import day_of
from tidekeep.functions.dates import day_int
from tidekeep.functions.types import apply_type_overrides
from tidekeep.session import scratch_path
from tidekeep.sinks import tables as sink
from tidekeep.sources import extract, scans
from tidekeep.plans import export, repair, verify

from .feeds import counted_source, ods, ods_daily, runs, table, thl, with_feeds
from .registry import query

DAY = datetime(2024, 1, 10)
NEXT_DAY = datetime(2024, 1, 11)

ORDERS = TaskConfig(
    select_columns=("o_orderkey as order_key", "o_orderstatus as status", "o_totalprice as amount"),
    filters=("and o_orderstatus not in ('P')", "o_totalprice > 1000"),
)
EVENTS = TaskConfig(
    select_columns=("event_id", "event_type", "ts", "value"), sync_time_column="ts", filters=("value > 5",)
)


@query(
    "r1_extract_full",
    """SELECT o_orderkey AS order_key, o_orderstatus AS status, o_totalprice AS amount
    FROM orders WHERE o_orderstatus NOT IN ('P') AND o_totalprice > 1000""",
)
def r1(spark, sf_dir):
    return extract.extract_full(table(spark, sf_dir, "orders"), ORDERS)


@query(
    "r2_extract_incremental",
    """SELECT event_id, event_type, ts, value FROM events
    WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-11' AND value > 5""",
)
def r2(spark, sf_dir):
    return extract.extract_incremental(table(spark, sf_dir, "events"), EVENTS, DAY, NEXT_DAY)


@query(
    "r3_extract_text_time",
    """SELECT event_id, biz_day, value FROM (SELECT *, strftime(ts, '%Y%m%d') AS biz_day FROM events)
    WHERE biz_day >= '20240110' AND biz_day < '20240111'""",
)
def r3(spark, sf_dir):
    src = table(spark, sf_dir, "events").withColumn("biz_day", F.date_format("ts", "yyyyMMdd"))
    cfg = TaskConfig(select_columns=("event_id", "biz_day", "value"), sync_time_column="biz_day", time_type="str")
    return extract.extract_incremental(src, cfg, datetime(2024, 1, 10, 3), datetime(2024, 1, 10, 9))


@query(
    "r4_validate_window",
    with_feeds("runs")
    + """SELECT sync_end_time > sync_begin_time AND sync_end_time <= sync_begin_time + INTERVAL 1 DAY AS valid,
           count(*) AS runs
    FROM (SELECT sync_begin_time, CASE group_name WHEN 'dc_common' THEN sync_begin_time
            WHEN 'etl_kettle' THEN sync_end_time + INTERVAL 1 DAY ELSE sync_end_time END AS sync_end_time FROM runs)
    GROUP BY 1""",
)
def r4(spark, sf_dir):
    end = F.when(F.col("group_name") == "dc_common", F.col("sync_begin_time"))
    end = end.when(F.col("group_name") == "etl_kettle", F.col("sync_end_time") + F.expr("interval 1 day"))
    windows = runs(spark, sf_dir).withColumn("sync_end_time", end.otherwise(F.col("sync_end_time")))
    valid = extract.valid_window(F.col("sync_begin_time"), F.col("sync_end_time")).alias("valid")
    return windows.groupBy(valid).agg(F.count(F.lit(1)).alias("runs"))


@query(
    "r5_extract_partitioned",
    """WITH w AS (SELECT event_id, epoch_us(ts) AS micros FROM events
        WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-25'),
    b AS (SELECT min(micros) AS lo, max(micros) AS hi FROM w)
    SELECT event_id, least(CAST(floor(CAST(micros - lo AS DOUBLE) * 4 / CAST(hi - lo AS DOUBLE)) AS INTEGER), 3) AS slice_no
    FROM w, b""",
)
def r5(spark, sf_dir):
    cfg = TaskConfig(select_columns=("event_id",), sync_time_column="ts")
    return extract.extract_partitioned(
        table(spark, sf_dir, "events"), cfg, datetime(2024, 1, 5), datetime(2024, 1, 25), 4
    )


@query(
    "r5_extract_partitioned_text",
    """WITH w AS (SELECT event_id, strftime(ts, '%Y%m%d') AS day FROM events
        WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-25'),
    n AS (SELECT event_id, datediff('day', DATE '1970-01-01', strptime(day, '%Y%m%d')::DATE) AS d FROM w),
    b AS (SELECT min(d) AS lo, max(d) AS hi FROM n)
    SELECT event_id, least(CAST(floor(CAST(d - lo AS DOUBLE) * 4 / CAST(hi - lo AS DOUBLE)) AS INTEGER), 3) AS slice_no
    FROM n, b""",
)
def r5_text(spark, sf_dir):
    """The time column as yyyyMMdd text: slices are cut between days."""
    events = table(spark, sf_dir, "events").select("event_id", F.date_format("ts", "yyyyMMdd").alias("day"))
    cfg = TaskConfig(select_columns=("event_id",), sync_time_column="day", time_type="str")
    return extract.extract_partitioned(events, cfg, datetime(2024, 1, 5), datetime(2024, 1, 25), 4)


@query(
    "r6_extract_with_history",
    """SELECT event_id, event_type, ts, value FROM events WHERE ts >= TIMESTAMP '2024-01-10'
        AND ts < TIMESTAMP '2024-01-11' AND event_type <> 'error' AND value > 5
    UNION ALL
    SELECT event_id, 'history' AS event_type, ts, value FROM events WHERE ts >= TIMESTAMP '2024-01-10'
        AND ts < TIMESTAMP '2024-01-11' AND event_type = 'error'""",
)
def r6(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    cfg = TaskConfig(
        select_columns=EVENTS.select_columns,
        history_columns=("event_id", "'history' as event_type", "ts", "value"),
        sync_time_column="ts",
        filters=EVENTS.filters,
    )
    live, history = events.where("event_type <> 'error'"), events.where("event_type = 'error'")
    return extract.extract_with_history(live, history, cfg, {20240110}, DAY, NEXT_DAY)


@query(
    "r7_apply_type_overrides",
    """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, CAST(c_nationkey AS BIGINT) AS c_nationkey,
           CAST(CAST(c_acctbal AS DECIMAL(17,4)) AS VARCHAR) AS c_acctbal,
           TRY_CAST(c_mktsegment AS INTEGER) AS c_mktsegment
    FROM customer""",
)
def r7(spark, sf_dir):
    df = table(spark, sf_dir, "customer").drop("c_name")
    kinds = {"c_custkey": "string", "c_nationkey": "bigint", "c_acctbal": "decimal(17,4)", "c_mktsegment": "int"}
    return apply_type_overrides(df, kinds).withColumn("c_acctbal", F.col("c_acctbal").cast("string"))


@query(
    "r8_read_landing",
    """SELECT c_custkey, c_name, c_nationkey, c_acctbal, nullif(c_mktsegment, 'MACHINERY') AS c_mktsegment,
           CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE 'x' END AS note
    FROM customer""",
)
def r8(spark, sf_dir):
    df = table(spark, sf_dir, "customer")
    df = df.withColumn("note", F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise("x"))
    df = df.withColumn("c_mktsegment", F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY")))
    path = scratch_path(spark, "landing")
    sink.write_landing(df, path)
    return scans.read_landing(spark, path, df.schema)


@query("r9_read_table", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def r9(spark, sf_dir):
    path = scratch_path(spark, "orc")
    sink.write_full(table(spark, sf_dir, "supplier"), path, fmt="orc")
    return scans.read_table(spark, path, "orc")


@query(
    "r10_read_partitions",
    with_feeds("ods") + "SELECT * FROM ods WHERE partition_date BETWEEN 199803 AND 199908",
)
def r10(spark, sf_dir):
    path = scratch_path(spark, "ods")
    sink.append_partitions(ods(spark, sf_dir), path)
    return scans.read_partitions(scans.read_table(spark, path), 199803, 199908)


@query(
    "r11_read_partition_list",
    """SELECT event_id, ts, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS partition_date FROM events
    WHERE strftime(ts, '%Y%m%d') IN ('20240103', '20240104', '20240109')
      AND ts > TIMESTAMP '2024-01-03 06:00:00' AND ts < TIMESTAMP '2024-01-09 18:00:00'""",
)
def r11(spark, sf_dir):
    path = scratch_path(spark, "days")
    sink.append_partitions(_events_by_day(spark, sf_dir), path)
    return scans.read_partition_list(
        scans.read_table(spark, path),
        [20240103, 20240104, 20240109],
        "ts",
        datetime(2024, 1, 3, 6),
        datetime(2024, 1, 9, 18),
    ).select("event_id", "ts", "partition_date")


@query(
    "r12_run_query",
    """SELECT o_orderpriority, count(*) AS orders, max(o_totalprice) AS largest FROM orders
    WHERE o_orderdate >= TIMESTAMP '1997-01-01' GROUP BY o_orderpriority""",
)
def r12(spark, sf_dir):
    return scans.run_query(
        spark,
        "SELECT o_orderpriority, count(*) AS orders, max(o_totalprice) AS largest FROM {orders} "
        "WHERE o_orderdate >= cast(:since AS timestamp_ntz) GROUP BY o_orderpriority",
        {"since": "1997-01-01 00:00:00"},
        orders=table(spark, sf_dir, "orders"),
    )


def _events_by_day(spark, sf_dir):
    df = table(spark, sf_dir, "events").select("event_id", "event_type", "ts", "value")
    return df.withColumn("partition_date", day_int(F.col("ts")))


EVENT_DAYS = (
    "SELECT event_id, event_type, ts, value, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS partition_date FROM events"
)


@query(
    "w1_write_day",
    f"SELECT * FROM ({EVENT_DAYS}) WHERE partition_date <> 20240110 OR value > 5",
)
def w1(spark, sf_dir):
    path = scratch_path(spark, "day")
    sink.append_partitions(_events_by_day(spark, sf_dir), path)
    day = extract.extract_incremental(table(spark, sf_dir, "events"), EVENTS, DAY, NEXT_DAY)
    sink.write_day(day, path, day_of(DAY))
    sink.write_day(day, path, day_of(DAY))
    return scans.read_table(spark, path)


@query("w2_write_full", "SELECT * FROM orders WHERE o_orderstatus <> 'P'")
def w2(spark, sf_dir):
    path = scratch_path(spark, "full")
    orders = table(spark, sf_dir, "orders")
    sink.write_full(orders, path)
    sink.write_full(orders.where("o_orderstatus <> 'P'"), path)
    return scans.read_table(spark, path)


@query("w3_landing_to_parquet", "SELECT * FROM part")
def w3(spark, sf_dir):
    landed, columnar = scratch_path(spark, "text"), scratch_path(spark, "columnar")
    part = table(spark, sf_dir, "part")
    sink.write_landing(part, landed)
    sink.landing_to_parquet(spark, landed, columnar, part.schema)
    return scans.read_table(spark, columnar)


@query("w4_append_partitions", with_feeds("ods") + "SELECT * FROM ods WHERE status <> 'P'")
def w4(spark, sf_dir):
    path = scratch_path(spark, "append")
    rows = ods(spark, sf_dir)
    sink.append_partitions(rows.where("status = 'F'"), path)
    sink.append_partitions(rows.where("status = 'O'"), path)
    return scans.read_table(spark, path)


@query(
    "w5_overwrite_partitions",
    with_feeds("ods")
    + """SELECT * FROM ods WHERE status = 'O'
        OR (status = 'F' AND partition_date NOT IN (SELECT partition_date FROM ods WHERE status = 'O'))""",
)
def w5(spark, sf_dir):
    path = scratch_path(spark, "overwrite")
    rows = ods(spark, sf_dir)
    sink.append_partitions(rows.where("status = 'F'"), path)
    sink.overwrite_partitions(rows.where("status = 'O'"), path)
    return scans.read_table(spark, path)


@query(
    "w6_overwrite_month_range",
    with_feeds("ods")
    + """SELECT * FROM ods WHERE partition_date NOT BETWEEN 199711 AND 199806
        OR (partition_date BETWEEN 199801 AND 199803 AND status = 'O')""",
)
def w6(spark, sf_dir):
    path = scratch_path(spark, "months")
    rows = ods(spark, sf_dir)
    sink.append_partitions(rows, path)
    left = rows.where(F.col("partition_date").between(199801, 199803) & (F.col("status") == "O"))
    sink.overwrite_month_range(left, path, 199711, 199806)
    return scans.read_table(spark, path)


@query(
    "w7_drop_month_range",
    with_feeds("ods") + "SELECT * FROM ods WHERE partition_date NOT BETWEEN 199611 AND 199802",
)
def w7(spark, sf_dir):
    path = scratch_path(spark, "drop")
    sink.append_partitions(ods(spark, sf_dir), path)
    sink.drop_month_range(spark, path, 199611, 199802)
    return scans.read_table(spark, path)


@query("w8_export_rows", "SELECT * FROM customer WHERE c_acctbal > 0")
def w8(spark, sf_dir):
    path = scratch_path(spark, "export")
    customers = table(spark, sf_dir, "customer")
    sink.export_rows(customers, path)
    sink.export_rows(customers.where("c_acctbal > 0"), path, 5)
    return scans.read_landing(spark, path, customers.schema)


@query(
    "w9_export_snapshot",
    with_feeds("ods_daily")
    + """SELECT order_key, status, amount, partition_date FROM ods_daily
    WHERE ods_update_time <> '999999' AND partition_date BETWEEN 20000602 AND 20000712 AND status <> 'P'""",
)
def w9(spark, sf_dir):
    cfg = TaskConfig(
        select_columns=("order_key", "status", "amount", "partition_date"), filters=("and status <> 'P'",)
    )
    rows = export.export_snapshot(ods_daily(spark, sf_dir), cfg, datetime(2000, 7, 12, 4, 30))
    path = scratch_path(spark, "snapshot")
    sink.write_landing(rows, path)
    return scans.read_landing(spark, path, rows.schema)


@query(
    "w10_upsert",
    """SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus <> 'F'
        AND o_orderpriority <> '1-URGENT'
    UNION ALL SELECT o_orderkey, 'X' AS o_orderstatus, o_totalprice + 1 FROM orders WHERE o_orderpriority = '1-URGENT'""",
)
def w10(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    changes = rows.where(urgent).withColumns(
        {"o_orderstatus": F.lit("X"), "o_totalprice": F.col("o_totalprice") + 1}
    )
    return sink.upsert(
        rows.where("o_orderstatus <> 'F'").drop("o_orderpriority"), changes.drop("o_orderpriority"), ["o_orderkey"]
    )


@query(
    "w11_upsert_results",
    """WITH days AS (SELECT 'app' AS group_name, event_type AS task_name, strftime(ts, '%Y-%m-%d') AS syn_date,
            count(*) AS source_count FROM events GROUP BY ALL)
    SELECT group_name, task_name, syn_date, source_count, CASE WHEN syn_date >= '2024-01-15' THEN 'new' ELSE 'old' END AS run
    FROM days""",
)
def w11(spark, sf_dir):
    day = F.date_format("update_time", "yyyy-MM-dd").alias("syn_date")
    days = counted_source(spark, sf_dir).groupBy("group_name", "task_name", day)
    days = days.agg(F.count(F.lit(1)).alias("source_count"))
    path = scratch_path(spark, "results")
    sink.write_full(days.withColumn("run", F.lit("old")), path)
    found = days.where("syn_date >= '2024-01-15'").withColumn("run", F.lit("new"))
    sink.write_full(verify.save_results(scans.read_table(spark, path), found), path)
    return scans.read_table(spark, path)


@query(
    "w12_replicate_partitions",
    f"SELECT * FROM ({EVENT_DAYS}) WHERE partition_date IN (20240101, 20240105, 20240106, 20240107)",
)
def w12(spark, sf_dir):
    source, target = scratch_path(spark, "source"), scratch_path(spark, "copy")
    sink.append_partitions(_events_by_day(spark, sf_dir), source)
    sink.replicate_partitions(spark, source, target, [20240101, 20240105])
    sink.replicate_partitions(spark, source, target, [20240105, 20240106, 20240107, 20230101])
    return scans.read_table(spark, target)


@query(
    "w13_delete_repair",
    with_feeds("ods", "thl")
    + """SELECT * FROM ods t WHERE NOT EXISTS (SELECT 1 FROM thl p WHERE p.table_name = 'orders'
        AND p.partition_date BETWEEN 19980101 AND 19990630 AND p.id_column_value = CAST(t.order_key AS VARCHAR))""",
)
def w13(spark, sf_dir):
    path = scratch_path(spark, "repair")
    sink.append_partitions(ods(spark, sf_dir), path)
    repair.delete_repair(spark, path, thl(spark, sf_dir), "order_key", "orders", 19980101, 19990630)
    return scans.read_table(spark, path)


@query("w14_repartition_table", EVENT_DAYS)
def w14(spark, sf_dir):
    path = scratch_path(spark, "renewed")
    wrong = _events_by_day(spark, sf_dir).withColumn("partition_date", F.lit(19700101))
    sink.append_partitions(wrong, path)
    sink.write_full(sink.repartition_table(scans.read_table(spark, path), "ts"), path, "partition_date")
    return scans.read_table(spark, path)


@query("w15_compact", EVENT_DAYS)
def w15(spark, sf_dir):
    path = scratch_path(spark, "small_files")
    rows = _events_by_day(spark, sf_dir)
    for kind in ("click", "error", "purchase", "signup", "view"):
        sink.append_partitions(rows.where(F.col("event_type") == kind), path)
    sink.compact(spark, path)
    return scans.read_table(spark, path)


@query(
    "w15_compact_text_partitions",
    """SELECT event_id, event_type, value, CASE event_type WHEN 'view' THEN NULL WHEN 'click' THEN 'a:b' WHEN 'error' THEN '02'
        WHEN 'signup' THEN '01' ELSE 'x y/%' END AS part FROM events""",
)
def w15_text(spark, sf_dir):
    """Partition values that read as numbers, need escaping, or are absent: each folder becomes one file without losing a row."""
    kind = F.col("event_type")
    part = F.when(kind == "view", None).when(kind == "click", "a:b").when(kind == "error", "02").when(kind == "signup", "01")
    rows = table(spark, sf_dir, "events").select("event_id", "event_type", "value", part.otherwise("x y/%").alias("part"))
    path = scratch_path(spark, "text_parts")
    for k in range(3):
        sink.append_partitions(rows.where(F.col("event_id") % 3 == k), path, "part")
    sink.compact(spark, path)
    return scans.read_table(spark, path, schema=rows.schema)


@query(
    "w16_retain_latest",
    """SELECT event_id, user_id, event_type, ts FROM (SELECT *, row_number() OVER (
        PARTITION BY user_id, event_type ORDER BY ts DESC NULLS LAST, event_id NULLS LAST) AS rn FROM events)
    WHERE rn <= 2""",
)
def w16(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    return sink.retain_latest(rows, ["user_id", "event_type"], "ts")


@query(
    "w17_retain_newer_than",
    "SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-16 12:00:00'",
)
def w17(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "ts")
    return sink.retain_newer_than(rows, "ts", datetime(2024, 1, 26, 12))
