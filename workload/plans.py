"""Whole tasks, positions and named functions: the K, M and F rows of the survey."""

from __future__ import annotations

from collections import Counter
from dataclasses import replace
from datetime import datetime

from pyspark.sql import functions as F

from tidekeep import SyncType, TaskConfig
from tidekeep.functions.text import ends_with
from tidekeep.config import end_day
from tidekeep.operators.aggregates import duplicate_keys, newest_delete
from tidekeep.operators.project import cdc_window
from tidekeep.operators.setops import union_all
from tidekeep.plans import cdc as logs
from tidekeep.plans import clean, export, repair, sqltask, verify
from tidekeep.session import scratch_path
from tidekeep.sinks import tables as sink
from tidekeep.sinks.files import FileTree
from tidekeep.sources import extract
from tidekeep.sources.scans import read_landing, read_table
from tidekeep.streaming import demux, positions

from .aggregates import AS_OF, MERGED, checked_sql
from .feeds import (
    SCHEMAS,
    cdc,
    cdc_rows,
    counted_source,
    counted_target,
    landing,
    lines,
    ods,
    ods_daily,
    pending,
    table,
    thl,
    with_feeds,
)
from .registry import query
from .sources import EVENT_DAYS, _events_by_day

BEGIN, END = datetime(1998, 11, 1), datetime(1998, 12, 31)
STAMP = datetime(1999, 1, 1, 2)
CLEAN = TaskConfig(
    group="retail",
    trigger="orders_clnd",
    primary_keys=("order_key",),
    select_columns=("order_key", "party_key", "status", "amount", "update_time", "ods_update_time"),
    sync_time_column="update_time",
    filters=("and src_t.amount > 1200",),
    lookback_months=12,
)
# The delta has no audit column of its own; the clean sets it.
LANDED = "SELECT *, CAST(NULL AS VARCHAR) AS ods_update_time FROM landing"


def landed(spark, sf_dir):
    return landing(spark, sf_dir).withColumn("ods_update_time", F.lit(None).cast("string"))


def merged_sql(old: str, lo: int = 199711, hi: int = 199812) -> str:
    """Kept rows of the look-back months and the newest landed row per key, as a CTE named merged."""
    return f"""kept AS (SELECT order_key, party_key, status, amount, update_time FROM {old} t
        WHERE partition_date BETWEEN {lo} AND {hi} AND amount > 1200
          AND NOT EXISTS (SELECT 1 FROM landing d WHERE d.partition_date BETWEEN 19981101 AND 19981231
                          AND d.order_key = t.order_key)
          AND NOT EXISTS (SELECT 1 FROM thl p WHERE p.partition_date BETWEEN 19981101 AND 19981231
                          AND p.id_column_value = CAST(t.order_key AS VARCHAR))),
    newest AS (SELECT order_key, party_key, status, amount, update_time FROM (SELECT *, row_number() OVER (
            PARTITION BY order_key ORDER BY update_time DESC NULLS LAST, party_key NULLS LAST, status NULLS LAST,
            amount NULLS LAST) AS rn FROM landing WHERE partition_date BETWEEN 19981101 AND 19981231 AND amount > 1200)
        WHERE rn = 1),
    merged AS (SELECT *, '1999-01-01 02:00:00' AS ods_update_time,
        CAST(strftime(update_time, '%Y%m') AS INTEGER) AS partition_date
        FROM (SELECT * FROM kept UNION ALL SELECT * FROM newest))"""


CLEANED_ODS = "clean_ods AS (SELECT * FROM ods WHERE coalesce(ods_update_time, '999') <> '999999')"
TABLE_AFTER = """SELECT * FROM ods WHERE partition_date NOT BETWEEN {lo} AND 199812
        AND partition_date NOT IN (SELECT partition_date FROM merged)
    UNION ALL SELECT * FROM merged"""


@query(
    "k1_cdc_demux",
    with_feeds("cdc")
    + """SELECT seq_no, dml_type, table_name, id_column_value, capture_time, partition_date FROM cdc
    WHERE db_name = 'retail' AND table_name = 'purchase' AND capture_time >= TIMESTAMP '2024-01-08'
        AND capture_time < TIMESTAMP '2024-01-20'""",
)
def k1(spark, sf_dir):
    cfg = TaskConfig(
        group="retail",
        trigger="purchase_thl",
        sync_time_column="capture_time",
        select_columns=("seq_no", "dml_type", "table_name", "id_column_value", "capture_time", "partition_date"),
    )
    path, window = scratch_path(spark, "thl"), (datetime(2024, 1, 8), datetime(2024, 1, 20))
    logs.run_cdc_demux(cdc(spark, sf_dir), cfg, *window, path)
    return read_table(spark, path, schema=logs.cdc_demux(cdc(spark, sf_dir), cfg, *window).schema)


@query(
    "k1_cdc_demux_all",
    with_feeds("cdc")
    + """SELECT * FROM cdc WHERE capture_time >= TIMESTAMP '2024-01-08' AND capture_time < TIMESTAMP '2024-01-20'""",
)
def k1_all(spark, sf_dir):
    path = scratch_path(spark, "thl_all")
    logs.cdc_demux_all(cdc(spark, sf_dir), "capture_time", datetime(2024, 1, 8), datetime(2024, 1, 20), path)
    return read_table(spark, path)


@query(
    "k1_cdc_demux_stream",
    with_feeds("cdc") + "SELECT seq_no, dml_type, db_name, table_name, id_column_value, partition_date FROM cdc",
)
def k1_stream(spark, sf_dir):
    raw = spark.readStream.schema(SCHEMAS["events"]).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    rows = cdc_rows(raw).select("seq_no", "dml_type", "db_name", "table_name", "id_column_value", "partition_date")
    path, progress = scratch_path(spark, "thl_stream"), scratch_path(spark, "progress")
    for _ in range(2):
        demux.route_new_rows(rows, path, progress)
    return demux.read_routed(spark, path, rows.schema)


@query(
    "k1_cdc_demux_landed",
    with_feeds("cdc")
    + "SELECT * REPLACE (partition_date // 100 AS partition_date), 2 AS batches, 2 AS most_files FROM cdc",
)
def k1_landed(spark, sf_dir):
    """Files that land between runs, and a batch that is tried again: every row once, one file per batch, table and day."""
    landed, path, progress = (scratch_path(spark, n) for n in ("landed_log", "routed", "routed_progress"))
    rows = cdc(spark, sf_dir).withColumn("partition_date", F.floor(F.col("partition_date") / 100).cast("int"))
    for odd in (0, 1):
        rows.where(F.col("seq_no") % 2 == odd).write.mode("append").parquet(landed)
        demux.route_new_rows(spark.readStream.schema(rows.schema).parquet(landed), path, progress)
        demux.write_batch(rows.where(F.col("seq_no") % 2 == odd), odd, path)
    files = FileTree(spark).data_files(path)
    batches = len({f.folder.rpartition("/")[2] for f in files})
    most = max(Counter(f.folder.rpartition("/")[0] for f in files).values(), default=0)
    return demux.read_routed(spark, path, rows.schema).withColumns({"batches": F.lit(batches), "most_files": F.lit(most)})


@query("k2_clean_rewrite", with_feeds("ods", "landing", "thl") + f", {merged_sql('ods')} SELECT * FROM merged")
def k2(spark, sf_dir):
    return clean.clean_rewrite(ods(spark, sf_dir), landed(spark, sf_dir), thl(spark, sf_dir), CLEAN, BEGIN, END, STAMP)


@query(
    "k3_clean_overwrite_table",
    with_feeds("ods", "landing", "thl")
    + f", {CLEANED_ODS}, {merged_sql('clean_ods')} {TABLE_AFTER.format(lo=199711)}",
)
def k3(spark, sf_dir):
    path = scratch_path(spark, "cleaned")
    sink.append_partitions(ods(spark, sf_dir), path)
    clean.run_clean(spark, path, landed(spark, sf_dir), thl(spark, sf_dir), CLEAN, BEGIN, END, STAMP)
    return read_table(spark, path)


@query(
    "k4_clean_overwrite",
    with_feeds("ods", "landing", "thl") + f", {CLEANED_ODS}, {merged_sql('clean_ods')} SELECT * FROM merged",
)
def k4(spark, sf_dir):
    return clean.clean_overwrite(
        ods(spark, sf_dir), landed(spark, sf_dir), thl(spark, sf_dir), CLEAN, BEGIN, END, STAMP
    )


DELETES_BEFORE = "SELECT max(seq_no) FROM thl WHERE dml_type = 0 AND capture_time < TIMESTAMP '1998-11-01'"
LOGGED = f"""logged AS (SELECT id_column_value AS id FROM thl WHERE seq_no BETWEEN ({DELETES_BEFORE})
        AND (SELECT max(seq_no) FROM thl WHERE dml_type = 0)),
    fresh AS (SELECT * FROM landing WHERE partition_date BETWEEN 19981101 AND 19981230),
    gone AS (SELECT CAST(order_key AS VARCHAR) AS id FROM fresh WHERE amount > 1200 UNION SELECT id FROM logged)"""


@query(
    "k5_clean_incremental",
    with_feeds("ods_daily", "landing", "thl")
    + f""", {LOGGED} SELECT * FROM ods_daily WHERE NOT (partition_date >= 19971101
            AND CAST(order_key AS VARCHAR) IN (SELECT id FROM gone))
    UNION ALL SELECT order_key, party_key, status, amount, update_time, NULL AS ods_update_time, partition_date FROM fresh
        WHERE amount > 1200 AND CAST(order_key AS VARCHAR) NOT IN (SELECT id FROM logged)""",
)
def k5(spark, sf_dir):
    log = thl(spark, sf_dir)
    before = positions.positions_of(log.where("capture_time < timestamp_ntz'1998-11-01'"), BEGIN)
    position = positions.load_position(before, "retail", "orders")
    cfg = TaskConfig(
        primary_keys=CLEAN.primary_keys,
        select_columns=(*CLEAN.select_columns, "partition_date"),
        filters=CLEAN.filters,
        sync_type=SyncType.ACID,
    )
    target, delta = ods_daily(spark, sf_dir), landed(spark, sf_dir)
    return clean.clean_incremental(target, delta, log, cfg, position, BEGIN, END).table


def incremental_step(n: int, table: str, before: str, lo: int, last: int, oldest: int) -> str:
    """One window in SQL: after<n> from a table and a position, up to and including the day `last`."""
    return f"""log{n} AS (SELECT * FROM thl WHERE partition_date <= {last}),
    pos{n} AS (SELECT greatest(({before}), (SELECT max(seq_no) FROM log{n} WHERE dml_type = 0)) AS p),
    ids{n} AS (SELECT id_column_value AS id FROM log{n} WHERE seq_no BETWEEN ({before}) AND (SELECT p FROM pos{n})),
    fresh{n} AS (SELECT * FROM landing WHERE partition_date BETWEEN {lo} AND {last}),
    gone{n} AS (SELECT CAST(order_key AS VARCHAR) AS id FROM fresh{n} WHERE amount > 1200 UNION SELECT id FROM ids{n}),
    after{n} AS (SELECT * FROM {table} WHERE NOT (partition_date >= {oldest}
            AND CAST(order_key AS VARCHAR) IN (SELECT id FROM gone{n}))
        UNION ALL SELECT order_key, party_key, status, amount, update_time, NULL, partition_date // 100 * 100 + 1 FROM fresh{n}
        WHERE amount > 1200 AND CAST(order_key AS VARCHAR) NOT IN (SELECT id FROM ids{n}))"""


@query(
    "k5_run_incremental",
    with_feeds("ods_daily", "landing", "thl")
    + f""", stored AS (SELECT * REPLACE (partition_date // 100 * 100 + 1 AS partition_date) FROM ods_daily),
    {incremental_step(1, "stored", DELETES_BEFORE, 19981101, 19981130, 19971101)},
    {incremental_step(2, "after1", "SELECT p FROM pos1", 19981201, 19981230, 19971201)}
    SELECT *, (SELECT p FROM pos2) AS position FROM after2""",
)
def k5_run(spark, sf_dir):
    """Two windows on a table stored by the first day of each month, the second run twice: the table, and the position."""
    path, saved = scratch_path(spark, "incremental"), scratch_path(spark, "positions")
    first_day = (F.floor(F.col("partition_date") / 100) * 100 + 1).cast("int")
    sink.append_partitions(ods_daily(spark, sf_dir).withColumn("partition_date", first_day), path)
    log = thl(spark, sf_dir)
    start = newest_delete(log.where("capture_time < timestamp_ntz'1998-11-01'")).first()
    start = positions.Position(*start) if start else positions.Position()
    sink.write_full(positions.position_row(spark, "retail", "orders", start, BEGIN), saved)
    cfg = TaskConfig(
        group="retail",
        target_table="orders",
        primary_keys=CLEAN.primary_keys,
        select_columns=(*CLEAN.select_columns, "cast(floor(src_t.partition_date / 100) * 100 + 1 as int) as partition_date"),
        filters=CLEAN.filters,
        sync_type=SyncType.ACID,
    )
    december = datetime(1998, 12, 1)
    before_second = read_table(spark, saved)
    for begin, end, repeated in ((BEGIN, december, False), (december, END, False), (december, END, True)):
        if repeated:  # as if the run had died before it saved its position
            sink.write_full(before_second, saved)
        else:
            before_second = spark.createDataFrame(read_table(spark, saved).collect(), positions.POSITION_SCHEMA)
        known = log.where(F.col("partition_date") <= end_day(end))
        position = clean.run_clean_incremental(
            spark, path, saved, landed(spark, sf_dir), known, cfg, begin, end, STAMP
        )
    return read_table(spark, path).withColumn("position", F.lit(position.seq_no))


@query(
    "k6_clean_full",
    "SELECT c_custkey AS party_key, c_mktsegment AS segment, c_acctbal AS balance FROM customer WHERE c_acctbal > 0",
)
def k6(spark, sf_dir):
    cfg = TaskConfig(
        select_columns=("c_custkey as party_key", "c_mktsegment as segment", "c_acctbal as balance"),
        filters=("and c_acctbal > 0",),
    )
    path = scratch_path(spark, "full_clean")
    clean.run_clean_full(table(spark, sf_dir, "customer"), cfg, path)
    return read_table(spark, path)


@query(
    "k7_full_load",
    "SELECT s_suppkey, s_acctbal, s_nationkey FROM supplier WHERE s_acctbal > 1000 AND s_nationkey < 20",
)
def k7(spark, sf_dir):
    cfg = TaskConfig(
        select_columns=("s_suppkey", "s_acctbal", "s_nationkey"), filters=("s_acctbal > 1000", "and s_nationkey < 20")
    )
    path = scratch_path(spark, "full_load")
    clean.run_clean_full(table(spark, sf_dir, "supplier"), cfg, path)
    return read_table(spark, path)


EXPORTED = """SELECT order_key, status, amount, partition_date FROM ods
    WHERE ods_update_time <> '999999' AND partition_date BETWEEN 200006 AND 200007"""


@query(
    "k8_export",
    with_feeds("ods")
    + f""", e AS ({EXPORTED}) SELECT 'retail' AS group_name, 'orders' AS task_name, 'FINISHED' AS status,
        (SELECT count(*) FROM e) AS exported, (SELECT sum(order_key)::BIGINT FROM e) AS key_sum
    UNION ALL SELECT 'retail', o_orderstatus, 'INTERRUPTED', 0, 0 FROM (SELECT DISTINCT o_orderstatus FROM orders)""",
)
def k8(spark, sf_dir):
    rows = ods(spark, sf_dir)
    cfg = TaskConfig(
        group="retail",
        trigger="orders",
        select_columns=("order_key", "status", "amount", "partition_date"),
        sync_type=SyncType.REWRITE,
    )
    target, status = scratch_path(spark, "report"), scratch_path(spark, "status")
    earlier = rows.select("status").distinct().select(
        F.lit("retail").alias("group_name"),
        F.col("status").alias("task_name"),
        F.lit("2000-01-01 00:00:00").cast("timestamp_ntz").alias("finshed_time"),
        F.lit("INTERRUPTED").alias("status"),
    )
    renewed = earlier.withColumn("task_name", F.lit("orders")).distinct()
    sink.write_full(union_all(earlier, renewed), status)
    as_of = datetime(2000, 7, 12, 4, 30)
    schema = export.export_snapshot(rows, cfg, as_of).schema
    export.export(rows, cfg, as_of, lambda df: sink.export_rows(df, target), status)
    sent = read_landing(spark, target, schema)
    totals = sent.agg(F.count(F.lit(1)).alias("exported"), F.sum("order_key").alias("key_sum"))
    totals = totals.withColumn("task_name", F.lit("orders"))
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("exported", "key_sum")]
    joined = read_table(spark, status).join(totals, "task_name", "left")
    return joined.select("group_name", "task_name", "status", *counts)


@query(
    "k8_export_month_table",
    with_feeds("ods")
    + """SELECT order_key, status, amount, partition_date FROM ods WHERE ods_update_time <> '999999'
        AND partition_date BETWEEN 200006 AND 200007 AND amount > 1000""",
)
def k8_months(spark, sf_dir):
    """A stored month table that an overwriting clean maintains, exported by its months."""
    path, target, status = (scratch_path(spark, n) for n in ("months", "month_report", "month_status"))
    sink.append_partitions(ods(spark, sf_dir), path)
    cfg = TaskConfig(
        group="retail",
        trigger="orders",
        select_columns=("order_key", "status", "amount", "t2.partition_date"),
        filters=("and t2.amount > 1000",),
        sync_type=SyncType.OVERWRITE,
    )
    return exported(spark, read_table(spark, path), cfg, datetime(2000, 7, 12, 4, 30), target, status)


@query(
    "k8_export_change_log",
    with_feeds("thl")
    + """SELECT seq_no, dml_type, id_column_value, capture_time, partition_date FROM thl
        WHERE partition_date BETWEEN 19980501 AND 19980610""",
)
def k8_log(spark, sf_dir):
    """A change log, which has no placeholder rows and no audit column to tell them by."""
    cfg = TaskConfig(
        group="retail",
        trigger="orders_thl",
        select_columns=("seq_no", "dml_type", "id_column_value", "capture_time", "partition_date"),
    )
    target, status = scratch_path(spark, "log_report"), scratch_path(spark, "log_status")
    return exported(spark, thl(spark, sf_dir), cfg, datetime(1998, 6, 10, 3), target, status, is_log=True)


def exported(spark, rows, cfg, as_of, target, status, is_log=False):
    """What an export delivered, if its status says that it finished."""
    first = export.task_status(spark, cfg, "INTERRUPTED", as_of)
    sink.write_full(first, status)
    schema = export.export_snapshot(rows, cfg, as_of, is_log).schema
    export.export(rows, cfg, as_of, lambda df: sink.export_rows(df, target), status, is_log)
    finished = read_table(spark, status).where("status = 'FINISHED'").select(F.col("task_name").alias("__task"))
    sent = read_landing(spark, target, schema).withColumn("__task", F.lit(cfg.trigger))
    return sent.join(finished, "__task", "left_semi").drop("__task")


@query(
    "k1_half_day_demux",
    with_feeds("cdc")
    + """SELECT seq_no, table_name, partition_date FROM cdc WHERE db_name = 'retail' AND table_name = 'purchase'
        AND capture_time >= TIMESTAMP '2024-01-08' AND capture_time < TIMESTAMP '2024-01-10'""",
)
def k1_half_days(spark, sf_dir):
    """Windows that begin and end inside a day: the days they touch are routed whole, so none loses its other half."""
    cfg = TaskConfig(
        group="retail",
        trigger="purchase-log",
        log_suffixes=("-log",),
        sync_time_column="capture_time",
        select_columns=("seq_no", "table_name", "partition_date"),
    )
    path, log = scratch_path(spark, "half_days"), cdc(spark, sf_dir)
    for begin, end in (((2024, 1, 8, 6), (2024, 1, 8, 18)), ((2024, 1, 8, 18), (2024, 1, 9, 6)), ((2024, 1, 9, 6), (2024, 1, 9, 7))):
        logs.run_cdc_demux(log, cfg, datetime(*begin), datetime(*end), path)
    return read_table(spark, path, schema=logs.cdc_demux(log, cfg, BEGIN, END).schema)


@query(
    "m3_late_rows",
    with_feeds("ods", "landing", "thl")
    + f""", {merged_sql('ods', 199809)}, beyond AS (SELECT DISTINCT partition_date FROM merged WHERE partition_date NOT BETWEEN 199809
        AND 199812)
    SELECT * FROM ods WHERE partition_date NOT BETWEEN 199809 AND 199812 AND NOT (
            partition_date IN (SELECT partition_date FROM beyond) AND (
                CAST(order_key AS VARCHAR) IN (SELECT id_column_value FROM thl WHERE partition_date BETWEEN 19981101 AND 19981231)
                OR order_key IN (SELECT order_key FROM landing WHERE partition_date BETWEEN 19981101 AND 19981231)))
    UNION ALL SELECT * FROM merged""",
)
def m3_late(spark, sf_dir):
    """A clean with a short look-back of rows that fall into other months, twice, by the type that drops and writes again."""
    path = scratch_path(spark, "late")
    sink.append_partitions(ods(spark, sf_dir), path)
    cfg = replace(CLEAN, lookback_months=2, sync_type=SyncType.REWRITE)
    for _ in range(2):
        clean.run_clean(spark, path, landed(spark, sf_dir), thl(spark, sf_dir), cfg, BEGIN, END, STAMP)
    return read_table(spark, path)


@query(
    "k9_verify_sync",
    with_feeds("counted_source", "counted_target")
    + f", {MERGED}, {checked_sql(20, 2.0)} SELECT *, '2024-01-31 10:00:00' AS create_date FROM checked",
)
def k9(spark, sf_dir):
    source, target = counted_source(spark, sf_dir), counted_target(spark, sf_dir)
    return verify.verify_sync(source, target, "update_time", AS_OF, days=20)


@query(
    "k10_verify_duplicates",
    with_feeds("lines", "landing")
    + """SELECT 'retail' AS group_name, 'lines' AS table_name, 'order_key,line_no' AS primary_key,
        '[order_key=' || order_key || '][line_no=' || line_no || ']' AS primary_value, count(*) AS occurrences
        FROM lines WHERE partition_date >= 20000801 GROUP BY order_key, line_no HAVING count(*) > 1
    UNION ALL SELECT 'retail', 'landing', 'order_key', '[order_key=' || order_key || ']', count(*)
        FROM landing WHERE partition_date >= 20000801 GROUP BY order_key HAVING count(*) > 1""",
)
def k10(spark, sf_dir):
    checked = [
        verify.CheckedTable("retail", "lines", lines(spark, sf_dir), ("order_key", "line_no")),
        verify.CheckedTable("retail", "landing", landing(spark, sf_dir), ("order_key",)),
    ]
    return verify.verify_duplicates(checked, datetime(2001, 8, 1))


@query(
    "k10_registered_checks",
    with_feeds("lines", "landing")
    + """SELECT 'retail' AS group_name, 'lines' AS table_name, 'order_key,line_no' AS primary_key,
        '[order_key=' || order_key || '][line_no=' || line_no || ']' AS primary_value, count(*) AS occurrences,
        20010801 AS check_day FROM lines WHERE partition_date >= 20000801 GROUP BY order_key, line_no HAVING count(*) > 1
    UNION ALL SELECT 'retail', 'lines', 'part_key,order_key', '[part_key=' || part_key || '][order_key=' || order_key || ']',
        count(*), 20010801 FROM lines WHERE partition_date >= 20000801 GROUP BY part_key, order_key HAVING count(*) > 1
    UNION ALL SELECT 'retail', 'landing', 'order_key', '[order_key=' || order_key || ']', count(*), 20010801
        FROM landing WHERE partition_date >= 20000801 GROUP BY order_key HAVING count(*) > 1""",
)
def k10_registered(spark, sf_dir):
    """Registered checks, one of them disabled and two of one table, a table per plan, run twice on a day."""
    registry = spark.createDataFrame(
        [(1, "lines", "retail", 0), (2, "landing", "retail", 0), (3, "thl", "retail", 1)],
        "id int, table_name string, group_name string, is_disable int",
    )
    on, path = verify.enabled_names(registry), scratch_path(spark, "duplicates")
    own = lines(spark, sf_dir)
    checks = [
        verify.CheckedTable("retail", name, rows, keys, ("retail", name) in on)
        for name, rows, keys in (
            ("lines", own, ("order_key", "line_no")),
            ("lines", own, ("part_key", "order_key")),
            ("landing", landing(spark, sf_dir), ("order_key",)),
            ("thl", thl(spark, sf_dir), ("id_column_value",)),
        )
    ]
    for _ in range(2):
        verify.run_duplicate_checks(checks, datetime(2001, 8, 1), path, per_plan=1)
    return verify.read_check_results(spark, path)


@query(
    "k11_delete_repair_run",
    with_feeds("ods", "thl", "pending")
    + """, span AS (SELECT min(yw_update_time) AS lo, max(yw_update_time) AS hi FROM pending WHERE process_status = 0)
    SELECT 'warehouse' AS place, count(*) AS rows, sum(order_key)::BIGINT AS key_sum FROM ods t WHERE NOT EXISTS (
        SELECT 1 FROM pending p, span WHERE p.partition_date BETWEEN CAST(strftime(lo, '%Y%m%d') AS INTEGER)
        AND CAST(strftime(hi, '%Y%m%d') AS INTEGER) AND p.id_column_value = CAST(t.order_key AS VARCHAR))
    UNION ALL SELECT 'report', count(*), sum(order_key)::BIGINT FROM ods t WHERE NOT EXISTS (
        SELECT 1 FROM pending p WHERE process_status = 0 AND p.id_column_value = CAST(t.order_key AS VARCHAR))
    UNION ALL SELECT 'log', count(*), 0 FROM pending""",
)
def k11(spark, sf_dir):
    warehouse, report, log = (scratch_path(spark, n) for n in ("warehouse", "report", "deletes"))
    sink.append_partitions(ods(spark, sf_dir), warehouse)
    sink.write_full(ods(spark, sf_dir), report)
    sink.write_full(pending(spark, sf_dir), log)
    repair.delete_repair_run(spark, warehouse, report, log, "order_key", "orders")

    def summary(place, df, key):
        return df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(key), F.lit(0)).alias("key_sum")).select(
            F.lit(place).alias("place"), "rows", "key_sum"
        )

    return union_all(
        summary("warehouse", read_table(spark, warehouse), "order_key"),
        summary("report", read_table(spark, report), "order_key"),
        summary("log", read_table(spark, log).where("process_status = 1"), F.lit(0).cast("bigint")),
    )


@query(
    "k12_backfill_state",
    with_feeds("cdc")
    + """, found AS (SELECT DISTINCT regexp_replace(table_name, '_his$', '') AS table_name,
            CAST(strftime(dml_event_time - INTERVAL 1 SECOND, '%Y%m%d') AS INTEGER) AS backfill_day
        FROM cdc WHERE dml_type <> 0 AND partition_date BETWEEN 20240105 AND 20240119)
    SELECT * FROM found WHERE table_name IN (SELECT table_name FROM cdc) UNION ALL
    SELECT DISTINCT table_name, 0 FROM cdc WHERE table_name NOT IN (SELECT table_name FROM found)""",
)
def k12(spark, sf_dir):
    log = cdc(spark, sf_dir)
    return logs.backfill_state(
        log.select("table_name").distinct(), log, datetime(2024, 2, 1), datetime(2024, 1, 5), datetime(2024, 1, 20)
    )


@query(
    "k12_backfilled_extract",
    with_feeds("cdc")
    + """, found AS (SELECT DISTINCT regexp_replace(table_name, '_his$', '') AS table_name,
            CAST(strftime(dml_event_time - INTERVAL 1 SECOND, '%Y%m%d') AS INTEGER) AS backfill_day
        FROM cdc WHERE dml_type <> 0 AND partition_date BETWEEN 20240105 AND 20240119),
    known AS (SELECT DISTINCT event_type AS table_name, 20240103 AS backfill_day FROM events),
    state AS (SELECT * FROM found UNION SELECT * FROM known)
    SELECT event_id, event_type, ts, value, 'live' AS origin FROM events
        WHERE ts >= TIMESTAMP '2024-01-12' AND ts < TIMESTAMP '2024-01-13' AND value > 5
    UNION ALL SELECT event_id, event_type, ts, value, 'history' FROM events
        WHERE ts >= TIMESTAMP '2024-01-12' AND ts < TIMESTAMP '2024-01-13' AND event_type = 'error'
        AND CAST(strftime(ts, '%Y%m%d') AS INTEGER) IN (SELECT backfill_day FROM state WHERE table_name = 'error')
    UNION ALL SELECT event_id, event_type, ts, value, 'backfill' FROM events WHERE event_type = 'error'
        AND CAST(strftime(ts, '%Y%m%d') AS INTEGER) IN (SELECT backfill_day FROM state WHERE table_name = 'error')""",
)
def k12_extract(spark, sf_dir):
    """From the log to the extract: days found, merged into the stored state, and the history read they call for."""
    log, as_of = cdc(spark, sf_dir), datetime(2024, 2, 1)
    events = table(spark, sf_dir, "events")
    state_path, history_path = scratch_path(spark, "backfill_state"), scratch_path(spark, "history")
    known = events.select(F.col("event_type").alias("table_name"), F.lit(20240103).alias("backfill_day")).distinct()
    forgotten = known.withColumn("backfill_day", F.lit(20221231))
    sink.write_full(union_all(known, forgotten), state_path)
    found = logs.backfill_days(log, as_of, datetime(2024, 1, 5), datetime(2024, 1, 20))
    sink.write_full(logs.merge_backfill(read_table(spark, state_path), found, as_of), state_path)
    sink.append_partitions(_events_by_day(spark, sf_dir).where("event_type = 'error'"), history_path)
    state, history = read_table(spark, state_path), read_table(spark, history_path)
    cfg = TaskConfig(
        select_columns=("event_id", "event_type", "ts", "value", "'live' as origin"),
        history_columns=("event_id", "event_type", "ts", "value", "'history' as origin"),
        sync_time_column="ts",
        filters=("value > 5",),
    )
    day = datetime(2024, 1, 12), datetime(2024, 1, 13)
    extracted = extract.extract_with_backfill(events, history, state, "error", cfg, *day)
    again = extract.backfilled_rows(history, state, "error")
    return extracted.union(again.select("event_id", "event_type", "ts", "value", F.lit("backfill").alias("origin")))


@query(
    "k13_replicate",
    f"""SELECT event_id, event_type, ts, CASE WHEN partition_date IN (20240111, 20240112) AND ts > TIMESTAMP '2024-01-11 02:00:00'
            AND ts < TIMESTAMP '2024-01-12 22:00:00' THEN value + 1000 ELSE value END AS value, partition_date
        FROM ({EVENT_DAYS}) WHERE partition_date IN (20240110, 20240111)
            OR partition_date = 20240112 AND ts < TIMESTAMP '2024-01-12 22:00:00'""",
)
def k13(spark, sf_dir):
    """Two days mirrored, then a corrected source replicated between two times: the rest of those days stays."""
    source, corrected, target = (scratch_path(spark, n) for n in ("origin", "corrected", "mirror"))
    rows = _events_by_day(spark, sf_dir)
    sink.append_partitions(rows, source)
    sink.append_partitions(rows.withColumn("value", F.col("value") + 1000), corrected)
    sink.replicate_partitions(spark, source, target, [20240110, 20240111])
    sink.replicate_partitions(
        spark, corrected, target, [20240111, 20240112], "ts", datetime(2024, 1, 11, 2), datetime(2024, 1, 12, 22)
    )
    return read_table(spark, target)


@query(
    "k13_mirror",
    f"""SELECT event_id, event_type, ts, CASE WHEN partition_date = 20240105 THEN value + 1000 ELSE value END AS value,
        partition_date FROM ({EVENT_DAYS}) WHERE partition_date <> 20240107""",
)
def k13_mirror(spark, sf_dir):
    """A mirror made again after one day of the source was corrected and another dropped."""
    source, target = scratch_path(spark, "live"), scratch_path(spark, "mirrored")
    rows = _events_by_day(spark, sf_dir)
    sink.append_partitions(rows, source)
    sink.replicate_partitions(spark, source, target)
    day = F.col("partition_date") == 20240105
    sink.replace_partitions(rows.where(day).withColumn("value", F.col("value") + 1000), source, [20240105, 20240107])
    sink.replicate_partitions(spark, source, target)
    return read_table(spark, target)


@query(
    "k14_run_sql_task",
    """SELECT event_type, count(*) AS events, '2024-01-08 00:00:00' AS since, 1705276800000 AS until_millis FROM events
    WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-15' GROUP BY event_type""",
)
def k14(spark, sf_dir):
    return sqltask.run_sql_task(
        spark,
        "SELECT event_type, count(*) AS events, :b AS since, :em AS until_millis FROM {events} "
        "WHERE ts >= cast(:b AS timestamp_ntz) AND ts < cast(:e AS timestamp_ntz) AND :bm < :em GROUP BY event_type",
        datetime(2024, 1, 8),
        datetime(2024, 1, 15),
        ("b", "e", "bm", "em"),
        {"events": table(spark, sf_dir, "events")},
    )


@query(
    "k15_update_where",
    """SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
        CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice FROM orders""",
)
def k15(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    changes = {"o_orderstatus": F.lit("X"), "o_totalprice": F.col("o_totalprice") * 2}
    return repair.update_where(rows, F.col("o_orderpriority") == "1-URGENT", changes).drop("o_orderpriority")


@query(
    "m1_save_position",
    with_feeds("cdc")
    + """SELECT db_name AS sys_name, table_name, max(seq_no) FILTER (WHERE capture_time < TIMESTAMP '2024-01-20')
            AS seq_no, '2024-01-20 00:00:00' AS update_time FROM cdc WHERE dml_type = 0
        AND capture_time < TIMESTAMP '2024-01-20' GROUP BY db_name, table_name""",
)
def m1(spark, sf_dir):
    log, noon = cdc(spark, sf_dir), datetime(2024, 1, 20)
    path = scratch_path(spark, "positions")
    first = positions.positions_of(cdc_window(log, "capture_time", datetime(2024, 1, 1), datetime(2024, 1, 10)), noon)
    sink.write_full(first, path)
    second = positions.positions_of(cdc_window(log, "capture_time", datetime(2024, 1, 10), noon), noon)
    sink.write_full(positions.save_position(read_table(spark, path), second), path)
    return read_table(spark, path)


@query(
    "m2_late_rows_survive",
    with_feeds("ods", "landing", "thl")
    + f""", {CLEANED_ODS}, {merged_sql('clean_ods', 199809)}, after AS ({TABLE_AFTER.format(lo=199809)})
    SELECT 'order_key' AS primary_key, '[order_key=' || order_key || ']' AS primary_value, count(*) AS occurrences
    FROM after GROUP BY order_key HAVING count(*) > 1""",
)
def m2(spark, sf_dir):
    path = scratch_path(spark, "short_lookback")
    sink.append_partitions(ods(spark, sf_dir), path)
    cfg = replace(CLEAN, lookback_months=2)
    clean.run_clean(spark, path, landed(spark, sf_dir), thl(spark, sf_dir), cfg, BEGIN, END, STAMP)
    return duplicate_keys(read_table(spark, path), ["order_key"], 0)


@query(
    "m3_rerun_window",
    with_feeds("ods", "landing", "thl")
    + f", {CLEANED_ODS}, {merged_sql('clean_ods')} {TABLE_AFTER.format(lo=199711)}",
)
def m3(spark, sf_dir):
    path = scratch_path(spark, "rerun")
    sink.append_partitions(ods(spark, sf_dir), path)
    for _ in range(2):
        clean.run_clean(spark, path, landed(spark, sf_dir), thl(spark, sf_dir), CLEAN, BEGIN, END, STAMP)
    return read_table(spark, path)


@query(
    "m4_mark_processed",
    with_feeds("thl", "pending")
    + """SELECT * REPLACE (CASE WHEN process_status = 0 AND yw_update_time >= TIMESTAMP '1997-01-01'
        AND yw_update_time <= TIMESTAMP '1999-01-01' THEN 1 ELSE process_status END AS process_status) FROM pending""",
)
def m4(spark, sf_dir):
    return repair.mark_processed(pending(spark, sf_dir), "orders", datetime(1997, 1, 1), datetime(1999, 1, 1))


@query(
    "f1_register_function",
    "SELECT p_partkey, p_name LIKE '%ring' AS is_ring FROM part",
)
def f1(spark, sf_dir):
    for body in ("length(word) < length(suffix)", "endswith(word, suffix)"):
        sqltask.register_function(spark, "ends_on", "word STRING, suffix STRING", "BOOLEAN", body)
    sql = "SELECT p_partkey, ends_on(p_name, 'ring') AS is_ring FROM {part}"
    return spark.sql(sql, part=table(spark, sf_dir, "part"))


@query("f2_ends_with", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%widget'")
def f2(spark, sf_dir):
    return table(spark, sf_dir, "part").where(ends_with(F.col("p_name"), "widget")).select("p_partkey", "p_name")
