"""The tables a retail data platform would hold, derived from the given ones.

Each feed exists twice, as a DataFrame and as a common table expression of the same name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidekeep.functions.dates import day_int, month_int
from tidekeep.functions.text import composite_key


# Declared, so that opening a table needs no job to infer it.
SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "pages": "page_id bigint, url string, html string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


FEEDS: dict[str, str] = {}


def with_feeds(*names: str) -> str:
    """The WITH clause that defines the named feeds."""
    return "WITH " + ",\n".join(f"{n} AS ({FEEDS[n]})" for n in names) + "\n"


# The cleaned order table: month partitions, an audit column that is absent, a placeholder or a time.
FEEDS["ods"] = """
    SELECT o_orderkey AS order_key, o_custkey AS party_key, o_orderstatus AS status,
           o_totalprice AS amount, o_orderdate AS update_time,
           CASE o_orderpriority WHEN '1-URGENT' THEN NULL WHEN '5-LOW' THEN '999999'
                ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS ods_update_time,
           CAST(strftime(o_orderdate, '%Y%m') AS INTEGER) AS partition_date
    FROM orders"""


def ods(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    audit = F.when(c("o_orderpriority") == "1-URGENT", None)
    audit = audit.when(c("o_orderpriority") == "5-LOW", "999999")
    audit = audit.otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    return table(spark, sf_dir, "orders").select(
        c("o_orderkey").alias("order_key"),
        c("o_custkey").alias("party_key"),
        c("o_orderstatus").alias("status"),
        c("o_totalprice").alias("amount"),
        c("o_orderdate").alias("update_time"),
        audit.alias("ods_update_time"),
        month_int(c("o_orderdate")).alias("partition_date"),
    )


# The same with day partitions.
FEEDS["ods_daily"] = FEEDS["ods"].replace("'%Y%m')", "'%Y%m%d')")


def ods_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ods(spark, sf_dir).withColumn("partition_date", day_int(F.col("update_time")))


# Landed order versions: the open lines of an order, one version per line.
FEEDS["landing"] = """
    SELECT l_orderkey AS order_key, l_suppkey AS party_key, l_returnflag AS status,
           l_extendedprice AS amount, l_shipdate + to_hours(l_linenumber) AS update_time,
           CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS partition_date
    FROM lineitem WHERE l_linestatus = 'O'"""


def landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    return (
        table(spark, sf_dir, "lineitem")
        .where("l_linestatus = 'O'")
        .select(
            c("l_orderkey").alias("order_key"),
            c("l_suppkey").alias("party_key"),
            c("l_returnflag").alias("status"),
            c("l_extendedprice").alias("amount"),
            (c("l_shipdate") + F.make_dt_interval(F.lit(0), c("l_linenumber"))).alias("update_time"),
            day_int(c("l_shipdate")).alias("partition_date"),
        )
    )


# The order table's delete log: the fulfilled lines; sequence numbers grow with time.
FEEDS["thl"] = """
    SELECT CAST(epoch(date_trunc('day', l_shipdate)) AS BIGINT) + l_linenumber AS seq_no,
           CASE l_returnflag WHEN 'R' THEN 0 WHEN 'A' THEN 1 ELSE 2 END AS dml_type,
           'retail' AS db_name, 'orders' AS table_name, 'order_key' AS id_column_name,
           CAST(l_orderkey AS VARCHAR) AS id_column_value,
           l_shipdate + to_hours(l_linenumber) AS capture_time,
           CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS partition_date
    FROM lineitem WHERE l_linestatus = 'F'"""


def thl(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    return (
        table(spark, sf_dir, "lineitem")
        .where("l_linestatus = 'F'")
        .select(
            (F.unix_date(F.to_date("l_shipdate")).cast("bigint") * 86400 + c("l_linenumber")).alias("seq_no"),
            F.when(c("l_returnflag") == "R", 0).when(c("l_returnflag") == "A", 1).otherwise(2).alias("dml_type"),
            F.lit("retail").alias("db_name"),
            F.lit("orders").alias("table_name"),
            F.lit("order_key").alias("id_column_name"),
            c("l_orderkey").cast("string").alias("id_column_value"),
            (c("l_shipdate") + F.make_dt_interval(F.lit(0), c("l_linenumber"))).alias("capture_time"),
            day_int(c("l_shipdate")).alias("partition_date"),
        )
    )


# Pending deletes: the delete log with a business time and a processed marker per change type.
FEEDS["pending"] = """
    SELECT seq_no, CASE WHEN dml_type = 2 THEN 1 ELSE 0 END AS process_status, table_name, id_column_value,
           capture_time AS yw_update_time, partition_date
    FROM thl"""


def pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return thl(spark, sf_dir).select(
        "seq_no",
        F.when(F.col("dml_type") == 2, 1).otherwise(0).alias("process_status"),
        "table_name",
        "id_column_value",
        F.col("capture_time").alias("yw_update_time"),
        "partition_date",
    )


# Order lines with their composite key, and the log of returned ones.
FEEDS["lines"] = """
    SELECT l_orderkey AS order_key, l_linenumber AS line_no, l_partkey AS part_key, l_quantity AS quantity,
           l_shipdate AS update_time, CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS partition_date
    FROM lineitem"""


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    return table(spark, sf_dir, "lineitem").select(
        c("l_orderkey").alias("order_key"),
        c("l_linenumber").alias("line_no"),
        c("l_partkey").alias("part_key"),
        c("l_quantity").alias("quantity"),
        c("l_shipdate").alias("update_time"),
        day_int(c("l_shipdate")).alias("partition_date"),
    )


FEEDS["line_log"] = """
    SELECT CAST(epoch(date_trunc('day', l_shipdate)) AS BIGINT) + l_linenumber AS seq_no,
           concat(l_orderkey, ',', l_linenumber) AS id_column_value,
           CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS partition_date
    FROM lineitem WHERE l_returnflag = 'R'"""


def line_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    return (
        table(spark, sf_dir, "lineitem")
        .where("l_returnflag = 'R'")
        .select(
            (F.unix_date(F.to_date("l_shipdate")).cast("bigint") * 86400 + c("l_linenumber")).alias("seq_no"),
            composite_key("l_orderkey", "l_linenumber").alias("id_column_value"),
            day_int(c("l_shipdate")).alias("partition_date"),
        )
    )


# The shared change log of several databases and tables; rows moved to history carry its suffix.
FEEDS["cdc"] = """
    SELECT event_id AS seq_no, CASE WHEN value < 20 THEN 0 WHEN value < 60 THEN 1 ELSE 2 END AS dml_type,
           CASE WHEN user_id < 50 THEN 'crm' ELSE 'retail' END AS db_name,
           event_type || CASE WHEN value >= 90 THEN '_his' ELSE '' END AS table_name,
           'user_id' AS id_column_name, CAST(user_id AS VARCHAR) AS id_column_value,
           ts AS capture_time, ts - to_hours(2) AS dml_event_time,
           CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS partition_date
    FROM events"""


def cdc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc_rows(table(spark, sf_dir, "events"))


def cdc_rows(events: DataFrame) -> DataFrame:
    c = F.col
    return events.select(
        c("event_id").alias("seq_no"),
        F.when(c("value") < 20, 0).when(c("value") < 60, 1).otherwise(2).alias("dml_type"),
        F.when(c("user_id") < 50, "crm").otherwise("retail").alias("db_name"),
        F.concat("event_type", F.when(c("value") >= 90, "_his").otherwise("")).alias("table_name"),
        F.lit("user_id").alias("id_column_name"),
        c("user_id").cast("string").alias("id_column_value"),
        c("ts").alias("capture_time"),
        (c("ts") - F.expr("interval 2 hours")).alias("dml_event_time"),
        day_int(c("ts")).alias("partition_date"),
    )


# The run log: one row per task run.
FEEDS["runs"] = """
    SELECT event_id AS id, CAST(user_id AS VARCHAR) AS task_id,
           CASE event_type WHEN 'purchase' THEN 'retail_hive' WHEN 'signup' THEN 'crm_hive'
                WHEN 'error' THEN 'etl_kettle' WHEN 'view' THEN 'dc_common' ELSE 'retail' END AS group_name,
           'u' || user_id || CASE WHEN CAST(regexp_extract(props, '[0-9]+') AS INTEGER) < 50
                             THEN '_cln' ELSE '_src' END AS scheduler_name,
           ts AS create_time,
           CASE WHEN value < 15 THEN 'INTERRUPTED' WHEN value < 35 THEN 'RUNNING' ELSE 'FINISHED' END AS task_status,
           ts - to_hours(1) AS sync_begin_time, ts + to_minutes(user_id) AS sync_end_time
    FROM events"""


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    group = F.when(c("event_type") == "purchase", "retail_hive").when(c("event_type") == "signup", "crm_hive")
    group = group.when(c("event_type") == "error", "etl_kettle").when(c("event_type") == "view", "dc_common")
    kind = F.when(F.regexp_extract("props", "[0-9]+", 0).cast("int") < 50, "_cln").otherwise("_src")
    status = F.when(c("value") < 15, "INTERRUPTED").when(c("value") < 35, "RUNNING").otherwise("FINISHED")
    minutes = F.make_dt_interval(F.lit(0), F.lit(0), c("user_id").cast("int"))
    return table(spark, sf_dir, "events").select(
        c("event_id").alias("id"),
        c("user_id").cast("string").alias("task_id"),
        group.otherwise("retail").alias("group_name"),
        F.concat(F.lit("u"), c("user_id").cast("string"), kind).alias("scheduler_name"),
        c("ts").alias("create_time"),
        status.alias("task_status"),
        (c("ts") - F.expr("interval 1 hour")).alias("sync_begin_time"),
        (c("ts") + minutes).alias("sync_end_time"),
    )


# Source and warehouse side of the daily count check: the warehouse lands rows 90 minutes late and
# never received one kind of event on one day.
FEEDS["counted_source"] = """
    SELECT 'app' AS group_name, event_type AS task_name, ts AS update_time, value FROM events"""


def counted_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.lit("app").alias("group_name"),
        F.col("event_type").alias("task_name"),
        F.col("ts").alias("update_time"),
        "value",
    )


FEEDS["counted_target"] = """
    SELECT 'app' AS group_name, event_type AS task_name,
           CAST(strftime(ts + to_minutes(90), '%Y%m%d') AS INTEGER) AS partition_date
    FROM events WHERE NOT (event_type = 'view' AND strftime(ts, '%Y%m%d') = '20240118')"""


def counted_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    lost = (F.col("event_type") == "view") & (F.date_format("ts", "yyyyMMdd") == "20240118")
    return (
        table(spark, sf_dir, "events")
        .where(~lost)
        .select(
            F.lit("app").alias("group_name"),
            F.col("event_type").alias("task_name"),
            day_int(F.col("ts") + F.expr("interval 90 minutes")).alias("partition_date"),
        )
    )
