"""Projections, filters and scalar expressions: the P and S rows of the survey."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidekeep.config import end_day
from tidekeep.functions import dates, text, types
from tidekeep.operators import project as p
from tidekeep.operators.setops import union_all

from .feeds import cdc, ods, ods_daily, table, with_feeds
from .registry import query

AS_OF = datetime(2001, 7, 15, 9, 30)


@query(
    "p1_project",
    "SELECT o_orderkey AS order_key, upper(o_orderstatus) AS status, o_totalprice * 2 AS doubled FROM orders",
)
def p1(spark, sf_dir):
    return p.project(
        table(spark, sf_dir, "orders"),
        ["o_orderkey as order_key", "upper(o_orderstatus) as status", "o_totalprice * 2 as doubled"],
    )


@query(
    "p2_apply_filters",
    "SELECT p_partkey, p_brand, p_size FROM part WHERE p_brand LIKE 'Brand#1%' AND p_size > 10 AND p_type <> 'PROMO'",
)
def p2(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size", "p_type")
    return p.apply_filters(rows, ["and p_brand like 'Brand#1%'", "p_size > 10", " AND p_type <> 'PROMO'"]).drop("p_type")


@query(
    "p3_split_by_prefix",
    """SELECT 'rt' AS line, p_partkey FROM part WHERE p_brand LIKE 'Brand#1%'
    UNION ALL SELECT 'sp' AS line, p_partkey FROM part WHERE p_brand LIKE 'Brand#2%'
    UNION ALL SELECT 'all' AS line, p_partkey FROM part""",
)
def p3(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    split = p.split_by_prefix(parts, "p_brand", {"rt": "Brand#1", "sp": "Brand#2", "all": ""})
    return union_all(*[df.select(F.lit(name).alias("line"), "p_partkey") for name, df in split.items()])


@query(
    "p4_cdc_window",
    with_feeds("cdc")
    + """SELECT * FROM cdc WHERE capture_time >= TIMESTAMP '2024-01-08' AND capture_time < TIMESTAMP '2024-01-12 06:00:00'
        AND partition_date >= 20240107""",
)
def p4(spark, sf_dir):
    return p.cdc_window(cdc(spark, sf_dir), "capture_time", datetime(2024, 1, 8), datetime(2024, 1, 12, 6))


@query(
    "p5_route",
    with_feeds("cdc") + "SELECT * FROM cdc WHERE db_name = 'retail' AND table_name = 'purchase'",
)
def p5(spark, sf_dir):
    return p.route(cdc(spark, sf_dir), "retail", "purchase_yg_thl")


@query(
    "p6_exclude_status",
    """SELECT o_orderkey, status FROM (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status FROM orders)
    WHERE status NOT IN ('O')""",
)
def p6(spark, sf_dir):
    status = F.nullif("o_orderstatus", F.lit("P")).alias("status")
    return p.exclude_status(table(spark, sf_dir, "orders").select("o_orderkey", status), "status", ["O"])


@query(
    "p7_drop_sentinels",
    with_feeds("ods") + "SELECT * FROM ods WHERE coalesce(ods_update_time, '999') NOT IN ('999999')",
)
def p7(spark, sf_dir):
    return p.drop_sentinels(ods(spark, sf_dir))


@query("p8_export_filter", with_feeds("ods") + "SELECT * FROM ods WHERE ods_update_time <> '999999'")
def p8(spark, sf_dir):
    return p.export_filter(ods(spark, sf_dir))


@query(
    "p9_export_span",
    with_feeds("ods", "ods_daily")
    + """SELECT 'day' AS grain, order_key FROM ods_daily WHERE partition_date BETWEEN 20010605 AND 20010715
    UNION ALL SELECT 'month' AS grain, order_key FROM ods WHERE partition_date BETWEEN 200106 AND 200107""",
)
def p9(spark, sf_dir):
    days = p.in_export_span(ods_daily(spark, sf_dir), AS_OF)
    months = p.in_export_span(ods(spark, sf_dir), AS_OF, grain="month")
    return union_all(
        days.select(F.lit("day").alias("grain"), "order_key"), months.select(F.lit("month").alias("grain"), "order_key")
    )


@query(
    "p10_lookback_months",
    with_feeds("ods") + "SELECT * FROM ods WHERE partition_date BETWEEN 199711 AND 199812",
)
def p10(spark, sf_dir):
    return p.in_lookback(ods(spark, sf_dir), datetime(1998, 11, 30), datetime(1998, 12, 1), 12)


@query(
    "p11_with_audit",
    """SELECT c_custkey, '2001-07-15 09:30:00' AS src_update_time, '2001-07-15 09:30:00' AS ods_update_time,
           '2001-07-15 09:30:00' AS yw_update_time FROM customer""",
)
def p11(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey")
    for name in ("src_update_time", "ods_update_time", "yw_update_time"):
        rows = p.with_audit(rows, name, AS_OF)
    return rows


@query(
    "p12_with_month",
    "SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m') AS INTEGER) AS partition_date FROM orders",
)
def p12(spark, sf_dir):
    return p.with_month(table(spark, sf_dir, "orders"), "o_orderdate").select("o_orderkey", "partition_date")


@query(
    "p13_with_day",
    "SELECT event_id, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS partition_date FROM events",
)
def p13(spark, sf_dir):
    return p.with_day(table(spark, sf_dir, "events"), "ts").select("event_id", "partition_date")


@query(
    "p14_end_day",
    with_feeds("ods_daily") + "SELECT * FROM ods_daily WHERE partition_date BETWEEN 19980501 AND 19980531",
)
def p14(spark, sf_dir):
    return ods_daily(spark, sf_dir).where(
        F.col("partition_date").between(19980501, end_day(datetime(1998, 6, 1)))
    )


@query(
    "p15_align_schema",
    """SELECT CAST(s_suppkey AS VARCHAR) AS S_SUPPKEY, CAST(NULL AS INTEGER) AS s_region, s_name, s_nationkey, s_acctbal
    FROM supplier""",
)
def p15(spark, sf_dir):
    return p.align_schema(
        table(spark, sf_dir, "supplier"), {"S_SUPPKEY": "string", "s_region": "int", "s_name": "string"}
    )


@query(
    "p16_scrub_delimiters",
    """SELECT doc_id, replace(replace(replace(text, chr(10), ' '), chr(13), ' '), chr(1), ' ') AS text, lang
    FROM documents""",
)
def p16(spark, sf_dir):
    return text.scrub_delimiters(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


@query(
    "p17_null_markers",
    """SELECT doc_id, lang, coalesce(CAST(quality AS VARCHAR), '\\N') AS encoded, quality AS decoded
    FROM documents LEFT JOIN labels USING (doc_id)""",
)
def p17(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang").join(labels, "doc_id", "left")
    marked = text.encode_nulls(rows)
    decoded = F.nullif("quality", F.lit("\\N")).try_cast("int").alias("decoded")
    return marked.select(F.col("doc_id").cast("bigint"), "lang", F.col("quality").alias("encoded"), decoded)


@query(
    "s1_composite_key",
    """SELECT doc_id, CASE WHEN quality IS NULL THEN NULL ELSE lang || ',' || quality END AS key
    FROM documents LEFT JOIN labels USING (doc_id)""",
)
def s1(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return rows.select("doc_id", text.composite_key("lang", "quality").alias("key"))


@query(
    "s2_key_label",
    """SELECT '[l_orderkey=' || l_orderkey || ']' || '[l_linenumber=' || l_linenumber || ']' AS label
    FROM lineitem""",
)
def s2(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(text.key_label(["l_orderkey", "l_linenumber"]).alias("label"))


@query(
    "s3_format_time",
    "SELECT o_orderkey, strftime(o_orderdate, '%Y%m') AS month, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders",
)
def s3(spark, sf_dir):
    c = F.col("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        dates.format_time(c, "yyyyMM").alias("month"),
        dates.format_time(c, "yyyy-MM-dd").alias("day"),
    )


@query(
    "s4_parse_time",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE date_trunc('second', ts) END AS parsed FROM events""",
)
def s4(spark, sf_dir):
    written = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    written = F.when(F.col("event_type") == "error", "none").otherwise(written)
    return table(spark, sf_dir, "events").select("event_id", dates.parse_time(written).alias("parsed"))


@query("s5_audit_time", "SELECT s_suppkey, '2001-07-15 09:30:00' AS audited FROM supplier")
def s5(spark, sf_dir):
    return table(spark, sf_dir, "supplier").select("s_suppkey", dates.audit_time(AS_OF).alias("audited"))


@query(
    "s6_age_seconds",
    """SELECT event_id, CAST(epoch(TIMESTAMP '2024-02-01 00:00:00') - floor(epoch(ts)) AS BIGINT) AS age FROM events""",
)
def s6(spark, sf_dir):
    age = dates.age_seconds(F.col("ts"), datetime(2024, 2, 1))
    return table(spark, sf_dir, "events").select("event_id", age.alias("age"))


@query(
    "s7_first_non_null",
    "SELECT doc_id, coalesce(quality, toxic, -1) AS mark FROM documents LEFT JOIN labels USING (doc_id)",
)
def s7(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return rows.select("doc_id", text.first_non_null(F.col("quality"), F.col("toxic"), F.lit(-1)).alias("mark"))


@query(
    "s8_day_int",
    """SELECT o_orderkey, CAST(substring(regexp_replace(strftime(o_orderdate, '%Y-%m-%d'), '-', '', 'g'), 1, 8)
        AS INTEGER) AS day FROM orders""",
)
def s8(spark, sf_dir):
    day = dates.day_int_from_text(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return table(spark, sf_dir, "orders").select("o_orderkey", day.alias("day"))


@query(
    "s9_predicates",
    """SELECT p_partkey, p_brand LIKE 'Brand#1%' AS has_prefix, p_brand NOT LIKE 'Brand#1%' AS no_prefix,
           p_size IN (1, 2, 3) AS listed, p_size NOT IN (1, 2, 3) AS unlisted, p_type IS NULL AS absent FROM part""",
)
def s9(spark, sf_dir):
    brand, size = F.col("p_brand"), F.col("p_size")
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        text.has_prefix(brand, "Brand#1").alias("has_prefix"),
        (~brand.like("Brand#1%")).alias("no_prefix"),
        size.isin(1, 2, 3).alias("listed"),
        (~size.isin(1, 2, 3)).alias("unlisted"),
        F.col("p_type").isNull().alias("absent"),
    )


@query(
    "s10_count_if_distinct",
    """SELECT event_type, count(DISTINCT CASE WHEN value > 50 THEN user_id END) AS heavy_users FROM events
    GROUP BY event_type""",
)
def s10(spark, sf_dir):
    from tidekeep.operators.aggregates import count_if_distinct

    heavy = count_if_distinct(F.col("value") > 50, F.col("user_id"))
    return table(spark, sf_dir, "events").groupBy("event_type").agg(heavy.alias("heavy_users"))


@query(
    "s11_days_before",
    "SELECT o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '2001-07-15' - INTERVAL 60 DAY",
)
def s11(spark, sf_dir):
    rows = table(spark, sf_dir, "orders")
    return rows.where(F.to_date("o_orderdate") >= dates.days_before(AS_OF, 60)).select("o_orderkey")


@query(
    "s12_day_list",
    """SELECT conv_id, turn, strftime(unnest(generate_series(CAST(TIMESTAMP '2024-02-27' AS TIMESTAMP),
        TIMESTAMP '2024-02-27' + to_days(CAST(turn AS INTEGER)), INTERVAL 1 DAY)), '%Y%m%d') AS day FROM conversations""",
)
def s12(spark, sf_dir):
    first = F.lit("2024-02-27").cast("date")
    days = dates.day_list(first, F.date_add(first, F.col("turn").cast("int")))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.explode(days).alias("day"))


@query(
    "s13_months_before_end",
    """SELECT o_orderkey, month FROM (SELECT o_orderkey, strftime(unnest(generate_series(
        date_trunc('month', o_orderdate), TIMESTAMP '1997-01-31', INTERVAL 1 MONTH)), '%Y%m') AS month
        FROM orders) WHERE month < '199701'""",
)
def s13(spark, sf_dir):
    months = dates.months_before_end(F.col("o_orderdate"), F.lit("1997-01-31").cast("timestamp_ntz"))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.explode(months).alias("month"))


@query(
    "s14_shift_date",
    """SELECT event_id, ts + INTERVAL 1 DAY AS next_day, ts - INTERVAL 3 DAY AS wanted_day, ts - INTERVAL 5 HOUR AS earlier,
        ts + INTERVAL 1 MONTH AS next_month, date_trunc('day', ts) + INTERVAL 1 DAY AS next_day_begin,
        date_trunc('month', ts) + INTERVAL 1 MONTH AS next_month_begin, date_trunc('day', ts) - INTERVAL 1 DAY AS last_day_begin,
        CAST(date_trunc('day', ts) AS TIMESTAMP) AS today_begin FROM events""",
)
def s14(spark, sf_dir):
    ts = F.col("ts")
    return table(spark, sf_dir, "events").select(
        "event_id",
        dates.shift_date(ts, 1, "day").alias("next_day"),
        dates.shift_date(ts, -3, "day").alias("wanted_day"),
        dates.shift_date(ts, -5, "hour").alias("earlier"),
        dates.shift_date(ts, 1, "month").alias("next_month"),
        dates.begin_of(ts, "day", 1).alias("next_day_begin"),
        dates.begin_of(ts, "month", 1).alias("next_month_begin"),
        dates.begin_of(ts, "day", -1).alias("last_day_begin"),
        dates.begin_of(ts, "day").alias("today_begin"),
    )


@query(
    "s15_days_between",
    "SELECT event_id, CAST(date_diff('day', CAST(ts AS DATE), DATE '2024-02-01') AS INTEGER) AS days FROM events",
)
def s15(spark, sf_dir):
    days = dates.days_between(F.col("ts"), F.lit("2024-02-01").cast("date"))
    return table(spark, sf_dir, "events").select("event_id", days.alias("days"))


@query(
    "s16_count_matches",
    """SELECT doc_id, CAST(len(regexp_extract_all(text, '(?i)the')) AS INTEGER) AS any_case,
        CAST(len(regexp_extract_all(text, 'The')) AS INTEGER) AS exact_case FROM documents""",
)
def s16(spark, sf_dir):
    body = F.col("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        text.count_matches(body, "the").alias("any_case"),
        text.count_matches(body, "The", ignore_case=False).alias("exact_case"),
    )


@query(
    "s17_unescape",
    "SELECT page_id, replace(replace(replace(html, '&lt;', '<'), '&gt;', '>'), '&eq;', '=') AS html FROM pages",
)
def s17(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.unescape(F.col("html")).alias("html"))


@query(
    "s18_threshold_text",
    "SELECT p_partkey, printf('[%.2f , %.2f]', p_retailprice - p_size, p_retailprice + p_size) AS threshold FROM part",
)
def s18(spark, sf_dir):
    price, size = F.col("p_retailprice"), F.col("p_size")
    label = text.threshold_text(price - size, price + size)
    return table(spark, sf_dir, "part").select("p_partkey", label.alias("threshold"))


@query(
    "s19_strip_suffix",
    """SELECT event_id, event_type || CASE WHEN value > 50 THEN '_his' ELSE '' END AS table_name, event_type AS plain
    FROM events""",
)
def s19(spark, sf_dir):
    task = F.concat("event_type", F.when(F.col("value") > 50, "_his_yg_thl").otherwise("_thl"))
    rows = table(spark, sf_dir, "events").select("event_id", p.table_of_task(task).alias("table_name"))
    return rows.withColumn("plain", text.strip_suffix(F.col("table_name"), ["_his"]))


SOURCE_TYPES = {
    "l_orderkey": "bigint(20)",
    "l_linenumber": "tinyint(3)",
    "l_extendedprice": "double",
    "l_discount": "float(5,2)",
    "l_tax": "decimal(9,3)",
    "l_returnflag": "varchar(32)",
    "l_shipdate": "datetime",
}
ORACLE_TYPES = {**SOURCE_TYPES, "l_linenumber": "number(10)", "l_discount": "number(12,2)", "l_shipdate": "date"}


def _as_read(df):
    """Decimals as text, so both engines' results compare digit by digit."""
    return df.select(*[F.col(n).cast("string") if t.startswith("decimal") else F.col(n) for n, t in df.dtypes])


@query(
    "s20_cast_types_mysql",
    """SELECT l_orderkey, l_linenumber, CAST(CAST(l_extendedprice AS DECIMAL(17,4)) AS VARCHAR) AS l_extendedprice,
        CAST(CAST(l_discount AS DECIMAL(17,4)) AS VARCHAR) AS l_discount,
        CAST(CAST(l_tax AS DECIMAL(9,3)) AS VARCHAR) AS l_tax, l_returnflag,
        strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate FROM lineitem""",
)
def s20(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(*SOURCE_TYPES)
    return _as_read(types.cast_types(rows, SOURCE_TYPES, "mysql"))


@query(
    "s21_cast_types_oracle",
    """SELECT l_orderkey, CAST(CAST(l_linenumber AS DECIMAL(10,0)) AS VARCHAR) AS l_linenumber,
        CAST(CAST(l_extendedprice AS DECIMAL(17,4)) AS VARCHAR) AS l_extendedprice,
        CAST(CAST(l_discount AS DECIMAL(12,2)) AS VARCHAR) AS l_discount,
        CAST(CAST(l_tax AS DECIMAL(9,3)) AS VARCHAR) AS l_tax, l_returnflag, l_shipdate FROM lineitem""",
)
def s21(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(*ORACLE_TYPES)
    out = _as_read(types.cast_types(rows, ORACLE_TYPES, "oracle"))
    return out.withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp_ntz"))


@query(
    "s22_cast_report_types_mysql",
    """SELECT l_orderkey, CAST(l_linenumber AS SMALLINT) AS l_linenumber,
        CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS VARCHAR) AS l_extendedprice,
        CAST(CAST(l_discount AS DECIMAL(5,2)) AS VARCHAR) AS l_discount,
        CAST(CAST(l_tax AS DECIMAL(9,3)) AS VARCHAR) AS l_tax, l_returnflag, l_shipdate FROM lineitem""",
)
def s22(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(*SOURCE_TYPES)
    return _as_read(types.cast_report_types(rows, SOURCE_TYPES, "mysql"))


@query(
    "s23_cast_report_types_oracle",
    """SELECT l_orderkey, CAST(CAST(l_linenumber AS DECIMAL(10,0)) AS VARCHAR) AS l_linenumber,
        CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS VARCHAR) AS l_extendedprice,
        CAST(CAST(l_discount AS DECIMAL(12,2)) AS VARCHAR) AS l_discount,
        CAST(CAST(l_tax AS DECIMAL(9,3)) AS VARCHAR) AS l_tax, l_returnflag, l_shipdate FROM lineitem""",
)
def s23(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(*ORACLE_TYPES)
    return _as_read(types.cast_report_types(rows, ORACLE_TYPES, "oracle"))
