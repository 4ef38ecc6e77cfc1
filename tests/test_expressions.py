from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidekeep import TaskConfig
from tidekeep.functions import dates, text, types
from tidekeep.operators import project
from tidekeep.sources import extract, jdbc


@pytest.mark.parametrize(
    ("source", "database", "expected"),
    [
        ("VARCHAR(20)", "mysql", "string"),
        ("date", "mysql", "date"),
        ("datetime", "mysql", "string"),
        ("bigint(20)", "mysql", "bigint"),
        ("tinyint(1)", "mysql", "int"),
        ("varbinary(9)", "mysql", "string"),
        ("mediumblob", "mysql", "binary"),
        ("float", "mysql", "decimal(17,4)"),
        ("decimal(12,2)", "mysql", "decimal(12,2)"),
        ("DATE", "oracle", "timestamp"),
        ("NUMBER(10)", "oracle", "decimal(10)"),
        ("NUMBER(12,2)", "oracle", "decimal(12,2)"),
        ("NUMBER", "oracle", "decimal(38,18)"),
        ("timestamp(6)", "oracle", "string"),
    ],
)
def test_warehouse_types(source, database, expected):
    assert types.warehouse_type(source, database) == expected


@pytest.mark.parametrize(
    ("source", "database", "expected"),
    [
        ("datetime", "mysql", "timestamp"),
        ("date", "mysql", "date"),
        ("date", "oracle", "timestamp"),
        ("double", "mysql", "numeric(15,2)"),
        ("float(5,2)", "mysql", "numeric(5,2)"),
        ("time", "mysql", "time"),
        ("smallint", "mysql", "int2"),
        ("tinyint(4)", "mysql", "int2"),
        ("bigint", "mysql", "int8"),
        ("int(11)", "mysql", "int4"),
        ("longblob", "mysql", "bytea"),
        ("decimal(9,3)", "mysql", "numeric(9,3)"),
        ("number", "oracle", "decimal"),
        ("varbinary(3)", "oracle", "text"),
    ],
)
def test_report_types(source, database, expected):
    assert types.report_type(source, database) == expected


def test_unknown_types_are_refused():
    with pytest.raises(ValueError):
        types.warehouse_type("geometry", "mysql")


def test_report_column_list():
    assert types.report_column_types({"a": "int", "b": "datetime"}, "mysql") == "a int4, b timestamp"


def _one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def _ts(value):
    return F.lit(value).cast("timestamp_ntz")


def test_month_steps_clamp(spark):
    assert _one(spark, dates.shift_date(_ts("2024-01-31 05:00:00"), 1, "month")) == datetime(2024, 2, 29, 5)
    assert _one(spark, dates.begin_of(_ts("2024-12-15 05:00:00"), "month", 1)) == datetime(2025, 1, 1)


def test_lists(spark):
    assert _one(spark, dates.day_list(_ts("2024-02-28"), _ts("2024-03-01"))) == ["20240228", "20240229", "20240301"]
    assert _one(spark, dates.day_list(_ts("2024-02-28"), _ts("2024-02-28"))) == ["20240228"]
    assert _one(spark, dates.day_list(_ts("2024-02-28"), _ts("2024-01-01"))) == ["20240101"]
    assert _one(spark, dates.months_before_end(_ts("2023-11-30"), _ts("2024-01-01"))) == ["202311", "202312"]
    assert _one(spark, dates.months_before_end(_ts("2024-01-01"), _ts("2024-01-31"))) == []
    assert _one(spark, dates.months_before_end(_ts("2024-03-01"), _ts("2024-01-31"))) == []


def test_text_helpers(spark):
    assert _one(spark, text.unescape(F.lit("a &lt; b &gt; c &eq; &amp;"))) == "a < b > c = &amp;"
    assert _one(spark, text.count_matches(F.lit("aAa"), "a")) == 3
    assert _one(spark, text.count_matches(F.lit("aAa"), "a", ignore_case=False)) == 2
    assert _one(spark, text.strip_suffix(F.lit("t_yg_thl"), project.LOG_SUFFIXES)) == "t"
    assert _one(spark, text.strip_suffix(F.lit("t_thl_x"), project.LOG_SUFFIXES)) == "t_thl_x"
    assert _one(spark, text.composite_key(F.lit(1), F.lit(None), F.lit("a"))) is None
    assert _one(spark, text.threshold_text(F.lit(-1.005), F.lit(2.0))) in ("[-1.01 , 2.00]", "[-1.00 , 2.00]")


def test_not_in_drops_nulls_and_sentinel_rules_differ(spark):
    df = spark.createDataFrame([(1, None), (2, "999999"), (3, "2024")], "k int, ods_update_time string")
    assert rows(project.drop_sentinels(df), "k") == [(1,), (3,)]
    assert rows(project.export_filter(df), "k") == [(3,)]
    assert rows(project.exclude_status(df, "ods_update_time", ["2024"]), "k") == [(2,)]


def test_filters_may_start_with_and(spark):
    df = spark.range(10)
    assert rows(project.apply_filters(df, ["and id > 2", " AND id < 6 ", "id <> 4 and id <> 3"])) == [(5,)]
    assert project.apply_filters(df, []).count() == 10
    assert rows(project.apply_filters(df, ["and t2.id = 3"], project.EXPORT_ALIAS)) == [(3,)]
    assert project.project(df, ["src_t.id", "src_t.id + 1 as next"], project.CLEAN_ALIAS).columns == ["id", "next"]


def test_align_schema_is_additive_and_ignores_case(spark):
    df = spark.createDataFrame([(1, 2, 3)], "B int, new int, a int")
    out = project.align_schema(df, {"a": "bigint", "b": "int", "c": "string"})
    assert out.dtypes == [("a", "bigint"), ("b", "int"), ("c", "string"), ("new", "int")]
    assert rows(out) == [(3, 1, None, 2)]


BEGIN = datetime(2024, 1, 1, 6)


def test_windows_are_half_open(spark):
    times = [BEGIN - timedelta(microseconds=1), BEGIN, BEGIN + timedelta(days=1)]
    df = spark.createDataFrame([(t,) for t in times], "at timestamp_ntz")
    cfg = TaskConfig(select_columns=("at",), sync_time_column="at")
    assert rows(extract.extract_incremental(df, cfg, BEGIN, BEGIN + timedelta(days=1))) == [(BEGIN,)]


def test_text_window_inside_a_day_means_that_day(spark):
    df = spark.createDataFrame([("20231231",), ("20240101",), ("20240102",), (None,)], "day string")
    cfg = TaskConfig(select_columns=("day",), sync_time_column="day", time_type="str")
    assert rows(extract.extract_incremental(df, cfg, BEGIN, BEGIN + timedelta(hours=1))) == [("20240101",)]
    assert rows(extract.extract_incremental(df, cfg, BEGIN, BEGIN + timedelta(days=1))) == [("20240101",)]


def test_extract_needs_columns_and_a_known_time_type(spark):
    df = spark.createDataFrame([(BEGIN,)], "at timestamp_ntz")
    with pytest.raises(ValueError):
        extract.extract_full(df, TaskConfig())
    with pytest.raises(ValueError):
        extract.extract_incremental(df, TaskConfig(select_columns=("at",)), BEGIN, BEGIN + timedelta(hours=1))
    odd = TaskConfig(select_columns=("at",), sync_time_column="at", time_type="blob")
    with pytest.raises(ValueError):
        extract.extract_incremental(df, odd, BEGIN, BEGIN + timedelta(hours=1))


def test_history_only_on_flagged_days(spark):
    df = spark.createDataFrame([(BEGIN, 1), (BEGIN, 9)], "at timestamp_ntz, v int")
    cfg = TaskConfig(select_columns=("v",), sync_time_column="at", filters=("v < 5",))
    end = BEGIN + timedelta(hours=1)
    assert rows(extract.extract_with_history(df, df, cfg, set(), BEGIN, end)) == [(1,)]
    assert rows(extract.extract_with_history(df, df, cfg, {20240101}, BEGIN, end)) == [(1,), (1,), (9,)]


def test_sliced_read_of_one_instant(spark):
    df = spark.createDataFrame([(BEGIN, 1)], "at timestamp_ntz, v int")
    cfg = TaskConfig(select_columns=("v",), sync_time_column="at")
    assert rows(extract.extract_partitioned(df, cfg, BEGIN, BEGIN + timedelta(1), 4)) == [(1, 0)]
    assert rows(extract.extract_partitioned(df.limit(0), cfg, BEGIN, BEGIN + timedelta(1), 4)) == []


def test_window_filter_reaches_the_scan(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    cfg = TaskConfig(select_columns=("event_id",), sync_time_column="ts")
    plan = extract.extract_incremental(events, cfg, BEGIN, BEGIN + timedelta(1))._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(ts,2024-01-01T06:00)" in plan and "LessThan(ts,2024-01-02T06:00)" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan


def test_jdbc_slices_cover_the_range_once():
    lo, hi = datetime(2024, 1, 1), datetime(2024, 1, 4)
    cuts = jdbc.slice_bounds(lo, hi, 3)
    assert cuts == ["2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-03 00:00:00", "2024-01-04 00:00:00"]
    assert jdbc.slice_predicates("at", cuts) == [
        "at >= '2024-01-01 00:00:00' AND at < '2024-01-02 00:00:00'",
        "at >= '2024-01-02 00:00:00' AND at < '2024-01-03 00:00:00'",
        "at >= '2024-01-03 00:00:00' AND at <= '2024-01-04 00:00:00'",
    ]
    with pytest.raises(ValueError):
        jdbc.slice_bounds(lo, hi, 0)


class Recorder:
    """Stands in for a session: notes how Spark's JDBC reader is called."""

    def __init__(self):
        self.calls = []

    @property
    def read(self):
        return self

    def jdbc(self, url, table, **options):
        self.calls.append((url, table, options))
        return self


def test_jdbc_reader_options():
    spark = Recorder()
    jdbc.read_jdbc(spark, "jdbc:x", "t", {"fetchsize": "9"}, {"a": "string", "b": "decimal(9,2)"})
    assert spark.calls == [("jdbc:x", "t", {"properties": {"fetchsize": "9", "customSchema": "a string, b decimal(9,2)"}})]


def test_jdbc_sliced_reader_uses_one_predicate_per_reader():
    spark = Recorder()
    jdbc.read_jdbc_sliced(spark, "jdbc:x", "t", "at", datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 0, 1, 500000), 2)
    assert spark.calls[0][2]["predicates"] == [
        "at >= '2024-01-01 00:00:00' AND at < '2024-01-01 00:00:00.750000'",
        "at >= '2024-01-01 00:00:00.750000' AND at <= '2024-01-01 00:00:01.500000'",
    ]


def test_jdbc_literals_follow_type_and_database():
    moment = datetime(2024, 1, 1, 2)
    assert jdbc.literal(moment, "oracle") == "TO_TIMESTAMP('2024-01-01 02:00:00.000000', 'YYYY-MM-DD HH24:MI:SS.FF6')"
    assert jdbc.literal(moment, "db2") == "TIMESTAMP('2024-01-01 02:00:00')"
    assert jdbc.literal(moment.date(), "oracle") == "TO_DATE('2024-01-01', 'YYYY-MM-DD')"
    assert jdbc.literal(7, "oracle") == "7" and jdbc.literal("o'x") == "'o''x'"
    assert jdbc.dialect_of("jdbc:oracle:thin:@h") == "oracle" and jdbc.dialect_of("jdbc:unheard:x") == "mysql"


@pytest.mark.parametrize(
    ("lo", "hi", "n", "kind", "cuts"),
    [
        ("20240101", "20240109", 4, "str", ["20240101", "20240103", "20240105", "20240107", "20240109"]),
        ("20240130", "20240201", 2, "str", ["20240130", "20240131", "20240201"]),
        ("20240101", "20240102", 5, "str", ["20240101", "20240102"]),
        (0, 10, 3, "timestamp", [0, 3, 6, 10]),
        (5, 6, 9, "timestamp", [5, 6]),
    ],
)
def test_slices_of_texts_and_numbers(lo, hi, n, kind, cuts):
    assert jdbc.slice_bounds(lo, hi, n, kind) == cuts
    held = [eval(p.replace("c ", "v ").replace("AND", "and")) for v in cuts for p in jdbc.slice_predicates("c", cuts)]
    assert sum(held) == len(cuts), "every boundary is read once"


class Database:
    """Stands in for a session whose JDBC reader finds frames by name, and notes the predicates it was given."""

    def __init__(self, tables):
        self.tables, self.calls = tables, []

    @property
    def read(self):
        return self

    def jdbc(self, url, table, properties=None, predicates=None):
        self.calls.append((table, predicates))
        df = self.tables[table]
        if predicates is None:
            return df
        parts = [df.where(p) for p in predicates]
        out = parts[0]
        for part in parts[1:]:
            out = out.union(part)
        return out


def test_a_window_of_text_time_is_read_in_slices(spark):
    df = spark.createDataFrame([(i, f"2024010{1 + i % 2}") for i in range(10)], "v int, day string")
    base = Database({"t": df})
    cfg = TaskConfig(select_columns=("v",), sync_time_column="day", time_type="str", filters=("v < 9",))
    out = jdbc.extract_jdbc_sliced(base, "jdbc:oracle:x", "t", cfg, datetime(2024, 1, 1), datetime(2024, 1, 2), 4)
    assert sorted(r[0] for r in out.collect()) == [0, 2, 4, 6, 8]
    two = TaskConfig(select_columns=("v",), sync_time_column="day", time_type="str")
    out = jdbc.extract_jdbc_sliced(base, "jdbc:oracle:x", "t", two, datetime(2024, 1, 1), datetime(2024, 1, 2), 4, split_column="v")
    assert sorted(r[0] for r in out.collect()) == [0, 2, 4, 6, 8]
    assert base.calls[-1] == ("t", ["v >= 0 AND v < 2", "v >= 2 AND v < 4", "v >= 4 AND v < 6", "v >= 6 AND v <= 8"])


def test_a_window_with_history_is_read_by_one_reader(spark):
    kind = "v int, at timestamp_ntz"
    day = datetime(2024, 1, 1)
    live = spark.createDataFrame([(1, day), (2, day + timedelta(hours=3))], kind)
    moved = spark.createDataFrame([(3, day + timedelta(hours=1))], kind)
    cfg = TaskConfig(select_columns=("v",), sync_time_column="at")
    for flagged, expected, sliced in (((), [1, 2], True), ((20240101,), [1, 2, 3], False)):
        base = Database({"t": live, "t_his": moved})
        out = jdbc.extract_jdbc_sliced(
            base, "jdbc:mysql:x", "t", cfg, day, day + timedelta(days=1), 2, history_table="t_his", flagged_days=flagged
        )
        assert sorted(r[0] for r in out.collect()) == expected
        assert any(p for _, p in base.calls) == sliced
    split = extract.extract_partitioned(live, cfg, day, day + timedelta(days=1), 2)
    assert sorted(map(tuple, split.collect())) == [(1, 0), (2, 1)]
    whole = extract.extract_partitioned(live, cfg, day, day + timedelta(days=1), 2, moved, [20240101])
    assert sorted(map(tuple, whole.collect())) == [(1, 0), (2, 0), (3, 0)]


def test_the_writer_limits_connections_and_not_the_tasks_before_it():
    class Frame:
        def __init__(self):
            self.calls = []

        @property
        def write(self):
            return self

        def __getattr__(self, name):
            def call(*args, **named):
                self.calls.append((name, *args))
                return self

            return call

    df = Frame()
    jdbc.write_jdbc(df, "jdbc:x", "t", 5, column_types="v int")
    assert [c for c in df.calls if c[0] != "jdbc"] == [
        ("hint", "rebalance"), ("mode", "overwrite"), ("option", "truncate", "true"), ("option", "numPartitions", "5"),
        ("option", "createTableColumnTypes", "v int"),
    ]
    assert not any(c[0] in ("repartition", "coalesce") for c in df.calls)


def test_task_suffixes_are_a_setting(spark):
    df = spark.createDataFrame([("r", "orders", 1), ("r", "orders_thl", 2)], "db_name string, table_name string, v int")
    assert [r["v"] for r in project.route(df, "r", "orders-log", ("-log",)).collect()] == [1]
    assert [r["v"] for r in project.route(df, "r", "orders_thl", ()).collect()] == [2]
    assert _one(spark, project.table_of_task(F.lit("a-log"), ("-log", "-x"))) == "a"


def test_number_types_that_spark_cannot_declare():
    assert types.warehouse_type("number(5,-2)", "oracle") == "decimal(7,0)"
    assert types.warehouse_type("number(2,5)", "oracle") == "decimal(5,5)"
    assert types.warehouse_type("number(9,2)", "oracle") == "decimal(9,2)"
