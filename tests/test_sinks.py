from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidekeep.functions.text import encode_nulls
from tidekeep.session import scratch_path, scratch_root
from tidekeep.sinks import tables as sink
from tidekeep.sinks.files import DataFile, FileTree, Swap, recover, staging_path
from tidekeep.sources.scans import read_landing, read_table

PARTS = "v int, partition_date int"


@pytest.fixture
def table(spark):
    path = scratch_path(spark, "table")
    data = [(1, 202401), (2, 202402), (3, 202403), (4, 202404)]
    sink.append_partitions(spark.createDataFrame(data, PARTS), path)
    return path


def test_emptied_month_is_cleared_and_others_stay(spark, table):
    sink.overwrite_month_range(spark.createDataFrame([(9, 202402)], PARTS), table, 202402, 202403)
    assert rows(read_table(spark, table)) == [(1, 202401), (4, 202404), (9, 202402)]


def test_plain_dynamic_overwrite_leaves_absent_partitions(spark, table):
    sink.overwrite_partitions(spark.createDataFrame([(9, 202402)], PARTS), table)
    assert rows(read_table(spark, table)) == [(1, 202401), (3, 202403), (4, 202404), (9, 202402)]


@pytest.mark.parametrize(
    ("beyond", "april"), [("replace", [(8, 202404)]), ("append", [(4, 202404), (8, 202404)])]
)
def test_rows_beyond_the_range(spark, table, beyond, april):
    df = spark.createDataFrame([(9, 202402), (8, 202404)], PARTS)
    sink.overwrite_month_range(df, table, 202402, 202403, beyond=beyond)
    assert rows(read_table(spark, table).where("partition_date = 202404")) == april


def test_rows_beyond_the_range_can_be_refused(spark, table):
    df = spark.createDataFrame([(8, 202404)], PARTS)
    with pytest.raises(ValueError):
        sink.replace_partitions(df, table, [202402], beyond="refuse")
    assert read_table(spark, table).count() == 4


def test_a_table_can_be_rewritten_from_itself(spark, table):
    grown = read_table(spark, table).withColumn("v", F.col("v") * 10)
    sink.write_full(grown, table, "partition_date")
    assert rows(read_table(spark, table), "v") == [(10,), (20,), (30,), (40,)]


def test_failed_swap_puts_the_old_data_back(spark, table):
    tree = FileTree(spark)
    with pytest.raises(OSError), Swap(tree, table) as swap:
        swap.take_out(f"{table}/partition_date=202401")
        swap.put_in(f"{table}/missing", f"{table}/partition_date=202401")
    assert rows(read_table(spark, table)) == [(1, 202401), (2, 202402), (3, 202403), (4, 202404)]
    assert tree.names(table.rpartition("/")[0]) == ["data"], "nothing may be left beside the table"


def test_a_run_that_died_is_undone_by_the_next(spark, table):
    tree = FileTree(spark)
    swap = Swap(tree, table)
    swap.take_out(f"{table}/partition_date=202401")
    swap.take_out(f"{table}/partition_date=202402")
    new = spark.createDataFrame([(22,)], "v int")
    new.write.parquet(f"{table}/partition_date=202402")
    new.write.parquet(staging_path(table))
    new.write.parquet(f"{table}-more")
    swap.put_in(f"{table}-more", f"{table}/partition_date=202409")
    recover(tree, table)
    assert rows(read_table(spark, table)) == [(1, 202401), (2, 202402), (3, 202403), (4, 202404)]
    Swap(tree, table).take_out(table)
    recover(tree, table)
    assert rows(read_table(spark, table), "v") == [(1,), (2,), (3,), (4,)]
    assert tree.names(table.rpartition("/")[0]) == ["data"]


SINKS = {
    "replace": lambda df, path: sink.replace_partitions(df, path, [202402]),
    "full": lambda df, path: sink.write_full(df, path, "partition_date"),
    "day": lambda df, path: sink.write_day(df.drop("partition_date"), path, 202402),
    "drop": lambda df, path: sink.drop_month_range(df.sparkSession, path, 202402, 202402),
    "export": lambda df, path: sink.export_rows(df, path, 2),
}


@pytest.mark.parametrize("name", list(SINKS))
def test_every_sink_first_undoes_a_run_that_died(spark, table, name):
    tree = FileTree(spark)
    dead = Swap(tree, table)
    dead.take_out(f"{table}/partition_date=202401")
    SINKS[name](spark.createDataFrame([(7, 202402)], PARTS), table)
    assert tree.names(table.rpartition("/")[0]) == ["data"]
    if name in ("replace", "day", "drop"):
        assert (1, 202401) in rows(read_table(spark, table))


def test_compaction_leaves_good_partitions_alone(spark):
    path = scratch_path(spark, "mixed")
    for i in range(3):
        sink.append_partitions(spark.createDataFrame([(i, 1)], PARTS), path)
    sink.append_partitions(spark.createDataFrame([(9, 2)], PARTS), path)
    tree = FileTree(spark)
    before = tree.names(f"{path}/partition_date=2")
    assert sink.compact(spark, path) and not sink.compact(spark, path)
    assert tree.names(f"{path}/partition_date=2") == before and len(tree.sizes(f"{path}/partition_date=1")) == 1
    assert read_table(spark, path).count() == 4


def test_failed_job_leaves_the_table_alone(spark, table):
    bad = read_table(spark, table).withColumn("v", F.raise_error(F.lit("broken")).cast("int"))
    with pytest.raises(Exception, match="broken"):
        sink.overwrite_month_range(bad, table, 202401, 202404)
    assert read_table(spark, table).count() == 4


def test_reloading_a_day_without_rows_clears_it(spark, table):
    sink.write_day(spark.createDataFrame([], "v int"), table, 202402)
    assert rows(read_table(spark, table), "v") == [(1,), (3,), (4,)]


def test_drop_month_range(spark, table):
    sink.drop_month_range(spark, table, 202312, 202402)
    assert rows(read_table(spark, table), "v") == [(3,), (4,)]


ODD = [
    (1, "plain", 1.5, datetime(2024, 1, 1, 2, 3, 4), True),
    (2, "", None, None, None),
    (3, None, -0.25, datetime(1999, 12, 31), False),
    (4, 'quote " comma , back\\slash \\n', 2.0, None, None),
    (5, "line\nbreak\rand\u0001field", 3.0, None, None),
    (6, "NULL", 3.0, None, None),
]
ODD_SCHEMA = "id int, s string, d double, t timestamp_ntz, b boolean"


def test_landing_round_trip(spark):
    df = spark.createDataFrame(ODD, ODD_SCHEMA)
    path = scratch_path(spark, "odd")
    sink.write_landing(df, path)
    expected = [r if r[0] != 5 else (5, "line break and field", 3.0, None, None) for r in ODD]
    assert rows(read_landing(spark, path, df.schema)) == sorted(expected, key=repr)


def test_landing_is_lenient_like_the_text_tables_it_replaces(spark):
    path = scratch_path(spark, "lenient")
    lines = [("1\u0001x\u00011.5",), ("nope\u0001y",), ("3\u0001z\u00012\u0001extra",)]
    spark.createDataFrame(lines, "value string").write.text(path)
    schema = spark.createDataFrame([], "id int, s string, d double").schema
    assert rows(read_landing(spark, path, schema)) == [(1, "x", 1.5), (3, "z", 2.0), (None, "y", None)]


def test_partitioned_landing(spark):
    df = spark.createDataFrame([(1, None, 20240101), (2, "b", 20240102)], "k int, s string, partition_date int")
    path, columnar = scratch_path(spark, "landed"), scratch_path(spark, "columnar")
    sink.write_landing(df, path, "partition_date")
    assert rows(read_landing(spark, path, df.schema)) == [(1, None, 20240101), (2, "b", 20240102)]
    sink.landing_to_parquet(spark, path, columnar, df.schema)
    assert rows(read_table(spark, columnar), "k", "partition_date") == [(1, 20240101), (2, 20240102)]


def test_encode_nulls_marks_every_type(spark):
    df = spark.createDataFrame([(None, None, 1)], "a string, b timestamp, c int")
    assert rows(encode_nulls(df)) == [("\\N", "\\N", "1")]


def test_upsert_replaces_and_adds(spark):
    target = spark.createDataFrame([("g", "a", 1), ("g", "b", 2)], "g string, t string, n int")
    changes = spark.createDataFrame([("g", "b", 9), ("g", "c", 3)], "g string, t string, n int")
    assert rows(sink.upsert(target, changes, ["g", "t"])) == [("g", "a", 1), ("g", "b", 9), ("g", "c", 3)]


def test_compaction_merges_small_files_and_skips_short_lived_tables(spark):
    path = scratch_path(spark, "many")
    for i in range(5):
        sink.append_partitions(spark.createDataFrame([(i, 1)], PARTS), path)
    assert sink.compact(spark, path)
    files = [n for n in FileTree(spark).names(f"{path}/partition_date=1") if n.endswith(".parquet")]
    assert len(files) == 1 and read_table(spark, path).count() == 5
    assert not sink.compact(spark, "/nowhere/orders_tmp")


def test_replication_keeps_what_it_was_not_asked_to_copy(spark, table):
    copy = scratch_path(spark, "copy")
    sink.replicate_partitions(spark, table, copy, [202401, 202402, 209901])
    before = sorted(n for n in FileTree(spark).names(copy) if "=" in n)
    assert before == ["partition_date=202401", "partition_date=202402"]
    sink.replicate_partitions(spark, table, copy, [202402, 202403])
    after = sorted(n for n in FileTree(spark).names(copy) if "=" in n)
    assert after == [*before, "partition_date=202403"]
    sink.replicate_partitions(spark, table, copy)
    assert rows(read_table(spark, copy)) == rows(read_table(spark, table))


def test_scratch_needs_a_shared_folder_on_a_cluster(spark):
    class Cluster:
        class conf:
            @staticmethod
            def get(key, default):
                return default

        class sparkContext:
            master = "yarn"

    with pytest.raises(RuntimeError):
        scratch_root(Cluster)


# ---- compaction from the listing


def _folders(spark, path):
    found = {}
    for f in FileTree(spark).data_files(path):
        found.setdefault(f.folder, []).append(f.name)
    return found


@pytest.mark.parametrize("values", [["01", "02", "1"], ["a:b", "a/b", "50%", None], ["2024-01-01", "x=y", " "]])
def test_compaction_keeps_every_partition_whatever_its_name(spark, values):
    path = scratch_path(spark, "odd_names")
    data = [(i, v) for i, v in enumerate(values)]
    for k in range(3):
        sink.append_partitions(spark.createDataFrame([(10 * k + i, v) for i, v in data], "v int, p string"), path, "p")
    schema = spark.createDataFrame([], "v int, p string").schema
    before, names = rows(read_table(spark, path, schema=schema)), set(_folders(spark, path))
    assert sink.compact(spark, path)
    assert rows(read_table(spark, path, schema=schema)) == before and len(before) == 3 * len(values)
    after = _folders(spark, path)
    assert set(after) == names and all(len(own) == 1 for own in after.values())
    assert not sink.compact(spark, path)


def test_compaction_of_nested_partitions_and_of_grown_schemas(spark):
    path = scratch_path(spark, "nested")
    for k in range(2):
        df = spark.createDataFrame([(k, "crm", 20240101), (k, "crm", 20240102)], "v int, db string, partition_date int")
        if k:
            df = df.withColumn("added", F.lit("new"))
        df.write.mode("append").partitionBy("db", "partition_date").parquet(path)
    assert sink.compact(spark, path)
    assert {len(n) for n in _folders(spark, path).values()} == {1}
    table = spark.read.option("mergeSchema", "true").parquet(path)
    assert rows(table, "v", "added", "partition_date") == [
        (0, None, 20240101), (0, None, 20240102), (1, "new", 20240101), (1, "new", 20240102)
    ]


def test_compaction_plan_packs_by_bytes():
    files = [DataFile("p=1", f"f{i}", size, 0) for i, size in enumerate((60, 50, 40, 30, 20))]
    files += [DataFile("p=2", "big", 500, 0), DataFile("p=2", "small", 1, 0), DataFile("p=3", "alone", 1, 0)]
    packs = sink.compaction_plan(files, small=100, target=100)
    assert [[f.name for f in p] for p in packs] == [["f0", "f2"], ["f1", "f3", "f4"]]
    assert sink.compaction_plan([DataFile("", "a", 1, 0), DataFile("", "b", 1, 0)], 100, 100) == [
        [DataFile("", "a", 1, 0), DataFile("", "b", 1, 0)]
    ]


def test_a_failed_compaction_changes_nothing(spark, monkeypatch):
    path = scratch_path(spark, "refused")
    for i in range(3):
        sink.append_partitions(spark.createDataFrame([(i, 1)], PARTS), path)
    before = _folders(spark, path)
    monkeypatch.setattr(FileTree, "move", lambda *a: (_ for _ in ()).throw(OSError("no")))
    with pytest.raises(OSError):
        sink.compact(spark, path)
    monkeypatch.undo()
    recover(FileTree(spark), path)
    assert _folders(spark, path) == before and read_table(spark, path).count() == 3


def test_replacing_a_partition_that_is_spelled_otherwise(spark):
    path = scratch_path(spark, "padded")
    spark.createDataFrame([(1,)], "v int").write.parquet(f"{path}/partition_date=0202401")
    spark.createDataFrame([(2,)], "v int").write.parquet(f"{path}/partition_date=202402")
    sink.replace_partitions(spark.createDataFrame([(9, 202401)], PARTS), path, [202401])
    assert rows(read_table(spark, path)) == [(2, 202402), (9, 202401)]
    text = scratch_path(spark, "escaped")
    sink.append_partitions(spark.createDataFrame([(1, "a:b"), (2, "c")], "v int, p string"), text, "p")
    sink.replace_partitions(spark.createDataFrame([], "v int, p string"), text, ["a:b"], "p")
    assert rows(read_table(spark, text)) == [(2, "c")]


# ---- switches


def test_a_switch_that_died_between_moves_is_undone_and_may_die_again(spark, table, monkeypatch):
    tree = FileTree(spark)
    before = rows(read_table(spark, table))
    staged = staging_path(table)
    spark.createDataFrame([(7,)], "v int").write.parquet(f"{staged}/partition_date=202401")
    spark.createDataFrame([(8,)], "v int").write.parquet(f"{staged}/partition_date=202402")
    moves, real = [], FileTree.move

    def dies(limit):
        def move(self, old, new):
            if len(moves) >= limit:
                raise KeyboardInterrupt
            moves.append(new)
            real(self, old, new)

        return move

    swap = Swap(tree, table)
    monkeypatch.setattr("tidekeep.sinks.files.MOVERS", 1)
    monkeypatch.setattr(FileTree, "move", dies(3))
    parts = [f"{table}/partition_date={m}" for m in (202401, 202402)]
    with pytest.raises(KeyboardInterrupt):
        swap.switch(parts, [(f"{staged}/{p.rpartition('/')[2]}", p) for p in parts])
    moves.clear()
    monkeypatch.setattr(FileTree, "move", dies(2))
    with pytest.raises(KeyboardInterrupt):
        recover(tree, table)
    monkeypatch.setattr(FileTree, "move", real)
    recover(tree, table)
    assert rows(read_table(spark, table)) == before
    assert tree.names(table.rpartition("/")[0]) == ["data"]


# ---- mirrors


def test_a_mirror_copies_only_what_differs(spark, table):
    tree, copy = FileTree(spark), scratch_path(spark, "mirror")
    assert sink.mirror(spark, table, copy) == 4
    first = {f.place: f for f in tree.data_files(copy)}
    assert {(f.place, f.bytes) for f in tree.data_files(table)} == {(f.place, f.bytes) for f in first.values()}
    sink.replace_partitions(spark.createDataFrame([(22, 202402), (23, 202402)], PARTS), table, [202402, 202403])
    spark.createDataFrame([(5,)], "v int").write.mode("append").parquet(f"{table}/partition_date=202401")
    copied = sink.mirror(spark, table, copy)
    assert rows(read_table(spark, copy)) == rows(read_table(spark, table))
    kept = [f for f in tree.data_files(copy) if f.place in first]
    assert kept and all(f == first[f.place] for f in kept), "unchanged files keep their time stamps"
    assert copied == len(tree.data_files(table)) - len(kept)
    assert sink.mirror(spark, table, copy) == 0


def test_a_mirror_of_days_leaves_other_days_and_odd_names_alone(spark):
    source, copy = scratch_path(spark, "from"), scratch_path(spark, "to")
    data = [(1, "a:b"), (2, "c%d"), (3, None)]
    sink.append_partitions(spark.createDataFrame(data, "v int, p string"), source, "p")
    sink.mirror(spark, source, copy)
    assert rows(read_table(spark, copy)) == rows(read_table(spark, source))
    days, part = scratch_path(spark, "days"), scratch_path(spark, "part")
    sink.append_partitions(spark.createDataFrame([(1, 20240101), (2, 20240102)], PARTS), days)
    sink.append_partitions(spark.createDataFrame([(8, 20240102), (9, 20240103)], PARTS), part)
    sink.mirror(spark, days, part, [20240102, 20240103])
    assert rows(read_table(spark, part)) == [(2, 20240102), (9, 20240103)]


def test_a_mirror_through_spark_where_tasks_cannot_open_the_store(spark, table, monkeypatch):
    monkeypatch.setattr(sink, "reachable", lambda uri: False)
    copy = scratch_path(spark, "far")
    sink.mirror(spark, table, copy)
    assert rows(read_table(spark, copy)) == rows(read_table(spark, table))


def test_replication_between_times_merges_inside_the_day(spark):
    source, target = scratch_path(spark, "src"), scratch_path(spark, "dst")
    kind = "v int, ts timestamp_ntz, partition_date int"
    at = [datetime(2024, 1, 1, h) for h in (1, 5, 9)]
    sink.append_partitions(spark.createDataFrame([(i, t, 20240101) for i, t in enumerate(at)], kind), target)
    sink.append_partitions(spark.createDataFrame([(7, None, 20240101), (6, at[0], 20240102)], kind), target)
    sink.append_partitions(spark.createDataFrame([(10, at[0], 20240101), (11, at[1], 20240101)], kind), source)
    sink.replicate_partitions(spark, source, target, [20240101, 20240102], "ts", at[0], at[2])
    assert rows(read_table(spark, target), "v") == [(0,), (11,), (2,), (6,), (7,)]
