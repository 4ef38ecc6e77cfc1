"""Writing tables: partition replacement, full reloads, maintenance.

Every replacement is written beside the table first and moved in when it is complete, so a job that
dies half-way, or a table that is both read and written, loses nothing. Writes are rebalanced by
partition: small partitions are merged into few files, an oversized one is split over several tasks.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import (
    BACKUP_DAYS,
    FIELD_DELIMITER,
    LINE_DELIMITER,
    PARTITION_COLUMN,
    RETAINED_SNAPSHOTS,
    months_between,
)
from ..functions.dates import day_int_from_text, time_literal
from ..functions.text import encode_nulls, scrub_delimiters
from ..operators.joins import without
from ..operators.ranking import top_k_per_group
from ..sources.scans import read_landing, read_table
from .copies import copy_files, reachable
from .files import DataFile, FileTree, Swap, recover, staging

# Tables with these name endings are short-lived and not worth compacting.
SHORT_LIVED = ("_stg", "_tmp", "_temp", "_cln")
# A folder whose files are smaller than this on average is worth compacting, into files of about the second size.
SMALL_FILE = 16 << 20
MERGED_FILE = 90 << 20
# Files that one compaction job merges; their list is what its tasks are sent.
FILES_PER_JOB = 10_000
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
_PACK = "__pack"


def _catalog(spark: SparkSession):
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils


def _partition(spark: SparkSession, column: str, value: object) -> str:
    """The folder Spark writes a value to, signs that paths cannot hold escaped."""
    return f"{column}={NO_VALUE if value is None else _catalog(spark).escapePathName(str(value))}"


def folder_value(spark: SparkSession, folder: str, kind: T.DataType) -> object:
    """The value a partition folder stands for, in the column's type: `m=01` is 1 for a number and "01" for a text."""
    raw = folder.partition("=")[2]
    if raw == NO_VALUE:
        return None
    value = _catalog(spark).unescapePathName(raw)
    return int(value) if isinstance(kind, T.IntegralType) and re.fullmatch(r"[+-]?[0-9]+", value) else value


def _rebalanced(df: DataFrame, column: str | None) -> DataFrame:
    return df.hint("rebalance", F.col(column)) if column else df.hint("rebalance")


def _save(df: DataFrame, path: str, column: str | None, fmt: str = "parquet", layout: str = "by partition") -> None:
    """Write a table. The layout says how rows reach the writing tasks: "by partition" gathers each
    partition, "by size" only evens out the tasks, "as read" moves nothing and suits plain copies."""
    if layout != "as read":
        df = _rebalanced(df, column if layout == "by partition" else None)
    writer = df.write.format(fmt)
    (writer.partitionBy(column) if column else writer).save(path)


def replace_partitions(
    df: DataFrame,
    path: str,
    covered: Iterable[int | None],
    column: str = PARTITION_COLUMN,
    beyond: str = "replace",
    fmt: str = "parquet",
    layout: str = "by partition",
) -> None:
    """Make the covered partitions hold exactly the rows of `df`; those without rows disappear.

    Rows may fall into partitions outside the covered ones; `beyond` says whether such a partition is
    replaced too, gets the rows added, or is refused. The rest of the table is untouched. Folders are compared by the value
    they stand for, so one that was spelled otherwise (`01` for a number) is replaced as well.
    """
    spark, kind = df.sparkSession, df.schema[column].dataType
    tree = FileTree(spark)
    recover(tree, path)
    covered_names = {_partition(spark, column, v) for v in covered}
    with staging(tree, path) as staged:
        _save(df, staged, column, fmt, layout)
        written = {n for n in tree.names(staged) if n.startswith(f"{column}=")}
        extra = {n for n in written - covered_names if beyond != "replace"}
        if extra and beyond == "refuse":
            raise ValueError(f"rows outside the replaced partitions: {sorted(extra)}")
        replaced = {folder_value(spark, n, kind) for n in (covered_names | written) - extra}
        live = [n for n in tree.names(path) if n.startswith(f"{column}=")]
        out = [f"{path}/{n}" for n in live if folder_value(spark, n, kind) in replaced]
        into = [(f"{staged}/{n}", f"{path}/{n}") for n in sorted(written - extra)]
        into += [(f"{staged}/{n}/{file}", f"{path}/{n}/{file}") for n in sorted(extra) for file in tree.names(f"{staged}/{n}")]
        with Swap(tree, path) as swap:
            swap.switch(out, into)


def write_day(df: DataFrame, path: str, day: int) -> None:
    """Reload one day partition; repeating it changes nothing."""
    replace_partitions(df.withColumn(PARTITION_COLUMN, F.lit(day)), path, [day], layout="by size")


def write_full(
    df: DataFrame, path: str, column: str | None = None, fmt: str = "parquet", layout: str = "by partition"
) -> None:
    """Replace the whole table."""
    tree = FileTree(df.sparkSession)
    recover(tree, path)
    with staging(tree, path) as staged:
        _save(df, staged, column, fmt, layout)
        with Swap(tree, path) as swap:
            swap.switch([path], [(staged, path)])


def append_partitions(df: DataFrame, path: str, column: str = PARTITION_COLUMN) -> None:
    _rebalanced(df, column).write.mode("append").partitionBy(column).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, column: str = PARTITION_COLUMN) -> None:
    """Replace the partitions `df` has rows for, and only those."""
    writer = _rebalanced(df, column).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(column).parquet(path)


def overwrite_month_range(df: DataFrame, path: str, lo: int, hi: int, beyond: str = "refuse") -> None:
    """Replace the months lo to hi; a month left without rows is cleared, not kept. Rows of other months are refused, or as
    `beyond` says added to their month or put in its place."""
    replace_partitions(df, path, months_between(lo, hi), beyond=beyond)


def drop_month_range(spark: SparkSession, path: str, lo: int, hi: int) -> None:
    """Remove the months lo to hi, both included."""
    tree = FileTree(spark)
    recover(tree, path)
    months, kind = set(months_between(lo, hi)), T.IntegerType()
    there = [n for n in tree.names(path) if n.startswith(f"{PARTITION_COLUMN}=")]
    with Swap(tree, path) as swap:
        swap.switch([f"{path}/{n}" for n in there if folder_value(spark, n, kind) in months], [])


def write_landing(df: DataFrame, path: str, column: str | None = None) -> None:
    """A delimited text table: scrubbed strings, the marker for NULL, no quoting."""
    fields = [f.name for f in df.schema.fields if f.name != column]
    texts = encode_nulls(scrub_delimiters(df.select(*fields, *([column] if column else []))))
    line = F.concat_ws(FIELD_DELIMITER, *[F.col(f) for f in fields]).alias("value")
    # A row without a partition value carries the marker for NULL here and lands in the default partition.
    lines = texts.select(line, *([F.col(column).try_cast("int").alias(column)] if column else []))
    writer = _rebalanced(lines, column).write.option("lineSep", LINE_DELIMITER)
    (writer.partitionBy(column) if column else writer).text(path)


def landing_to_parquet(spark: SparkSession, source: str, target: str, schema: T.StructType) -> None:
    """A landed text table as Parquet; rows go straight across, without a staging table."""
    column = PARTITION_COLUMN if PARTITION_COLUMN in schema.names else None
    write_full(read_landing(spark, source, schema), target, column, layout="as read")


def upsert(target: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Changed rows replace target rows of the same key, the others are added. Change keys are unique."""
    return changes.unionByName(without(target, changes, keys))


def _scope(spark: SparkSession, files: Iterable[DataFile], days: Sequence[int] | None) -> set[str]:
    """The partition folders of the listed days, or all folders, that hold a file."""
    folders = {f.folder for f in files}
    if days is None:
        return folders
    return {d for d in folders if d and folder_value(spark, d.split("/")[0], T.IntegerType()) in set(days)}


def mirror(spark: SparkSession, source: str, target: str, days: Sequence[int] | None = None) -> int:
    """Make the target's files those of the source: whole tables, or the listed days the source holds files of.

    A file is copied if the target lacks it, or has it in another size or from before the source's last change; what the source
    does not hold goes; the others are not touched. Copies run as tasks of about equal bytes, and come into place at once.
    Tells how many files were copied.
    """
    tree = FileTree(spark)
    recover(tree, target)
    ours, theirs = tree.data_files(source), {f.place: f for f in tree.data_files(target)}
    scope = _scope(spark, ours, days)
    ours = {f.place: f for f in ours if f.folder in scope}

    def same(f: DataFile) -> bool:
        old = theirs.get(f.place)
        return old is not None and old.bytes == f.bytes and old.changed >= f.changed

    fresh = [f for f in ours.values() if not same(f)]
    gone = [f for f in theirs.values() if f.place not in ours and (days is None or f.folder in scope)]
    changed = [theirs[f.place] for f in fresh if f.place in theirs]
    with staging(tree, target) as staged:
        if reachable(tree.uri(source)) and reachable(tree.uri(target)):
            pairs = [(tree.uri(f"{source}/{f.place}"), tree.uri(f"{staged}/{f.place}"), f.bytes) for f in fresh]
            copy_files(spark, pairs, MERGED_FILE)
        else:  # a store that only Spark can open: the rows of those files are written anew
            _write_packs(spark, source, [[f] for f in fresh], staged, [f.place for f in fresh])
        with Swap(tree, target) as swap:
            swap.switch(
                [f"{target}/{f.place}" for f in gone + changed], [(f"{staged}/{f.place}", f"{target}/{f.place}") for f in fresh]
            )
    return len(fresh)


def replicate_partitions(
    spark: SparkSession,
    source: str,
    target: str,
    days: Sequence[int] | None = None,
    time_column: str | None = None,
    after: datetime | None = None,
    before: datetime | None = None,
) -> None:
    """Copy the listed partitions that the source has files for; the target's other partitions stay.

    Without a list the whole source is mirrored, and what it does not hold goes. With times, the rows strictly between them
    are replaced by the source's, and the other rows of those days stay as the target has them.
    """
    if time_column is None or after is None and before is None:
        mirror(spark, source, target, days)
        return
    tree = FileTree(spark)
    recover(tree, target)
    scope = _scope(spark, tree.data_files(source), days)
    places = sorted({folder_value(spark, d.split("/")[0], T.IntegerType()) for d in scope if d} - {None})
    if not places:
        return
    rows = read_table(spark, source).where(F.col(PARTITION_COLUMN).isin(places))
    inside = F.lit(True)
    if after is not None:
        inside = inside & (F.col(time_column) > time_literal(rows, time_column, after))
    if before is not None:
        inside = inside & (F.col(time_column) < time_literal(rows, time_column, before))
    kept = read_table(spark, target, schema=rows.schema).where(F.col(PARTITION_COLUMN).isin(places))
    kept = kept.where(~F.coalesce(inside, F.lit(False)))
    replace_partitions(rows.where(inside).unionByName(kept), target, places, beyond="refuse")


def repartition_table(df: DataFrame, time_column: str) -> DataFrame:
    """The table with its day partition worked out anew from a time column."""
    return df.withColumn(PARTITION_COLUMN, day_int_from_text(F.col(time_column).cast("string")))


def pack_files(files: Iterable[DataFile], target: int) -> list[list[DataFile]]:
    """Files in packs of at most `target` bytes, largest first into the first pack with room."""
    packs: list[list[DataFile]] = []
    room: list[int] = []
    for file in sorted(files, key=lambda f: (-f.bytes, f.name)):
        k = next((i for i, free in enumerate(room) if free >= file.bytes), None)
        if k is None:
            packs.append([])
            room.append(target)
            k = len(packs) - 1
        packs[k].append(file)
        room[k] -= file.bytes
    return packs


def compaction_plan(files: Iterable[DataFile], small: int = SMALL_FILE, target: int = MERGED_FILE) -> list[list[DataFile]]:
    """Which files become one: packs of two and more files of a folder whose files are small on average."""
    by_folder: dict[str, list[DataFile]] = {}
    for file in files:
        by_folder.setdefault(file.folder, []).append(file)
    packs = []
    for folder in sorted(by_folder):
        own = by_folder[folder]
        if len(own) > 1 and sum(f.bytes for f in own) < small * len(own):
            packs += [p for p in pack_files((f for f in own if f.bytes < target), target) if len(p) > 1]
    return packs


def _write_packs(
    spark: SparkSession, path: str, packs: Sequence[Sequence[DataFile]], staged: str, places: Sequence[str],
    schema: T.StructType | None = None,
) -> None:
    """The rows of each pack of files as one file of the staged folder, at the given place; row counts are compared.

    Files are read by their paths and told apart by them, so partition folders are never read as values.
    """
    if not packs:
        return
    tree = FileTree(spark)
    files = [f for pack in packs for f in pack]
    reader = spark.read.option("mergeSchema", "true")
    if schema is not None:
        inside = {part.split("=")[0] for f in files for part in f.folder.split("/")}
        reader = spark.read.schema(T.StructType([f for f in schema.fields if f.name not in inside]))
    rows = reader.parquet(*[f"{path}/{f.place}" for f in files])
    numbers = [(tree.uri(f"{path}/{f.place}"), k) for k, pack in enumerate(packs) for f in pack]
    plan = spark.createDataFrame(numbers, f"__file string, {_PACK} int")
    named = rows.withColumn("__file", F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:///"))
    tasks = min(len(packs), int(spark.conf.get("spark.sql.shuffle.partitions")))
    # At most FILES_PER_JOB short rows are sent to every task.
    dealt = named.join(F.broadcast(plan), "__file").drop("__file").repartition(tasks, _PACK)
    merged = f"{staged}/merged"
    dealt.write.partitionBy(_PACK).parquet(merged)
    before, after = rows.count(), spark.read.parquet(merged).count()
    if before != after:
        raise OSError(f"{after} of {before} rows of {path} were written; nothing was replaced")
    for k, place in enumerate(places):
        names = [n for n in tree.names(f"{merged}/{_PACK}={k}") if not n.startswith((".", "_"))]
        if len(names) > 1:  # a setting that limits the rows of a file
            raise OSError(f"{path}: a pack was written as {len(names)} files")
        for name in names:
            tree.move(f"{merged}/{_PACK}={k}/{name}", f"{staged}/{place}")


def compact(spark: SparkSession, path: str, schema: T.StructType | None = None) -> bool:
    """Merge the small files of each partition folder, at any depth, and touch nothing else.

    Works from the listing: which files become one is decided by their bytes, and a merged file goes to the folder its files
    came from, whatever that folder's name stands for. A folder without rows keeps one of its files. Short-lived tables are
    skipped. Tells whether anything was rewritten.
    """
    if path.rstrip("/").endswith(SHORT_LIVED):
        return False
    tree = FileTree(spark)
    recover(tree, path)
    packs = compaction_plan(tree.data_files(path))
    start = 0
    while start < len(packs):
        stop, n = start, 0
        while stop < len(packs) and (stop == start or n + len(packs[stop]) <= FILES_PER_JOB):
            n += len(packs[stop])
            stop += 1
        job, start = packs[start:stop], stop
        with staging(tree, path) as staged:
            places = [f"{p[0].folder}/{p[0].name}.merged.parquet".lstrip("/") for p in job]
            _write_packs(spark, path, job, staged, places, schema)
            into = [(f"{staged}/{place}", f"{path}/{place}") for place in places if tree.exists(f"{staged}/{place}")]
            there = {live for _, live in into}
            gone = [
                f"{path}/{f.place}"
                for p, place in zip(job, places)
                for f in (p if f"{path}/{place}" in there else p[1:])
            ]
            with Swap(tree, path) as swap:
                swap.switch(gone, into)
    return bool(packs)


def retain_latest(
    snapshots: DataFrame, keys: Sequence[str], time_column: str, n: int = RETAINED_SNAPSHOTS
) -> DataFrame:
    """The n newest snapshots of each table."""
    return top_k_per_group(snapshots, keys, time_column, n)


def retain_newer_than(df: DataFrame, time_column: str, as_of: datetime, days: int = BACKUP_DAYS) -> DataFrame:
    """Backups no older than `days` days."""
    return df.where(F.col(time_column) >= time_literal(df, time_column, as_of - timedelta(days=days)))


def export_rows(df: DataFrame, path: str, writers: int | None = None) -> None:
    """Truncate a delimited target and fill it; files follow from bytes, unless `writers` limits how many are written at once."""
    texts = encode_nulls(scrub_delimiters(df))
    line = F.concat_ws(FIELD_DELIMITER, *[F.col(c) for c in df.columns]).alias("value")
    lines = _rebalanced(texts.select(line), None)
    tree = FileTree(df.sparkSession)
    recover(tree, path)
    with staging(tree, path) as staged:
        (lines.coalesce(writers) if writers else lines).write.option("lineSep", LINE_DELIMITER).text(staged)
        with Swap(tree, path) as swap:
            swap.switch([path], [(staged, path)])
