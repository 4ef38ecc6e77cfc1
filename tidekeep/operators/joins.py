"""Joins. All are equi-joins, some with a residual condition.

Skew: one key may hold a third of either side. Key sets that only decide whether a row survives are
made distinct before they are shuffled, so a hot key arrives as a handful of rows; the joined side
keeps a plain shuffle directly under the join, which is the shape adaptive execution can split when
one of its partitions is oversized. Nothing is broadcast by hint: Spark does it when the size it
estimates or measures is under its limit.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import PARTITION_COLUMN, TaskConfig
from ..functions.dates import time_literal
from ..functions.text import composite_key

# A distinct key is kept once per spread slot: distinct rows are shuffled by (key, slot), and the join
# shuffles them again by key alone. The second shuffle is what adaptive skew handling needs to see.
SPREAD = 16
_SLOT = "__slot"

# The key as text or number, on either side of a join. Helper columns start with two underscores so that they
# never hide a column of the table.
KEY_TEXT = "__key"


def distinct_keys(df: DataFrame, *keys: str) -> DataFrame:
    """The key combinations of `df` without NULLs, a hot one reduced to at most SPREAD rows."""
    rows = df.select(*keys).na.drop(subset=list(keys))
    return rows.withColumn(_SLOT, F.spark_partition_id() % SPREAD).distinct().drop(_SLOT)


def without(left: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of `left` whose key is not among `keys`. A NULL key matches nothing, so its row stays."""
    return left.join(distinct_keys(keys, *on), list(on), "left_anti")


def within(left: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of `left` whose key is among `keys`."""
    return left.join(distinct_keys(keys, *on), list(on), "left_semi")


def anti_by_keys(target: DataFrame, delta: DataFrame, pks: Sequence[str]) -> DataFrame:
    """Target rows whose primary key does not occur in the delta."""
    return without(target, delta, pks)


def id_values(log: DataFrame) -> DataFrame:
    return log.select(F.col("id_column_value").cast("string").alias(KEY_TEXT))


def is_number(target: DataFrame, pks: Sequence[str]) -> bool:
    """Whether a key is one whole number, which is matched as such instead of as text."""
    return len(pks) == 1 and isinstance(target.schema[pks[0]].dataType, T.IntegralType)


def match_key(target: DataFrame, pks: Sequence[str]) -> Column:
    """What a table's key is matched by: its text, or the number that it is."""
    return F.col(pks[0]).cast("bigint") if is_number(target, pks) else composite_key(*pks)


def ids_as(ids: DataFrame, target: DataFrame, pks: Sequence[str]) -> DataFrame:
    """Key texts in the form of `match_key`. A text that is not how a number is written matches none."""
    if not is_number(target, pks):
        return ids
    number = F.col(KEY_TEXT).try_cast("bigint")
    return ids.select(F.when(number.cast("string") == F.col(KEY_TEXT), number).alias(KEY_TEXT))


def anti_by_id_value(target: DataFrame, log: DataFrame, pks: Sequence[str]) -> DataFrame:
    """Target rows whose key text is not the id of a log row."""
    ids = ids_as(id_values(log), target, pks)
    return without(target.withColumn(KEY_TEXT, match_key(target, pks)), ids, [KEY_TEXT]).drop(KEY_TEXT)


def anti_by_delta_and_log(target: DataFrame, delta: DataFrame, log: DataFrame | None, pks: Sequence[str]) -> DataFrame:
    """`anti_by_keys` and `anti_by_id_value` in one pass, so the target is shuffled once.

    Both sides meet on the key text, or on the number that the key is. Delta keys must also agree column by column, because values
    with commas could make two different keys read alike; log rows carry only the text.
    """
    parts = {k: f"__key_{i}" for i, k in enumerate(pks)}
    kinds = {k: target.schema[k].dataType for k in pks}
    marks = delta.select(*[F.col(k).cast(kinds[k]).alias(part) for k, part in parts.items()]).na.drop()
    marks = marks.withColumn("__mark", match_key(marks, list(parts.values())))
    if log is not None:
        blanks = [F.lit(None).cast(kinds[k]).alias(part) for k, part in parts.items()]
        ids = ids_as(id_values(log), target, pks).na.drop()
        marks = marks.unionByName(ids.select(*blanks, F.col(KEY_TEXT).alias("__mark")))
    marks = marks.withColumn(_SLOT, F.spark_partition_id() % SPREAD).distinct().drop(_SLOT)
    condition = F.col(KEY_TEXT) == F.col("__mark")
    if len(pks) > 1:
        from_log = F.col(parts[pks[0]]).isNull()
        same = reduce(and_, [F.col(k) == F.col(part) for k, part in parts.items()])
        condition = condition & (from_log | same)
    return target.withColumn(KEY_TEXT, match_key(target, pks)).join(marks, condition, "left_anti").drop(KEY_TEXT)


def delete_in(target: DataFrame, keys: DataFrame, pks: Sequence[str], lo: int, hi: int | None = None) -> DataFrame:
    """Drop rows of partitions from lo (to hi) whose key text is among `keys.__key`; others are untouched."""
    marked, keys = target.withColumn(KEY_TEXT, match_key(target, pks)), ids_as(keys, target, pks)
    scope = F.col(PARTITION_COLUMN) >= lo
    if hi is not None:
        scope = scope & (F.col(PARTITION_COLUMN) <= hi)
    inside = without(marked.where(scope), keys, [KEY_TEXT])
    outside = marked.where(~F.coalesce(scope, F.lit(False)))
    return inside.unionByName(outside).drop(KEY_TEXT)


def key_texts(delta: DataFrame, pks: Sequence[str]) -> DataFrame:
    return delta.select(composite_key(*pks).alias(KEY_TEXT))


def log_range(log: DataFrame, lo: int, hi: int) -> DataFrame:
    """Log rows by sequence number, both ends included."""
    return log.where(F.col("seq_no").between(lo, hi))


def delta_minus_deletes(delta: DataFrame, log: DataFrame, pks: Sequence[str], lo: int, hi: int) -> DataFrame:
    """Delta rows whose key has no log row in the sequence range."""
    return anti_by_id_value(delta, log_range(log, lo, hi), pks)


def relation_pairs(detail: TaskConfig, master: TaskConfig) -> list[tuple[str, str]]:
    """(detail column, master column): a missing list copies the other, both missing mean bill_no."""
    ours = detail.relation_columns or master.relation_columns or ("bill_no",)
    theirs = master.relation_columns or ours
    return list(zip(ours, theirs))


def master_detail_join(
    detail: DataFrame,
    master: DataFrame,
    pairs: Sequence[tuple[str, str]],
    time_column: str,
    begin: datetime,
    end: datetime,
) -> DataFrame:
    """Detail rows with their master, for masters inside the window."""
    t = time_literal(master, time_column, begin), time_literal(master, time_column, end)
    m = master.where((F.col(time_column) >= t[0]) & (F.col(time_column) < t[1]))
    return detail.join(m, reduce(and_, [detail[d] == m[k] for d, k in pairs]), "inner")


def latest_by_join(df: DataFrame, keys: Sequence[str], time_column: str) -> DataFrame:
    """Rows carrying their group's largest time; all of them when several do.

    The maximum is pre-aggregated per task and the rows are matched on (group, time), so a hot group
    is never gathered in one place.
    """
    newest = df.groupBy(*keys).agg(F.max(time_column).alias(time_column))
    return df.join(newest, [*keys, time_column], "left_semi")


def merge_counts(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Two count tables side by side; a day one of them lacks counts 0 there."""
    return source.join(target, list(keys), "full_outer").select(
        *keys,
        F.coalesce("source_count", F.lit(0).cast("bigint")).alias("source_count"),
        F.coalesce("target_count", F.lit(0).cast("bigint")).alias("target_count"),
    )


def logged_deletes(
    log: DataFrame,
    table: str,
    time_column: str,
    begin: datetime,
    end: datetime,
    unprocessed_only: bool = True,
) -> DataFrame:
    """Log rows of one table between two times, both included."""
    c = F.col(time_column)
    rows = log.where(
        (F.col("table_name") == table)
        & (c >= time_literal(log, time_column, begin))
        & (c <= time_literal(log, time_column, end))
    )
    return rows.where("process_status = 0") if unprocessed_only else rows


def delete_exists(target: DataFrame, deletes: DataFrame, pk: str, keep_deleted: bool = False) -> DataFrame:
    """Target rows without a matching delete, or the deleted rows themselves."""
    key = match_key(target, [pk]) if is_number(target, [pk]) else F.col(pk).cast("string")
    pick = within if keep_deleted else without
    return pick(target.withColumn(KEY_TEXT, key), ids_as(id_values(deletes), target, [pk]), [KEY_TEXT]).drop(KEY_TEXT)


def logged_days(log: DataFrame, table: str, lo_day: int, hi_day: int) -> DataFrame:
    """Log rows of one table in the given day partitions, both included."""
    return log.where((F.col("table_name") == table) & F.col(PARTITION_COLUMN).between(lo_day, hi_day))


def rebuild_without(target: DataFrame, log: DataFrame, pk: str, table: str, lo_day: int, hi_day: int) -> DataFrame:
    """The table without keys logged on the given days."""
    return anti_by_id_value(target, logged_days(log, table, lo_day, hi_day), [pk])


def enrich(df: DataFrame, dimension: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Look up columns by key; rows without a match keep NULLs."""
    return df.join(dimension, list(keys), "left")
