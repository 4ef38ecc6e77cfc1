"""Persisted log positions: where the next incremental run starts.

Ranges include both ends, so the row at the boundary is applied again; every consumer is idempotent.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import time_text
from ..sinks.tables import upsert

POSITION_KEYS = ["sys_name", "table_name"]


# A position row; log_day is the partition of the log that the newest delete lies in, NULL in older states.
POSITION_SCHEMA = "sys_name string, table_name string, seq_no bigint, update_time string, log_day int"


@dataclass(frozen=True)
class Position:
    """Where a log was read to. Rows of that sequence number or later lie in partitions from `log_day` on."""

    seq_no: int = 0
    log_day: int | None = None


def read_position(state: DataFrame, system: str, table: str) -> Position:
    """The saved position with its log day; the start for a table that never ran."""
    rows = state.where((F.col("sys_name") == system) & (F.col("table_name") == table))
    day = F.col("log_day") if "log_day" in state.columns else F.lit(None).cast("int")
    found = rows.select("seq_no", day.alias("log_day")).orderBy(F.col("seq_no").desc_nulls_last()).first()
    if found is None or found[0] is None or found[0] < 0:
        return Position()
    return Position(*found)


def position_row(spark: SparkSession, system: str, table: str, position: Position, as_of: datetime) -> DataFrame:
    row = (system, table, position.seq_no, time_text(as_of), position.log_day)
    return spark.createDataFrame([row], POSITION_SCHEMA)


def load_position(state: DataFrame, system: str, table: str) -> int:
    """The saved sequence number; 0 for a table that never ran, or whose number is negative."""
    rows = state.where((F.col("sys_name") == system) & (F.col("table_name") == table))
    return max(rows.agg(F.max("seq_no")).first()[0] or 0, 0)


def positions_of(log: DataFrame, as_of: datetime) -> DataFrame:
    """The newest delete of each table in a log, as position rows."""
    newest = log.where("dml_type = 0").groupBy(F.col("db_name").alias("sys_name"), "table_name")
    return newest.agg(F.max("seq_no").alias("seq_no")).withColumn("update_time", F.lit(time_text(as_of)))


def save_position(state: DataFrame, changes: DataFrame) -> DataFrame:
    """The state with the given positions replaced."""
    return upsert(state, changes.select(*state.columns), POSITION_KEYS)
