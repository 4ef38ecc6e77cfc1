"""Reading landed and cleaned tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import FIELD_DELIMITER, LINE_DELIMITER, PARTITION_COLUMN
from ..functions.dates import time_literal
from ..functions.text import decode_nulls
from ..sinks.files import FileTree


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    """A columnar table; partition columns come from the directory names.

    With a schema the table may also be empty, or not written yet.
    """
    if schema is None:
        return spark.read.format(fmt).load(path)
    if not FileTree(spark).exists(path):
        return spark.createDataFrame([], schema)
    return spark.read.format(fmt).schema(schema).load(path)


def read_landing(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A delimited text table.

    Lines are split rather than parsed as CSV because the landing format has no quoting: an empty
    field is an empty string, the marker alone is NULL, missing trailing fields are NULL.
    """
    lines = spark.read.option("lineSep", LINE_DELIMITER).text(path)
    partitions = [c for c in lines.columns if c != "value"]
    fields = T.StructType([f for f in schema.fields if f.name not in partitions])
    parts = F.split(F.col("value"), FIELD_DELIMITER, -1)
    texts = lines.select(
        *[F.get(parts, F.lit(i)).alias(f.name) for i, f in enumerate(fields.fields)],
        *[F.col(c).cast("string").alias(c) for c in partitions],
    )
    return decode_nulls(texts, schema)


def read_partitions(df: DataFrame, lo: int, hi: int, column: str = PARTITION_COLUMN) -> DataFrame:
    """Partitions lo to hi, both included; a literal range, so it prunes directories."""
    return df.where(F.col(column).between(lo, hi))


def read_partition_list(
    df: DataFrame,
    days: Iterable[int],
    time_column: str | None = None,
    after: datetime | None = None,
    before: datetime | None = None,
    column: str = PARTITION_COLUMN,
) -> DataFrame:
    """Listed partitions, optionally cut to times strictly between two instants."""
    out = df.where(F.col(column).isin(*days))
    if time_column and after is not None:
        out = out.where(F.col(time_column) > time_literal(df, time_column, after))
    if time_column and before is not None:
        out = out.where(F.col(time_column) < time_literal(df, time_column, before))
    return out


def run_query(
    spark: SparkSession, sql: str, args: Mapping[str, object] | None = None, **tables: DataFrame
) -> DataFrame:
    """An ad-hoc query; values travel as typed parameters, tables as DataFrames."""
    return spark.sql(sql, args=dict(args or {}), **tables)
