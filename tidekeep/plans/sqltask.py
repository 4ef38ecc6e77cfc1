"""Configured SQL tasks: named time parameters, typed by Spark, and small named functions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from ..config import time_text


def time_arguments(names: Sequence[str], begin: datetime, end: datetime) -> dict[str, object]:
    """Up to four names: begin and end as text, then begin and end as epoch milliseconds."""
    millis = [int(t.replace(tzinfo=timezone.utc).timestamp() * 1000) for t in (begin, end)]
    return dict(zip(names, [time_text(begin), time_text(end), *millis]))


def run_sql_task(
    spark: SparkSession,
    sql: str,
    begin: datetime,
    end: datetime,
    parameters: Sequence[str] = (),
    tables: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Run a statement with `:name` parameters; a changing statement returns an empty frame."""
    return spark.sql(sql, args=time_arguments(parameters, begin, end), **dict(tables or {}))


def register_function(spark: SparkSession, name: str, arguments: str, returns: str, body: str) -> None:
    """Define a function for the following statements, replacing one of the same name."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {returns} RETURN {body}")
