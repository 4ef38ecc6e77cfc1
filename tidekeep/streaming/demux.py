"""Routing a change log as it lands: each run takes the files that arrived since the last one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import PARTITION_COLUMN
from ..sources.scans import read_table

KEYS = ("db_name", "table_name", PARTITION_COLUMN)
# The innermost folder of a routed log: which run of the stream its files come from.
BATCH_COLUMN = "batch_id"
# Rows that one file takes at most, so a crowded table and day is written by several tasks.
ROWS_PER_FILE = 2_000_000


def write_batch(rows: DataFrame, batch_id: int, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """The rows of one batch, each table and day gathered into as few files as their number calls for.

    Batch folders are replaced, so a batch that is tried again leaves what it would have left the first time. A crowded table
    and day is spread over several tasks; its rows are dealt by their content.
    """
    keys = [F.col(k) for k in KEYS]
    counts = rows.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("__n"))
    # At most one row for each `rows_per_file` rows of the batch.
    crowded = counts.where(F.col("__n") > rows_per_file).select(*KEYS, F.ceil(F.col("__n") / rows_per_file).alias("__files"))
    known = crowded.collect()
    salt = F.lit(0)
    dealt = rows
    if known:
        spread = rows.sparkSession.createDataFrame(known, crowded.schema)
        same = [F.col(f"r.{k}").eqNullSafe(F.col(f"c.{k}")) for k in KEYS]
        dealt = rows.alias("r").join(F.broadcast(spread).alias("c"), same, "left").select("r.*", "c.__files")
        salt = F.pmod(F.xxhash64(*rows.columns), F.coalesce("__files", F.lit(1)))
    dealt = dealt.withColumn("__salt", salt).repartition(*keys, F.col("__salt")).drop("__files", "__salt")
    writer = dealt.withColumn(BATCH_COLUMN, F.lit(batch_id)).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(*KEYS, BATCH_COLUMN).parquet(path)


def read_routed(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The rows of a routed log, without the number of their batch. With a schema it may hold nothing yet."""
    if schema is not None:
        schema = T.StructType([*schema.fields, T.StructField(BATCH_COLUMN, T.LongType())])
    return read_table(spark, path, schema=schema).drop(BATCH_COLUMN)


def route_new_rows(log: DataFrame, path: str, progress: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Add the new rows of a streamed log to one directory per database, table and day; a folder per batch inside.

    The progress folder is the position: it records which files belong to which batch. The run ends when nothing new is left.
    """
    stream = (
        log.writeStream.foreachBatch(lambda rows, batch_id: write_batch(rows, batch_id, path, rows_per_file))
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
    stream.awaitTermination()
