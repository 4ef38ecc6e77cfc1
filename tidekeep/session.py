"""Session settings worth having, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# What a cluster session should carry; all are ordinary Spark settings.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Key sets are far smaller than the tables they are matched with: hash them, do not sort the table.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "90m",
    "spark.sql.parquet.compression.codec": "snappy",
}


def shuffle_settings(shuffled_bytes: int, cores: int) -> dict[str, str]:
    """Enough shuffle partitions for about 128 MB each; adaptive execution merges those that turn out small."""
    return {"spark.sql.shuffle.partitions": str(max(2 * cores, -(-shuffled_bytes // (128 << 20))))}


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share. Only a local session may fall back to a temporary one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="tidekeep-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; its folder is removed when the session's JVM ends."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(folder)
    files.deleteOnExit(folder)
    return f"{folder.toString()}/data"
