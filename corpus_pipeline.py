"""From raw documents to a training mix: five stages, each written as Parquet and read again by the next.

Rows without an id pass every filter they can be judged by; of those with equal texts one stays. Rows that share an id are
documents of their own where their texts differ: only near-duplicates give way to each other. An empty table passes
all stages. The mix is fitted on the labelled source documents of the domains that the first stage keeps, and aims at these. The last stage adds n_tokens,
rate and copies: how often a document is to be read. Documents dealt no copy leave the mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidekeep.llm.common import stored
from tidekeep.llm.decontaminate import decontaminate
from tidekeep.llm.mixing import TARGETS, labelled_domains, mix
from tidekeep.llm.neardup import near_duplicates
from tidekeep.llm.pii import anonymise
from tidekeep.llm.quality import keep_good

# Numbers rows where the near-duplicates are sought.
ROW = "__row"
# Domains that the first stage keeps: those of quality 1.
GOOD = "1/"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the discriminant does not reject."""
    return keep_good(docs, _table(spark, sf_dir, "labels"))


def _apart(docs: DataFrame) -> DataFrame:
    """Rows with an id, with a number of its own for each: its id, or a larger number where rows share an id."""
    own, named = F.col("doc_id").cast("long"), docs.where("doc_id is not null")
    shared = stored(named.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id"), "shared")
    if shared.isEmpty():
        return named.withColumn(ROW, own)
    alone = named.join(shared, "doc_id", "left_anti").withColumn(ROW, own)
    again = named.join(shared, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    again = stored(again.withColumn("__at", F.monotonically_increasing_id()), "again")  # the numbers rest on where rows lie
    first = again.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text"), "__at")).alias("f"))
    again = again.join(first.select("f.__at", F.lit(True).alias("__first")), "__at", "left")
    # The first row of an id keeps it, so a group is still named by its smallest id.
    number = F.when(F.col("__first"), own).otherwise(F.lit(1 << 62) + F.col("__at"))
    return alone.unionByName(again.withColumn(ROW, number).drop("__at", "__first"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near-duplicates."""
    rows = _apart(docs)
    groups = near_duplicates(rows.select(F.col(ROW).alias("doc_id"), "text"))
    kept = groups.where("kept").select(F.col("doc_id").alias(ROW))
    named = rows.join(kept, ROW, "left_semi").select(*docs.columns)
    return named.unionByName(docs.where("doc_id is null").dropDuplicates(["text"]))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of the benchmark."""
    return decontaminate(docs, _table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates for personal data."""
    return anonymise(docs).select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the rate and the number of copies that bring the mix to its target shares."""
    domains = labelled_domains(_table(spark, sf_dir, "labels"), ["quality", "toxic"])
    domains = domains.where(F.col("domain").startswith(GOOD))
    left = {name: share for name, share in TARGETS.items() if name.startswith(GOOD)}
    out, _ = mix(docs, domains, left, examples=_table(spark, sf_dir, "documents"))
    return out.where("copies > 0").select(*docs.columns, "n_tokens", "rate", "copies")


STAGES = [
    ("quality_classifier", good_quality),
    ("minhash_near_dedup", near_dedup),
    ("benchmark_decontamination", without_benchmark),
    ("pii_surrogates", without_personal_data),
    ("mixing", mixed),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
