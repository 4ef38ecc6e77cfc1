"""What five document filters remove in every order: one pass of flags, a duplicate prepass, and counts by mask.

A document's failures are five bits. The four that its own text decides are taken where it is read, with a 64-bit hash of the
text. Repeats are the fifth: counting Bloom blocks over the hashes clear every text whose counters show it to be the only one,
and only the others are shuffled, to find the smallest id of each text by comparing whole texts. All reports follow from the
number of documents of each part and mask, at most 32 rows a part.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .blooms import BLOCK_BYTES, block_of, blocks_for, merged_blocks, reached
from .common import stored

LETTERS = "ABCDE"
MIN_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT, MARKS = 100, 80, 10, "[#$%&*|]"
# Documents a filter block is made for: eight counters each, about 2 % of single texts stay in doubt.
DOCS_PER_BLOCK = 1 << 17
# The blocks are broadcast up to this size; beyond it the hashes are shuffled to their blocks.
BROADCAST_BYTES = 256 << 20


def _bit(letter: str) -> int:
    return 1 << LETTERS.index(letter)


def text_failures(text: Column) -> Column:
    """The mask of the filters that a text decides by itself."""
    words = F.array_remove(F.split(text, "[\\x20\\x09-\\x0D]+"), "")
    n, chars = F.size(words), F.length(text)
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    fails = {
        "A": n < MIN_WORDS,
        "B": F.size(F.array_distinct(words)) * 100 < n * DISTINCT_PERCENT,
        "C": capitals * 100 > chars * CAPITAL_PERCENT,
        "D": text.rlike(MARKS),
    }
    return sum((F.when(test, _bit(k)).otherwise(0) for k, test in fails.items()), F.lit(0))


def first_ids(docs: DataFrame, hashes: DataFrame, blocks: int, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Texts that the filter does not clear: __hash, __text, __first (smallest id), __copies. docs: __id, __text, __hash; hashes:
    __hash of all. All texts of a hash that occurs twice are among them.

    A text that the filter clears is never shuffled while the blocks can be broadcast.
    """
    filter_blocks = stored(merged_blocks(hashes, blocks, least=2), "repeat_blocks")
    key = F.col("__hash")
    if blocks * BLOCK_BYTES <= broadcast_bytes:
        placed = docs.withColumn("block", block_of(key, blocks))
        doubtful = placed.join(F.broadcast(filter_blocks), "block").where(reached(key, F.col("words")))
    else:
        asked = hashes.distinct().withColumn("block", block_of(key, blocks))
        kept = asked.join(filter_blocks, "block").where(reached(key, F.col("words"))).select("__hash")
        doubtful = docs.join(kept, "__hash", "left_semi")
    return doubtful.groupBy("__hash", "__text").agg(F.min("__id").alias("__first"), F.count(F.lit(1)).alias("__copies"))


def masks(docs: DataFrame, labels: DataFrame, docs_per_block: int = DOCS_PER_BLOCK, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per document: __id, part, mask, good, toxic. See `audit`."""
    text = F.coalesce(F.col("text"), F.lit(""))
    read = docs.select(
        F.col("doc_id").alias("__id"), F.coalesce(F.col("lang"), F.lit("")).alias("part"), text.alias("__text"),
        F.xxhash64(text).alias("__hash"),
    )
    flagged = stored(read.select("__id", "part", "__hash", text_failures(F.col("__text")).alias("mask")), "flags")
    blocks = blocks_for(flagged.count(), docs_per_block, 1 << 31)
    repeats = stored(
        first_ids(read.select("__id", "__text", "__hash"), flagged.select("__hash"), blocks, broadcast_bytes), "repeats"
    )
    by_hash = repeats.groupBy("__hash").agg(
        F.count(F.lit(1)).alias("__texts"), F.min("__first").alias("__first"), F.max("__copies").alias("__copies")
    )
    by_hash = by_hash.where("__copies > 1").drop("__copies")
    later = F.coalesce(F.col("__id") > F.col("__first"), F.lit(False))
    whole = F.col("mask") + F.when(later, _bit("E")).otherwise(0)
    shared = by_hash.where("__texts > 1")
    if shared.isEmpty():
        out = flagged.join(by_hash, "__hash", "left")
    else:  # different texts of one hash: their documents are matched by text
        plain = flagged.join(shared, "__hash", "left_anti").join(by_hash, "__hash", "left")
        own = read.withColumn("mask", text_failures(F.col("__text"))).join(shared.select("__hash"), "__hash", "left_semi")
        out = plain.select("__id", "part", "mask", "__first").unionByName(
            own.join(repeats, ["__hash", "__text"], "left").select("__id", "part", "mask", "__first")
        )
    one = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("__id"))
    marks = one.agg(*[F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(n) for c, n in (("quality", "good"), ("toxic", "toxic"))])
    return out.select("__id", "part", whole.alias("mask")).join(marks, "__id", "left")


def audit(
    docs: DataFrame, labels: DataFrame, docs_per_block: int = DOCS_PER_BLOCK, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Counts after each step of every order of the five filters, per value of lang (null: empty string).

    Filters fail a text (null: empty) of under 100 words (A), under 80 % distinct words (B), over 10 % capitals A-Z (C), holding
    one of #$%&*| (D), or identical to the text of a smaller doc_id (E). Rows of equal id and text do not fail E by each other; a
    row without an id never fails E and makes none fail. A document counts as good or toxic if any of its label rows says so.
    Other columns are not looked at. An empty table has no parts and gives no rows.
    """
    counted = masks(docs, labels, docs_per_block, broadcast_bytes).groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
        F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"),
    )
    # At most 32 entries each.
    parts = counted.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("m"))
    steps = " ".join(f"{''.join(o)}{s}" for o in permutations(LETTERS) for s in range(1, 6))
    rows = parts.select("part", "m", F.explode(F.split(F.lit(steps), " ")).alias("s")).select(
        "part", "m", F.substring("s", 1, 5).alias("filter_order"), F.substring("s", 6, 1).cast("int").alias("step")
    )

    def bit(place: str) -> Column:
        return F.expr("shiftleft(1, ascii(substr(filter_order, __at, 1)) - 65)".replace("__at", place))

    before = sum((F.when(F.col("step") > i, bit(str(i))).otherwise(0) for i in range(1, 5)), F.lit(0))
    rows = rows.withColumn("before", before).withColumn("own", bit("step"))

    def total(field: str, test) -> Column:
        return F.aggregate("m", F.lit(0).cast("bigint"), lambda acc, x: acc + F.when(test(x["mask"]), x[field]).otherwise(0))

    def survives(mask: Column) -> Column:
        return mask.bitwiseAND(F.col("before")) == 0

    def fails(mask: Column) -> Column:
        return mask.bitwiseAND(F.col("own")) != 0

    out = rows.select(
        "part", "filter_order", "step", "own",
        total("n", lambda m: survives(m) & ~fails(m)).alias("kept"),
        total("n", lambda m: survives(m) & fails(m)).alias("removed"),
        total("n", lambda m: ~survives(m) & fails(m)).alias("redundant"),
        total("n", lambda m: m == F.col("own")).alias("unique_fails"),
        total("good", lambda m: survives(m) & fails(m)).alias("good_lost"),
        total("toxic", lambda m: survives(m) & fails(m)).alias("toxic_lost"),
    )
    # 120 rows of each part and filter.
    return out.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "own"))).drop("own")
