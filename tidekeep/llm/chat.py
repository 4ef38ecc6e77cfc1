"""Logged conversations that only repeat the start of a longer one give way to it, and the rest are rendered.

A conversation's rows are put in order of turn, then role and text. Its rolling prefix hash after each turn is a polynomial in
the hashes of its turns, modulo three primes. Each conversation's turns are dealt into runs of turn numbers: sums are taken
within a run and then over a conversation's runs, so a conversation of very many turns is no single window.

A conversation goes if its whole hash is a prefix hash of a longer one, or if an equal one has a smaller id. Prefix hashes
are grouped with partial aggregation, so a first turn that very many conversations share costs a task one row.

Rendering wraps each turn in role tokens. A rendered conversation comes in segments of `SEGMENT` turns, so none has to fit one
row. Null roles and texts render as empty, and differ from empty ones when conversations are compared. Exactly repeated rows
count once; rows of one turn that differ follow one another. Rows without a turn come first, rows without conversation are
left out. Other columns are not looked at. Names and contents that look like role tokens are broken by a space.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored

PRIMES = (2147483647, 2147483629, 2147483587)
BASES = (1000003, 998244353, 69069691)
RUN = 256
SEGMENT = 512


def _power(base: int, p: int, k: Column) -> Column:
    """base to the power k modulo p, from a table for each 6 bits of k."""
    out = F.lit(1).cast("long")
    for shift in range(0, 30, 6):
        step = pow(base, 1 << shift, p)
        entries = F.array(*[F.lit(pow(step, d, p)).cast("long") for d in range(64)])
        digit = F.shiftright(k, shift).bitwiseAND(F.lit(63)).cast("int")
        out = out * F.element_at(entries, digit + 1) % p
    return out


def prefixes(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 0), role, text and the prefix hashes h0, h1, h2 after each turn."""
    rows = conversations.select(
        F.col("conv_id").cast("long"),
        F.coalesce(F.col("turn").cast("long"), F.lit(-(1 << 63))).alias("turn"),
        F.col("role").cast("string"),
        F.col("text").cast("string"),
    )
    rows = rows.where("conv_id is not null").distinct()
    rows = rows.withColumn("run", F.floor(F.col("turn") / RUN))
    order = ["turn", "role", "text"]
    within = Window.partitionBy("conv_id", "run").orderBy(*order)
    sums = rows.groupBy("conv_id", "run").agg(F.count("*").alias("n"))
    runs = Window.partitionBy("conv_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("conv_id", "run", F.coalesce(F.sum("n").over(runs), F.lit(0)).alias("before"))
    rows = rows.withColumn("rank", F.row_number().over(within) - 1).join(sums, ["conv_id", "run"])
    rows = rows.withColumn("place", F.col("before") + F.col("rank")).drop("before", "rank")
    one = F.xxhash64(F.struct("role", "text", F.col("role").isNull(), F.col("text").isNull()))
    two = F.xxhash64(F.lit(7), "text", "role", F.col("text").isNull())
    for k, (base, p) in enumerate(zip(BASES, PRIMES, strict=True)):
        turn = F.pmod(one if k < 2 else two, F.lit(p))
        rows = rows.withColumn(f"t{k}", turn * _power(base, p, F.col("place")) % p)
    rows = stored(rows, "turns")
    names = [f"t{k}" for k in range(3)]
    totals = rows.groupBy("conv_id", "run").agg(*[F.sum(c).alias(c) for c in names])
    totals = totals.select(
        "conv_id", "run", *[F.coalesce(F.sum(c).over(runs), F.lit(0)).alias(f"b{k}") for k, c in enumerate(names)]
    )
    sofar = within.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({c: F.sum(c).over(sofar) for c in names}).join(totals, ["conv_id", "run"])
    hashes = [((F.col(f"t{k}") + F.col(f"b{k}")) % p).alias(f"h{k}") for k, p in enumerate(PRIMES)]
    return rows.select("conv_id", "place", "role", "text", *hashes)


def maximal(turns: DataFrame) -> DataFrame:
    """The ids of the conversations that are the start of no longer one and equal to none with a smaller id."""
    key = ["place", "h0", "h1", "h2"]
    last = turns.groupBy("conv_id").agg(F.max("place").alias("last"))
    marked = turns.select("conv_id", *key).join(last, "conv_id")
    ends = F.col("place") == F.col("last")
    seen = marked.groupBy(*key).agg(
        F.max((~ends).cast("int")).alias("goes_on"), F.min(F.when(ends, F.col("conv_id"))).alias("first")
    )
    whole = marked.where(ends).select("conv_id", *key)
    covered = seen.where("goes_on = 1 and first is not null").select(*key)
    firsts = seen.where("first is not null").select(F.col("first").alias("conv_id"))
    return whole.join(covered, key, "left_anti").select("conv_id").join(firsts, "conv_id", "left_semi")


def render(role: Column, text: Column) -> Column:
    """One turn between role tokens."""
    safe = [F.regexp_replace(F.coalesce(c, F.lit("")), r"<\|", "< |") for c in (role, text)]
    return F.concat(F.lit("<|"), safe[0], F.lit("|>\n"), safe[1], F.lit("<|end|>\n"))


def collapse(conversations: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """conv_id, segment (from 0), first_turn, n_turns and rendered: the maximal conversations."""
    turns = stored(prefixes(conversations), "prefixes")
    kept = turns.join(maximal(turns), "conv_id", "left_semi")
    kept = kept.withColumn("segment", F.floor(F.col("place") / segment))
    lines = F.array_sort(F.collect_list(F.struct("place", render(F.col("role"), F.col("text")).alias("line"))))
    out = kept.groupBy("conv_id", "segment").agg(
        F.min("place").alias("first_turn"), F.count("*").alias("n_turns"), lines.alias("lines")
    )
    text = F.concat_ws("", F.col("lines.line"))
    return out.select("conv_id", "segment", "first_turn", "n_turns", text.alias("rendered"))
