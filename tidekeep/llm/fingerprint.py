"""Document fingerprints from prefix polynomial hashes.

`Prefix` keeps the hashes of all prefixes of a text, modulo two primes. The hash of any span follows from two of them, so
spans of one or two texts are compared in constant time, and the longest common extension of two places is found by binary
search. A fingerprint is the length of the text, the hash of the whole, and the smallest hashes of its spans of `SPAN` code
points; a shorter text is one span. The likeness of two fingerprints estimates the share of their spans that they have in
common (Dice), 1 for equal texts only, and is bounded by what texts of these lengths can share.

Edited texts follow the documents in descending id: the documents are dealt into ranges of ids, each range is sorted and
streamed, and the first document of a range is sent to the range before it as well. One shuffle moves each text once.

A null text is empty. Empty texts have a fingerprint without spans, like each other and nothing else. Rows with equal ids
follow one another by their text; rows without an id come last. A single document is followed by itself. Other columns are
not looked at.
"""

from __future__ import annotations

import bisect
import hashlib
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import small_batches
from .tokens import mix

PRIMES = (2147483647, 2147483629)
BASES = (1000003, 998244353)
SPAN = 12
KEPT = 64
RANGE_BYTES = 4 << 20
MOST_RANGES = 10_000

INVERSES = tuple(pow(b, -1, p) for b, p in zip(BASES, PRIMES, strict=True))
BLOCK = 1 << 15


def _table(base: int, p: int, n: int) -> np.ndarray:
    out, done, step = np.ones(n, np.uint64), 1, base % p
    while done < n:
        take = min(done, n - done)
        out[done : done + take] = out[:take] * np.uint64(step) % np.uint64(p)
        done, step = done + take, step * step % p
    return out


@cache
def _tables() -> list[tuple[np.ndarray, np.ndarray]]:
    """Powers of each base and of its inverse, modulo its prime, for a block of places; longer texts go block by block."""
    each = zip(BASES, INVERSES, PRIMES, strict=True)
    return [(_table(b, p, BLOCK), _table(inverse, p, BLOCK)) for b, inverse, p in each]


def _by_place(values: np.ndarray, table: np.ndarray, base: int, p: int) -> np.ndarray:
    """Values of less than 33 bits times the powers of the base by their places; table: its powers for the first block."""
    q = np.uint64(p)
    if len(values) <= len(table):
        return values * table[: len(values)] % q
    out = np.empty(len(values), np.uint64)
    for at in range(0, len(values), len(table)):
        part = values[at : at + len(table)]
        out[at : at + len(part)] = part * table[: len(part)] % q * np.uint64(pow(base, at, p)) % q
    return out


class Prefix:
    """Prefix hashes of a text's code points."""

    def __init__(self, text: str):
        self.codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        self.n = len(self.codes)
        self.sums = []
        wide = self.codes.astype(np.uint64) + np.uint64(1)
        for (power, _), b, p in zip(_tables(), BASES, PRIMES, strict=True):
            run = np.zeros(self.n + 1, np.uint64)
            np.cumsum(_by_place(wide, power, b, p), out=run[1:])
            self.sums.append(run % np.uint64(p))

    def span(self, at: int, size: int) -> tuple[int, ...]:
        """The hash of a span: equal for equal spans wherever they stand."""
        out = []
        for run, inverse, p in zip(self.sums, INVERSES, PRIMES, strict=True):
            out.append((int(run[at + size]) - int(run[at])) * pow(inverse, at, p) % p)
        return tuple(out)

    def spans(self, size: int) -> np.ndarray:
        """Mixed hashes of all spans of the size; of the whole text if it is shorter."""
        if not self.n:
            return np.zeros(0, np.uint64)
        size = min(size, self.n)
        both = []
        for run, (_, table), inverse, p in zip(self.sums, _tables(), INVERSES, PRIMES, strict=True):
            q = np.uint64(p)
            both.append(_by_place((run[size:] + q - run[:-size]) % q, table, inverse, p))
        return mix((both[0] << np.uint64(32)) ^ both[1] ^ np.uint64(size << 58))


def extension(a: Prefix, i: int, b: Prefix, j: int) -> int:
    """How many code points are equal from place i of a and place j of b on."""
    most = min(a.n - i, b.n - j)
    return bisect.bisect_left(range(1, most + 1), True, key=lambda k: a.span(i, k) != b.span(j, k))


def _distinct(values: np.ndarray) -> np.ndarray:
    """The distinct values, ascending; a sort is faster here than the hashing of np.unique."""
    values = np.sort(values)
    return values[np.concatenate(([True], values[1:] != values[:-1]))] if len(values) else values


def _smallest(values: np.ndarray) -> np.ndarray:
    few = 4 * KEPT
    if len(values) > few:
        low = _distinct(np.partition(values, few)[:few])
        if len(low) >= KEPT:
            return low[:KEPT]
    return _distinct(values)[:KEPT]


class Fingerprint:
    def __init__(self, n: int, whole: tuple[int, ...], values: np.ndarray):
        self.n, self.whole, self.values = n, whole, values  # values: distinct, ascending

    def __str__(self) -> str:
        return f"{self.n}:{''.join(f'{h:08x}' for h in self.whole)}:{self.values.astype('>u8').tobytes().hex()}"

    @staticmethod
    def parse(text: str) -> Fingerprint:
        n, whole, values = text.split(":")
        return Fingerprint(
            int(n), (int(whole[:8], 16), int(whole[8:], 16)), np.frombuffer(bytes.fromhex(values), ">u8").astype(np.uint64)
        )


def fingerprint(text: str | None) -> Fingerprint:
    x = Prefix(text or "")
    return Fingerprint(x.n, x.span(0, x.n), _smallest(x.spans(SPAN)))


def likeness(a: Fingerprint, b: Fingerprint) -> float:
    if a.n == b.n and a.whole == b.whole:
        return 1.0
    if not a.n or not b.n:
        return 0.0
    both = np.sort(np.concatenate((a.values, b.values)))
    twice = both[1:] == both[:-1]
    common, union = both[1:][twice], both[np.concatenate(([True], ~twice))]
    if max(len(a.values), len(b.values)) >= KEPT:
        union = union[:KEPT]
    j = np.searchsorted(common, union[-1], "right") / len(union)
    return float(min(2 * j / (1 + j), 2 * min(a.n, b.n) / (a.n + b.n), 1 - 1 / (a.n + b.n)))


class _Document:
    def __init__(self, doc_id, text: str | None):
        self.doc_id, self.text = doc_id, text or ""
        self.prefix = Prefix(self.text)
        self.spans = self.prefix.spans(SPAN)
        self.print = Fingerprint(self.prefix.n, self.prefix.span(0, self.prefix.n), _smallest(self.spans))

    def edited(self, after: _Document) -> tuple[str, Fingerprint]:
        """The text whose last half gives way to the first half, or all, of the next, and its fingerprint.

        Prefix hashes and spans of both texts are used again; only spans across the seam are new.
        """
        n = self.prefix.n
        keep, take = n - n // 2, min(n // 2, after.prefix.n)
        text = self.text[:keep] + after.text[:take]
        total = keep + take
        if total <= 2 * SPAN:
            return text, fingerprint(text)
        seam = Prefix(text[max(0, keep - SPAN + 1) : keep + SPAN - 1])
        parts = [self.spans[: max(0, keep - SPAN + 1)] if keep >= SPAN else self.spans[:0]]
        if seam.n >= SPAN:
            parts.append(seam.spans(SPAN))
        if take >= SPAN:
            parts.append(after.spans[: take - SPAN + 1])
        whole = []
        for k, (b, p) in enumerate(zip(BASES, PRIMES, strict=True)):
            ahead = int(after.prefix.sums[k][take]) * pow(b, keep, p)
            whole.append((int(self.prefix.sums[k][keep]) + ahead) % p)
        return text, Fingerprint(total, tuple(whole), _smallest(np.concatenate(parts)))

    def row(self, after: _Document) -> tuple:
        text, changed = self.edited(after)
        return (
            self.doc_id,
            self.prefix.n,
            hashlib.sha256(text.encode()).hexdigest(),
            str(self.print),
            str(changed),
            likeness(self.print, changed),
            likeness(self.print, after.print),
            extension(self.prefix, 0, after.prefix, 0),
        )


_SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
        ("same_start", pa.int64()),
    ]
)
_LEAST = -(1 << 63)


def _in_ranges(docs: DataFrame) -> DataFrame:
    """doc_id, key, text, range, guest: each document in its range, and as a guest at the end of the range before it."""
    spark = docs.sparkSession
    slim = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    slim = slim.withColumn("key", F.coalesce("doc_id", F.lit(_LEAST)))
    weight = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(-(-weight // RANGE_BYTES), 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    n = min(n, MOST_RANGES)
    cuts = slim.agg(
        F.percentile_approx("key", [k / n for k in range(1, n)], 20 * n).alias("cuts")
    ).first()[0]  # at most MOST_RANGES numbers
    cuts = np.unique(np.array(cuts or [], np.int64))

    @pandas_udf("int")
    def range_of(key):
        import pandas as pd

        return pd.Series(len(cuts) - np.searchsorted(cuts, key.to_numpy(), "right"))

    placed = slim.withColumn("range", range_of("key"))
    heads = placed.groupBy("range").agg(F.max("key").alias("key")).orderBy("range").collect()  # one row per range
    before = {h["key"]: heads[k - 1]["range"] for k, h in enumerate(heads)}
    keys = np.array(sorted(before), np.int64)
    target = np.array([before[k] for k in keys.tolist()], np.int32)

    @pandas_udf("int")
    def guest_of(key):
        import pandas as pd

        at = np.minimum(np.searchsorted(keys, key.to_numpy()), len(keys) - 1)
        return pd.Series(np.where(keys[at] == key.to_numpy(), target[at], -1))

    own = F.struct(F.col("range"), F.lit(False).alias("guest"))
    visit = F.struct(F.col("to").alias("range"), F.lit(True).alias("guest"))
    placed = placed.withColumn("to", guest_of("key"))
    placed = placed.withColumn("at", F.explode(F.when(F.col("to") >= 0, F.array(own, visit)).otherwise(F.array(own))))
    return placed.select("doc_id", "key", "text", "at.range", "at.guest")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how like they are, a row per document.

    same_start counts the code points that a document and the next one begin with in common.
    """
    small_batches(docs.sparkSession)
    ranges = _in_ranges(docs)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = ranges.repartition(parts, "range")
    ranges = ranges.sortWithinPartitions("range", "guest", F.desc("key"), "text")

    def run(batches):
        waiting, where, rows = None, None, []
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("doc_id", "text", "range", "guest"))
            for doc_id, text, at, guest in zip(*columns, strict=True):
                if at == where and waiting is None:
                    continue
                here = _Document(doc_id, text)
                if at == where:
                    rows.append(waiting.row(here))
                waiting, where = None if guest else here, at
            columns = zip(*rows, strict=True) if rows else ([] for _ in _SCHEMA)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SCHEMA, strict=True)], schema=_SCHEMA)
            rows = []

    return ranges.select("doc_id", "text", "range", "guest").mapInArrow(
        run,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
        " near_edited double, near_next double, same_start long",
    )
