"""Packing tokenised documents into sequences: best fit, then exchanges between sequences that are not full.

Documents become pieces: one, or full ones and a first rest. Full pieces are sequences already. The others, slim rows of a
number and a length, are dealt to groups of bounded size by a hash; a task packs a group best fit, longest first, and improves
it by exchanges. What is still not full is dealt anew to fewer groups, until one group is left or a round empties next to none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import Encoder
from .common import small_batches
from .tokens import slices, utf8
from tidekeep.session import scratch_path

SIZE = 1024
END = 2
# Pieces dealt to a group on average.
GROUP = 16384
# A further round must have emptied this share of the open sequences in the one before.
WORTH = 0.002
_encoders: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders.clear()
        _encoders[path] = Encoder(path)
    return _encoders[path]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def cut_pieces(counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Owner, number, start and length of the pieces of texts of `counts` ids: the first takes what full ones leave."""
    n = -(-counts // size)
    owner = np.repeat(np.arange(len(counts)), n)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    rest = (counts - 1) % size + 1
    start = np.where(number > 0, rest[owner] + (number - 1) * size, 0)
    return owner, number, start, np.where(number > 0, size, rest[owner])


def pieces(docs: DataFrame, path: str | None = None, size: int = SIZE, end: int = END) -> DataFrame:
    """Pieces of every document, null text as empty: doc_id, piece, start, length, ids (little-endian, 32 bits each), item.

    item numbers the stored pieces. Documents keep their id, a null or repeated one too.
    """
    spark, path = docs.sparkSession, path or default_tokenizer()
    small_batches(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        for batch in batches:
            for rows in slices(batch, "text", 4 << 20):
                ids, counts = encoder.encode(*utf8(rows.column("text")))
                ends = np.cumsum(counts)
                ids = np.insert(ids, ends, end).astype("<u4")
                owner, number, start, length = cut_pieces(counts + 1, size)
                at = np.concatenate([[0], np.cumsum(length)]).astype(np.int64) * 4
                packed = pa.Array.from_buffers(
                    pa.large_binary(), len(owner), [None, pa.py_buffer(at.tobytes()), pa.py_buffer(ids.tobytes())]
                )
                yield pa.record_batch(
                    [rows.column("doc_id").take(pa.array(owner)), pa.array(number, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), packed.cast(pa.binary())],
                    ["doc_id", "piece", "start", "length", "ids"],
                )

    made = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids binary")
    made = made.withColumn("item", F.monotonically_increasing_id())
    where = scratch_path(spark, "pieces")
    made.write.option("compression", "zstd").parquet(where)
    return spark.read.schema(made.schema).parquet(where)


class Bins:
    """Sequences that are not full, and where in them a piece of a given length, or two of a given sum, can be found."""

    def __init__(self, size: int):
        self.size = size
        self.items: list[dict[int, list[int]]] = []  # by length, the pieces of each sequence
        self.fill: list[int] = []
        self.one: list[set[int]] = [set() for _ in range(size + 1)]  # by length, sequences
        self.two: list[dict[int, tuple[int, int]]] = [{} for _ in range(size + 1)]  # by sum, a pair of lengths of each sequence
        self.has_one = self.has_two = 0  # bit masks of the lengths and sums there are

    def add(self, items: dict[int, list[int]]) -> int:
        self.items.append(items)
        self.fill.append(sum(length * len(own) for length, own in items.items()))
        self._enter(len(self.items) - 1)
        return len(self.items) - 1

    def _pairs(self, k: int) -> Iterator[tuple[int, int]]:
        lengths = sorted(self.items[k])
        for i, a in enumerate(lengths):
            if len(self.items[k][a]) > 1 and 2 * a < self.size:
                yield a, a
            for b in lengths[i + 1 :]:
                if a + b >= self.size:
                    break
                yield a, b

    def _enter(self, k: int) -> None:
        if self.fill[k] >= self.size:
            return  # full ones are left as they are
        for a in self.items[k]:
            self.one[a].add(k)
            self.has_one |= 1 << a
        for a, b in self._pairs(k):
            self.two[a + b][k] = (a, b)
            self.has_two |= 1 << (a + b)

    def _leave(self, k: int) -> None:
        for a in self.items[k]:
            self.one[a].discard(k)
            if not self.one[a]:
                self.has_one &= ~(1 << a)
        for a, b in self._pairs(k):
            self.two[a + b].pop(k, None)
            if not self.two[a + b]:
                self.has_two &= ~(1 << (a + b))

    def exchange(self, k: int, give: tuple[int, ...], other: int, take: tuple[int, ...]) -> None:
        self._leave(k)
        self._leave(other)
        for source, target, lengths in ((k, other, give), (other, k, take)):
            for length in lengths:
                own = self.items[source][length]
                self.items[target].setdefault(length, []).append(own.pop())
                if not own:
                    del self.items[source][length]
                self.fill[source] -= length
                self.fill[target] += length
        self._enter(k)
        self._enter(other)

    def best(self, k: int) -> tuple[tuple[int, ...], int, tuple[int, ...]] | None:
        """The exchange that fills sequence k most and increases the sum of squared fills: given, other, taken."""
        gap, found, most = self.size - self.fill[k], None, 0
        gives = [((), 0)] + [((a,), a) for a in self.items[k]] + [(p, sum(p)) for p in self._pairs(k)]
        for give, out in gives:
            if out == self.fill[k]:
                continue  # whoever holds what is taken is at least as full
            for table, mask in ((self.one, self.has_one), (self.two, self.has_two)):
                if table is self.two and len(give) != 1:
                    continue  # two for one, one for two, one for one, or a move
                low = out + most + 1
                there = (mask & ((1 << (out + gap + 1)) - 1)) >> low
                while there:
                    length = low + there.bit_length() - 1
                    gain = length - out
                    others = [o for o in table[length] if o != k and self.fill[o] < self.fill[k] + gain]
                    if others:
                        other = min(others, key=self.fill.__getitem__)
                        found, most = (give, other, (length,) if table is self.one else table[length][other]), gain
                        if gain == gap:
                            return found
                        break
                    there &= (1 << (length - low)) - 1
        return found

    def improve(self) -> None:
        """Exchange between sequences that are not full, fullest first, until none helps. The sum of squares grows each time."""
        while True:
            changed = False
            for k in sorted((k for k, f in enumerate(self.fill) if 0 < f < self.size), key=lambda k: -self.fill[k]):
                while 0 < self.fill[k] < self.size and (step := self.best(k)):
                    self.exchange(k, *step)
                    changed = True
            if not changed:
                return


def best_fit(lengths: list[tuple[int, int]], size: int) -> list[dict[int, list[int]]]:
    """(length, piece) longest first, each into the sequence it fills most."""
    out: list[dict[int, list[int]]] = []
    room: list[list[int]] = [[] for _ in range(size + 1)]
    there = 0
    for length, item in sorted(lengths, reverse=True):
        fits = there >> length
        if fits:
            left = length + (fits & -fits).bit_length() - 1
            k = room[left].pop()
            if not room[left]:
                there &= ~(1 << left)
        else:
            k, left = len(out), size
            out.append({})
        out[k].setdefault(length, []).append(item)
        room[left - length].append(k)
        there |= 1 << (left - length)
    return out


def pack_group(items: np.ndarray, lengths: np.ndarray, held: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequence, offset and fill of each piece of a group. held: the sequence a piece is in already, or -1 for every piece.

    A sequence is named by the smallest piece in it.
    """
    starts = [best_fit(list(zip(lengths.tolist(), items.tolist())), size)]
    if len(held) and held[0] >= 0:
        by_bin: dict[int, dict[int, list[int]]] = {}
        for item, length, k in sorted(zip(items.tolist(), lengths.tolist(), held.tolist())):
            by_bin.setdefault(k, {}).setdefault(length, []).append(item)
        starts.insert(0, list(by_bin.values()))
    tried = []
    for start in starts:  # as it came, and packed anew: the fewer sequences win, then the greater sum of squares
        bins = Bins(size)
        for own in start:
            bins.add(own)
        bins.improve()
        tried.append(bins)
    bins = min(tried, key=lambda b: (sum(f > 0 for f in b.fill), -sum(f * f for f in b.fill)))
    place = {}
    for own, fill in zip(bins.items, bins.fill):
        flat = sorted((item, length) for length, its in own.items() for item in its)
        at = 0
        for item, length in flat:
            place[item] = flat[0][0], at, fill
            at += length
    found = np.array([place[i] for i in items.tolist()], np.int64).reshape(-1, 3)
    return found[:, 0], found[:, 1], found[:, 2]


def place(items: DataFrame, size: int = SIZE, group: int = GROUP, worth: float = WORTH) -> DataFrame:
    """Sequence and offset of pieces shorter than a sequence. items: item, length."""
    spark = items.sparkSession
    schema = "item long, length long, sequence_id long, offset long, fill long"

    def run(table: pa.Table) -> pa.Table:
        item, length, held = (table.column(c).to_numpy() for c in ("item", "length", "sequence_id"))
        sequence, offset, fill = pack_group(item, length, held, size)
        return pa.table({"item": item, "length": length, "sequence_id": sequence, "offset": offset, "fill": fill})

    now = items.select("item", "length", F.lit(-1).cast("long").alias("sequence_id"))
    key, done, before, round_no = F.col("item"), [], None, 0
    while True:
        n = now.count()
        groups = max(1, -(-n // group))
        dealt = now.withColumn("__group", F.pmod(F.xxhash64(key, F.lit(round_no)), F.lit(groups)))
        path = scratch_path(spark, "placed")
        dealt.groupBy("__group").applyInArrow(run, schema).write.parquet(path)
        packed = spark.read.schema(schema).parquet(path)
        is_open = F.col("fill") < size
        left = packed.where(is_open).agg(F.count_distinct("sequence_id")).first()[0]
        if groups == 1 or before is not None and left > before * (1 - worth):
            done.append(packed)
            break
        done.append(packed.where(~is_open))
        now, key, before, round_no = packed.where(is_open).select("item", "length", "sequence_id"), F.col("sequence_id"), left, round_no + 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select("item", "sequence_id", "offset")


def pack(made: DataFrame, size: int = SIZE, group: int = GROUP) -> DataFrame:
    """Every piece with its sequence_id and offset: as few sequences of at most `size` ids as exchanges can make.

    made: from `pieces`, or any stored frame with a unique long `item` and a `length` of 1 to size; its other columns stay. A
    sequence is named by the smallest item in it, and filled without gaps in order of item. An empty table gives no rows.
    """
    short = place(made.where(F.col("length") < size).select("item", "length"), size, group)
    joined = made.join(short, "item", "left")
    return joined.withColumns(
        {"sequence_id": F.coalesce("sequence_id", "item"), "offset": F.coalesce("offset", F.lit(0).cast("long"))}
    )


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The packing without the ids: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    made = pieces(docs, path).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return pack(made).drop("item")
