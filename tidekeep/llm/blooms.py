"""Blocked counting Bloom filters over 64-bit keys, made and merged by Spark.

A key's block follows from its upper bits and its counters inside the block from its lower bits, so blocks are merged apart
from each other: tasks send the keys they saw, a repeated one at most `least` times, and a block's counters meet in one task of
1 MB, however often a key occurs. Counters stop at `least`; what is kept of a block is which counters reached it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BITS = 20
PROBES = 4
FLUSH = 1 << 18
# Bytes of a block as it is kept.
BLOCK_BYTES = (1 << BLOCK_BITS) // 8
_MASK = (1 << BLOCK_BITS) - 1


def _block(keys: np.ndarray, blocks: int) -> np.ndarray:
    return ((keys >> np.uint64(2 * BLOCK_BITS)) % np.uint64(blocks)).astype(np.int64)


def _places(keys: np.ndarray) -> np.ndarray:
    """Counter numbers of each key, one row per probe."""
    mask = np.uint64(_MASK)
    step = (keys >> np.uint64(BLOCK_BITS)) & mask | np.uint64(1)
    return np.stack([((keys & mask) + np.uint64(i) * step) & mask for i in range(PROBES)]).astype(np.int64)


def merged_blocks(keys: DataFrame, blocks: int, least: int) -> DataFrame:
    """The filter of a frame's one column of 64-bit keys: block, words (64 counters each, bit set: reached `least`).

    Blocks without a key are absent. Null keys are left out.
    """

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def send() -> pa.RecordBatch:
            key, count = np.unique(np.concatenate(held), return_counts=True)
            key = np.repeat(key, np.minimum(count, least))
            block = _block(key, blocks)
            order = np.argsort(block, kind="stable")
            own, first = np.unique(block[order], return_index=True)
            at = np.append(first, len(key)).astype(np.int64) * 8
            packed = pa.Array.from_buffers(
                pa.large_binary(), len(own), [None, pa.py_buffer(at.tobytes()), pa.py_buffer(key[order].tobytes())]
            )
            return pa.record_batch([pa.array(own, pa.int32()), packed.cast(pa.binary())], ["block", "keys"])

        for batch in batches:
            held.append(batch.column(0).drop_null().to_numpy(zero_copy_only=False).view(np.uint64))
            n += len(held[-1])
            if n >= FLUSH:
                yield send()
                held, n = [], 0
        if n:
            yield send()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, now = None, None

        def done() -> pa.RecordBatch:
            words = np.packbits(counts >= least, bitorder="little").view(np.int64)
            return pa.record_batch([pa.array([now], pa.int32()), pa.array([words], pa.list_(pa.int64()))], ["block", "words"])

        for batch in batches:
            for block, packed in zip(batch.column(0).to_pylist(), batch.column(1)):
                if block != now:
                    if now is not None:
                        yield done()
                    counts, now = np.zeros(1 << BLOCK_BITS, np.uint8), block
                places = _places(np.frombuffer(packed.as_buffer(), np.uint64))
                for low in range(0, places.shape[1], 1 << 16):
                    hit, times = np.unique(places[:, low : low + (1 << 16)], return_counts=True)
                    counts[hit] = np.minimum(counts[hit] + np.minimum(times, least), least)
        if now is not None:
            yield done()

    sent = keys.mapInArrow(gather, "block int, keys binary")
    by_block = sent.repartition("block").sortWithinPartitions("block")
    return by_block.mapInArrow(merge, "block int, words array<bigint>")


def block_of(key: Column, blocks: int) -> Column:
    return F.pmod(F.shiftrightunsigned(key, 2 * BLOCK_BITS), F.lit(blocks)).cast("int")


def reached(key: Column, words: Column) -> Column:
    """Whether all counters of a key reached `least`, given its block's words; for a block without words it is false."""
    step = F.shiftrightunsigned(key, BLOCK_BITS).bitwiseAND(F.lit(_MASK)).bitwiseOR(F.lit(1))
    low = key.bitwiseAND(F.lit(_MASK))
    all_set = F.lit(True)
    for i in range(PROBES):
        place = (low + step * i).bitwiseAND(F.lit(_MASK))
        bit = F.getbit(F.get(words, F.shiftright(place, 6).cast("int")), place.bitwiseAND(F.lit(63)).cast("int"))
        all_set = all_set & (F.coalesce(bit, F.lit(0)) == 1)
    return all_set


class Bits:
    """A filter gathered on the driver, at most `blocks` blocks of 128 KB, for look-ups in numpy."""

    def __init__(self, rows: DataFrame, blocks: int):
        self.blocks = blocks
        self.table = np.zeros((blocks, BLOCK_BYTES), np.uint8)
        for row in rows.toLocalIterator():
            self.table[row["block"]] = np.array(row["words"], np.int64).view(np.uint8)

    def holds(self, keys: np.ndarray) -> np.ndarray:
        """Whether each key may be among those the filter was made of; none of them is ever denied."""
        block, out = _block(keys, self.blocks), np.ones(len(keys), bool)
        for place in _places(keys):
            out &= (self.table[block, place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
        return out


def blocks_for(n: int, keys_per_block: int, most: int) -> int:
    return max(1, min(most, -(-n // keys_per_block)))
