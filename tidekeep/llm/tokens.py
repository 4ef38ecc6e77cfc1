"""Words of Arrow string columns as numpy arrays: boundaries, owners and 64-bit keys, without a Python object per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes that part words. UTF-8 never uses an ASCII byte inside a longer sequence, so bytes decide as code points would.
SPACES = bytes([0x20, *range(0x09, 0x0E)])
NOT_ALNUM = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.ones(max(n, 1), np.uint64)
    done = 1
    with np.errstate(over="ignore"):
        step = base
        while done < n:
            take = min(done, n - done)
            out[done : done + take] = out[:take] * step
            done += take
            step = step * step
    return out


_cache: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(16, int(n).bit_length())
    if size not in _cache:
        _cache.clear()
        _cache[size] = _powers(_BASE, size), _powers(_BASE_INV, size)
    return _cache[size]


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit values that spreads every input bit (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column in a row, and where each value starts (one more entry than values). Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts stay under the limit; a longer text is a run of its own."""
    _, at = utf8(batch.column(column))
    start = 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(at, at[start] + limit, "right")) - 1)
        yield batch.slice(start, stop - start)
        start = stop


class Words:
    """Words of a run of texts. starts, ends: byte positions in data; counts: words of each text; first: index of its first word."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, apart: bytes, lower: bool = True):
        if lower:
            table = np.arange(256, dtype=np.uint8)
            table[65:91] += 32
            data = table[data]
        inside = np.ones(256, bool)
        inside[list(apart)] = False
        inside = inside[data]
        before = np.empty_like(inside)
        before[1:] = inside[:-1]
        after = np.empty_like(inside)
        after[:-1] = inside[1:]
        edges = offsets[:-1][offsets[:-1] < len(data)]
        before[edges] = False
        after[offsets[1:][offsets[1:] > 0] - 1] = False
        self.data = data
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)

    def __len__(self) -> int:
        return len(self.starts)

    def keys(self) -> np.ndarray:
        """A 64-bit key of each word's bytes: a polynomial in an odd base, taken from one running sum."""
        power, inverse = _tables(len(self.data) + 1)
        with np.errstate(over="ignore"):
            run = np.zeros(len(self.data) + 1, np.uint64)
            np.cumsum(_BYTE[self.data] * power[: len(self.data)], out=run[1:])
            return mix((run[self.ends] - run[self.starts]) * inverse[self.starts] + (self.ends - self.starts).astype(np.uint64))

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def strings(self, which: np.ndarray) -> pa.Array:
        """The chosen words as an Arrow string array."""
        lengths = (self.ends - self.starts)[which]
        at = np.zeros(len(which) + 1, np.int64)
        np.cumsum(lengths, out=at[1:])
        take = np.repeat(self.starts[which] - at[:-1], lengths) + np.arange(at[-1])
        return pa.Array.from_buffers(
            pa.large_string(), len(which), [None, pa.py_buffer(at.tobytes()), pa.py_buffer(self.data[take].tobytes())]
        )


def words_of(column: pa.Array, apart: bytes) -> Words:
    return Words(*utf8(column), apart)


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of runs of `size` words in ascending order within each text, and how many each text has.

    A text of fewer words, but not none, has its whole sequence as its one shingle.
    """
    keys, counts, first = words.keys(), words.counts, words.first
    with np.errstate(over="ignore"):
        if len(keys) >= size:
            run = np.zeros(len(keys) - size + 1, np.uint64)
            for i in range(size):
                run = mix(run * _BASE + keys[i : len(keys) - size + 1 + i])
        else:
            run = np.zeros(0, np.uint64)
        owner = words.owners()[: len(run)]
        keep = np.arange(len(run)) + size <= first[owner + 1]
        short = np.flatnonzero((counts > 0) & (counts < size))
        whole = np.zeros(len(short), np.uint64)
        for i in range(size - 1):
            has = counts[short] > i
            whole[has] = mix(whole[has] * _BASE + keys[first[short[has]] + i])
    owner = np.concatenate([owner[keep], short])
    value = np.concatenate([run[keep], mix(whole + counts[short].astype(np.uint64))])
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    return value[new], np.bincount(owner[new], minlength=len(counts))
