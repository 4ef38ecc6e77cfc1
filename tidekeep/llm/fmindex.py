"""An FM-index over a shard of words: suffix order, a wavelet tree over the transform, and sampled suffix positions."""

from __future__ import annotations

import numpy as np

SAMPLE = 16


class _Bits:
    """A bit vector that counts its ones before a place."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        packed = np.zeros((n // 64 + 1) * 8, np.uint8)
        part = np.packbits(bits, bitorder="little")
        packed[: len(part)] = part
        self.words = packed.view(np.uint64)
        self.before = np.zeros(len(self.words) + 1, np.int32)
        np.cumsum(np.bitwise_count(self.words), out=self.before[1:])

    def ones(self, at: np.ndarray) -> np.ndarray:
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        low = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[word] + np.bitwise_count(low)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1


class WaveletTree:
    """Ranks of symbols in a sequence, a level per bit of the symbols: zeros go left, ones right (a wavelet matrix)."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.levels: list[tuple[_Bits, int, int]] = []
        for shift in range(bits - 1, -1, -1):
            bit = (symbols >> shift) & 1 == 1
            zeros = symbols[~bit]
            self.levels.append((_Bits(bit), len(zeros), shift))
            symbols = np.concatenate([zeros, symbols[bit]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        start, at = np.zeros_like(at), at.copy()
        for bits, zeros, shift in self.levels:
            one = (symbol >> shift) & 1 == 1
            a, b = bits.ones(start), bits.ones(at)
            start = np.where(one, zeros + a, start - a)
            at = np.where(one, zeros + b, at - b)
        return at - start

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place, and its rank there."""
        symbol, start, at = np.zeros_like(at), np.zeros_like(at), at.copy()
        for bits, zeros, shift in self.levels:
            one = bits.get(at)
            symbol |= one.astype(symbol.dtype) << shift
            a, b = bits.ones(start), bits.ones(at)
            start = np.where(one, zeros + a, start - a)
            at = np.where(one, zeros + b, at - b)
        return symbol, at - start


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Start of each suffix in order, by prefix doubling; each round sorts only the suffixes that are still tied."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable").astype(np.int32)
    new = np.ones(n, bool)
    new[1:] = symbols[order[1:]] != symbols[order[:-1]]
    rank = np.empty(n, np.int32)
    group = np.maximum.accumulate(np.where(new, np.arange(n, dtype=np.int32), np.int32(0)))
    rank[order] = group
    tied = np.flatnonzero(~(new & np.append(new[1:], True))).astype(np.int32)
    span = 1
    while len(tied):
        at = order[tied]
        ahead = at + span
        second = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        # Places stay within their group, so one sort by (group, next rank) puts every tied group in order.
        key = group[tied].astype(np.int64) * (n + 1) + second
        by = np.argsort(key)
        key, at = key[by], at[by]
        order[tied] = at
        new = np.ones(len(tied), bool)
        new[1:] = key[1:] != key[:-1]
        first = np.maximum.accumulate(np.where(new, np.arange(len(tied)), 0))
        group[tied] = tied[first]
        rank[at] = group[tied]
        tied = tied[~(new & np.append(new[1:], True))]
        span *= 2
    return order


class FMIndex:
    """Counts and finds runs of words in a shard of under 2^31. symbols: one per word, from 1; 0 is kept for the end."""

    def __init__(self, symbols: np.ndarray, size: int):
        text = np.append(symbols, 0).astype(np.int32)
        order = suffix_order(text)
        self.starts = np.zeros(size + 2, np.int64)
        np.cumsum(np.bincount(text, minlength=size + 1), out=self.starts[1:])
        self.tree = WaveletTree(text[order - 1], max(1, int(size).bit_length()))
        marked = order % SAMPLE == 0
        self.marks, self.places = _Bits(marked), order[marked]
        self.n = len(text)

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The range of suffixes that begin with each phrase (a row, padded on the right), by backward search."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        for i in range(phrases.shape[1] - 1, -1, -1):
            live = np.flatnonzero((i < lengths) & (low < high))
            if len(live):
                c = phrases[live, i]
                both = self.tree.rank(np.concatenate([c, c]), np.concatenate([low[live], high[live]]))
                low[live] = self.starts[c] + both[: len(live)]
                high[live] = self.starts[c] + both[len(live) :]
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Where the suffix of each row starts: steps back through the text to the next sampled suffix."""
        rows, out, steps = rows.copy(), np.zeros(len(rows), np.int64), 0
        live = np.arange(len(rows))
        while len(live):
            here = rows[live]
            hit = self.marks.get(here)
            out[live[hit]] = self.places[self.marks.ones(here[hit])] + steps
            live = live[~hit]
            symbol, rank = self.tree.access(rows[live])
            rows[live] = self.starts[symbol] + rank
            steps += 1
        return out
