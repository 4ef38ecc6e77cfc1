"""Token ids of whole texts with a tokenizer file, encoding each distinct stretch of a text once.

The byte-level pre-tokenizer never joins what stands before the last space of a gap with what follows, nor a letter with a
following mark. Texts are cut there, the distinct stretches of a run of texts are encoded, and ids are put together again by
array lookups. A bounded table of stretches seen first is kept between runs. A tokenizer of another kind gets whole texts.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .windows import windows

# Bytes that surely are not the start of white space: printable ASCII, and lead bytes of letters and marks.
_SOLID = np.zeros(256, bool)
_SOLID[0x21:0x7F] = True
_SOLID[0xC3:0xF5] = True
_SOLID[[0xE1, 0xE2, 0xE3]] = False
_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
_MARK = np.zeros(256, bool)
_MARK[list(b".,;:!?\n")] = True

WINDOW = 4 << 20
KEPT = 250_000
# Bytes of new stretches encoded in one call.
JOINED = 4096


def _gaps(data: np.ndarray) -> np.ndarray:
    """Where a space is followed by something solid: both sides are encoded alike, apart or together."""
    cut = np.zeros(len(data), bool)
    cut[:-1] = (data[:-1] == 0x20) & _SOLID[data[1:]]
    return cut


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of several ranges in a row."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


class Encoder:
    def __init__(self, path: str, kept: int = KEPT, window: int = WINDOW):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        split = spec.get("pre_tokenizer") or {}
        self.apart = (
            split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
            and not spec.get("normalizer")
        )
        self.window = window
        # A byte-level token has one character per byte.
        self.bytes_of = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        for token, i in self.tokenizer.get_vocab().items():
            self.bytes_of[i] = len(token)
        self.kept = kept
        self.known = pa.array([], pa.large_string())
        self.first, self.count, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def _whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        counts = np.array([len(i) for i in found], np.int64)
        return np.concatenate([np.zeros(0, np.uint32), *[np.array(i, np.uint32) for i in found]]), counts

    def _new(self, texts: list[str], sizes: np.ndarray, alone: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of stretches, and how many each has. All but the first `alone` may follow another one in a joined text."""
        ends = np.concatenate([[0], np.cumsum(sizes)])
        joined, i = texts[:alone], alone
        while i < len(texts):
            stop = max(i + 1, int(np.searchsorted(ends, ends[i] + JOINED)))
            joined.append("".join(texts[i:stop]))
            i = stop
        ids, _ = self._whole(joined)
        at = np.concatenate([[0], np.cumsum(self.bytes_of[ids])])
        place = np.searchsorted(at, ends)
        if not np.array_equal(at[place], ends):
            raise ValueError("the tokenizer joined what its pre-tokenizer parts")
        return ids, np.diff(place)

    def _window(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a window's texts, and how many each text has."""
        cut = np.zeros(len(data) + 1, bool)
        cut[at] = True
        cut[:-1] |= _gaps(data)
        cut[1:-1] |= _LETTER[data[:-1]] & _MARK[data[1:]]
        edges = np.flatnonzero(cut)
        buffers = [None, pa.py_buffer(edges.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes())]
        coded = pa.Array.from_buffers(pa.large_string(), len(edges) - 1, buffers).dictionary_encode()
        stretches = coded.dictionary
        slot = pc.index_in(stretches, value_set=self.known).fill_null(-1).to_numpy(zero_copy_only=False)
        old, new = np.flatnonzero(slot >= 0), np.flatnonzero(slot < 0)
        start, count = np.zeros(len(stretches), np.int64), np.zeros(len(stretches), np.int64)
        start[old], count[old] = self.first[slot[old]], self.count[slot[old]]
        ids = self.ids
        if len(new):
            begin = np.frombuffer(stretches.buffers()[1], np.int64)[: len(stretches) + 1]
            sizes, begin = np.diff(begin)[new], begin[new]
            letters = np.frombuffer(stretches.buffers()[2], np.uint8)
            joins = (sizes > 1) & (letters[begin] == 0x20) & _SOLID[letters[np.minimum(begin + 1, len(letters) - 1)]]
            order = np.argsort(joins, kind="stable")
            new, sizes = new[order], sizes[order]
            found, counts = self._new(stretches.take(pa.array(new)).to_pylist(), sizes, int((~joins).sum()))
            ends = np.cumsum(counts)
            start[new], count[new] = len(ids) + ends - counts, counts
            room = min(self.kept - len(self.known), len(new))
            if room > 0:
                self.known = pa.concat_arrays([self.known, stretches.take(pa.array(new[:room]))])
                self.first = np.concatenate([self.first, start[new[:room]]])
                self.count = np.concatenate([self.count, counts[:room]])
                self.ids = np.concatenate([ids, found[: ends[room - 1]]])
            ids = np.concatenate([ids, found])
        code = coded.indices.to_numpy()
        counts = count[code]
        ends = np.concatenate([[0], np.cumsum(counts)])
        return ids[_ranges(start[code], counts)], np.diff(ends[np.searchsorted(edges, at)])

    def encode(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts given as UTF-8 bytes and offsets, in a row, and how many each text has."""
        if not self.apart:
            raw = data.tobytes()
            return self._whole([raw[a:b].decode() for a, b in zip(at, at[1:])])
        ids, counts = [np.zeros(0, np.uint32)], np.zeros(len(at) - 1, np.int64)
        for part, inside, first in windows(at, data, _gaps, self.window):
            own, n = self._window(part, inside)
            ids.append(own)
            counts[first : first + len(n)] += n
        return np.concatenate(ids), counts
