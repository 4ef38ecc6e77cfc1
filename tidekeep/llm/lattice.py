"""All segmentations of words into pieces of a fixed vocabulary, by forward and backward recursion in log space."""

from __future__ import annotations

import numpy as np

from .tokens import _BASE, _BYTE, mix

# Marks the start of a word, as the vocabulary's U+2581 does; no word holds a space.
START = b" "
_INVERSE: list[np.uint64] = []
_LEAD = 18
_SHIFT = np.uint64(64 - _LEAD)


def load_pieces(path: str) -> tuple[list[bytes], np.ndarray]:
    """Pieces of a sentencepiece vocabulary as bytes and their scores, then one piece per byte with the lowest score."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces: dict[bytes, float] = {}
    for i in range(model.get_piece_size()):
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)):
            text = model.id_to_piece(i).encode().replace("▁".encode(), START)
            if text and START not in text[1:]:
                pieces.setdefault(text, model.get_score(i))
    lowest = min(pieces.values(), default=0.0)
    scores = [*pieces.values(), *[lowest] * 256]
    return list(pieces), np.array(scores)


def _spans(rows: np.ndarray) -> np.ndarray:
    """Running hash sums of each row, from which the key of any span follows."""
    with np.errstate(over="ignore"):
        power = np.cumprod(np.full(rows.shape[1], _BASE, np.uint64)) if rows.shape[1] else np.zeros(0, np.uint64)
        run = np.zeros((len(rows), rows.shape[1] + 1), np.uint64)
        np.cumsum(_BYTE[rows] * power, axis=1, out=run[:, 1:])
    return run


class Lattice:
    def __init__(self, pieces: list[bytes]):
        self.n = len(pieces)
        # Keys in order, their pieces, and which leading bits occur: most spans are no piece and are sorted out by these.
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        groups: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            groups.setdefault(len(p), []).append(i)
        for size, ids in groups.items():
            rows = np.frombuffer(b"".join(pieces[i] for i in ids), np.uint8).reshape(len(ids), size)
            keys = self._keys(_spans(rows), 0, size)
            order = np.argsort(keys)
            leads = np.zeros(1 << _LEAD, bool)
            leads[keys >> _SHIFT] = True
            self.by_length[size] = keys[order], np.array(ids)[order], leads

    @staticmethod
    def _keys(run: np.ndarray, i: int, j: int) -> np.ndarray:
        while len(_INVERSE) <= i:
            _INVERSE.append(np.uint64(pow(int(_BASE), -len(_INVERSE), 1 << 64)))
        with np.errstate(over="ignore"):
            return mix((run[:, j] - run[:, i]) * _INVERSE[i])

    def _arcs(self, rows: np.ndarray):
        """For every place j and piece length: j, the place before, the rows it fits and the pieces."""
        run, arcs = _spans(rows), []
        for j in range(1, rows.shape[1] + 1):
            for size, (keys, ids, leads) in self.by_length.items():
                if size > j:
                    continue
                key = self._keys(run, j - size, j)
                maybe = np.flatnonzero(leads[key >> _SHIFT])
                key = key[maybe]
                at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                same = keys[at] == key
                if same.any():
                    arcs.append((j, j - size, maybe[same], ids[at[same]]))
            if j > 1:
                arcs.append((j, j - 1, np.arange(len(rows)), self.n + rows[:, j - 1].astype(np.int64)))
        return arcs

    def _forward(self, rows: np.ndarray, arcs, logs: np.ndarray) -> np.ndarray:
        alpha = np.full((len(rows), rows.shape[1] + 1), -np.inf)
        alpha[:, 0] = 0
        for j, i, fits, ids in arcs:
            alpha[fits, j] = np.logaddexp(alpha[fits, j], alpha[fits, i] + logs[ids])
        return alpha

    @staticmethod
    def _groups(words: list[bytes], cells: int = 1 << 18):
        """Rows of words of one length each, with the places of the words; the start mark goes first."""
        lengths = np.array([len(w) for w in words], np.int64)
        order = np.argsort(lengths, kind="stable")
        cuts = np.flatnonzero(np.diff(lengths[order])) + 1
        for part in np.split(order, cuts):
            size = int(lengths[part[0]]) + 1 if len(part) else 1
            step = max(1, cells // size)
            for k in range(0, len(part), step):
                which = part[k : k + step]
                data = b"".join(START + words[i] for i in which)
                yield which, np.frombuffer(data, np.uint8).reshape(len(which), size)

    def likelihood(self, words: list[bytes], logs: list[np.ndarray]) -> np.ndarray:
        """The log probability of each word, over all its segmentations: a column for each set of piece weights."""
        out = np.zeros((len(words), len(logs)))
        for which, rows in self._groups(words) if words else ():
            arcs = self._arcs(rows)
            for i, own in enumerate(logs):
                out[which, i] = self._forward(rows, arcs, own)[:, -1]
        return out

    def expected(self, words: list[bytes], weights: np.ndarray, logs: np.ndarray) -> np.ndarray:
        """How often each piece is expected in the words, each counted by its weight."""
        return self.expected_each(words, weights[:, None], [logs])[0]

    def expected_each(self, words: list[bytes], weights: np.ndarray, logs: list[np.ndarray]) -> list[np.ndarray]:
        """How often each piece is expected in the words, for each set of piece weights; the arcs are found once.

        weights: a row for each word, a column for each set. A word of weight 0 is left out of that set.
        """
        counts = [np.zeros(len(own)) for own in logs]
        for which, rows in self._groups(words) if words else ():
            arcs = self._arcs(rows)
            for k, own in enumerate(logs):
                weight = weights[which, k]
                some = np.flatnonzero(weight > 0)
                if len(some):
                    chosen = arcs if len(some) == len(which) else self._only(arcs, some, len(which))
                    counts[k] += self._expected(rows[some], chosen, weight[some], own)
        return counts

    @staticmethod
    def _only(arcs, some: np.ndarray, n: int):
        """The arcs of some of the n rows, which are numbered anew."""
        place = np.full(n, -1, np.int64)
        place[some] = np.arange(len(some))
        out = []
        for j, i, fits, ids in arcs:
            at = place[fits]
            keep = at >= 0
            if keep.any():
                out.append((j, i, at[keep], ids[keep]))
        return out

    def _expected(self, rows: np.ndarray, arcs, weights: np.ndarray, logs: np.ndarray) -> np.ndarray:
        shares = []
        alpha = self._forward(rows, arcs, logs)
        beta = np.full(alpha.shape, -np.inf)
        beta[:, -1] = 0
        total = alpha[:, -1]
        for j, i, fits, ids in reversed(arcs):
            step = logs[ids] + beta[fits, j]
            beta[fits, i] = np.logaddexp(beta[fits, i], step)
            shares.append((ids, np.exp(alpha[fits, i] + step - total[fits]) * weights[fits]))
        ids, share = (np.concatenate(x) for x in zip(*shares, strict=True))
        return np.bincount(ids, weights=share, minlength=len(logs))
