"""Runs of texts in byte windows: a text longer than the window is cut where its operator allows it, never dropped or shortened."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np

# For a stretch of bytes: at which positions it may be cut, the cut falling before the byte. Position 0 is never asked for.
Cuts = Callable[[np.ndarray], np.ndarray]


def windows(at: np.ndarray, data: np.ndarray, cuts: Cuts, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(bytes, offsets of the texts or parts of texts in them, index of the first text) of each window.

    Windows end with a text if they can, else at the last allowed cut; where there is none they grow until there is one.
    """
    lo, end = 0, int(at[-1])
    while lo < end:
        room, hi = limit, end
        while lo + room < end:
            hi = int(at[np.searchsorted(at, lo + room, "right") - 1])
            if hi > lo:
                break
            found = np.flatnonzero(cuts(data[lo : lo + room]))
            if len(found) and found[-1] > 0:
                hi = lo + int(found[-1])
                break
            room, hi = 2 * room, end
        first = int(np.searchsorted(at, lo, "right")) - 1
        last = int(np.searchsorted(at, hi, "left"))
        yield data[lo:hi], np.clip(at[first : last + 1], lo, hi) - lo, first
        lo = hi
