"""Words of whole texts as numpy arrays, straight from Arrow's UTF-8 buffers (no Python string per word).

A word is a maximal run of "word bytes"; every separator of the callers is one ASCII byte, so byte runs and character
runs agree.  A word's hash is a 64-bit polynomial over its bytes (A-Z folded to a-z), finished by a mixer.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SUB_BATCH_BYTES = 1 << 21

_rng = np.random.default_rng(20240115)
_CODE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_CODE[65:91] = _CODE[97:123]
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)

#: Separators are space and \t\n\v\f\r.
NON_SPACE = np.ones(256, dtype=bool)
NON_SPACE[[32, 9, 10, 11, 12, 13]] = False
#: Words of digits, letters and anything beyond ASCII (A-Z count as a-z).
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(max(n, 1), dtype=np.uint64)
    step, b = 1, base
    while step < n:  # doubling: out[step:2*step] = out[:step] * base**step
        m = min(step, n - step)
        out[step:step + m] = out[:m] * np.uint64(b)
        b = b * b % (1 << 64)
        step *= 2
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finisher (splitmix64's)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    column = pc.fill_null(column, "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    _, off, data = column.buffers()
    off = np.frombuffer(off, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8)[off[0]:off[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, off - off[0]


def sub_batches(column, most: int = SUB_BATCH_BYTES):
    """(first row, rows, bytes, offsets) of runs of whole texts, of at most ``most`` bytes unless one text is longer."""
    data, off = utf8(column)
    n, lo = len(off) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + most, "right")) - 1)
        yield lo, hi - lo, data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


class Words:
    """``start``/``end`` (bytes), ``hash`` and, per text, ``first`` (index of its first word; one more entry at the end)."""

    def __init__(self, data: np.ndarray, off: np.ndarray, is_word: np.ndarray):
        mask = is_word[data]
        before = np.empty_like(mask)
        before[1:], before[:1] = mask[:-1], False
        before[off[:-1][off[:-1] < len(data)]] = False
        self.start = np.flatnonzero(mask & ~before)
        after = np.empty_like(mask)
        after[:-1], after[-1:] = mask[1:], False
        after[off[1:][off[1:] > 0] - 1] = False
        self.end = np.flatnonzero(mask & ~after) + 1
        self.first = np.searchsorted(self.start, off)
        self.data = data
        self.hash = self._hash(data)

    def _hash(self, data: np.ndarray) -> np.ndarray:
        if not len(self.start):
            return np.zeros(0, np.uint64)
        run = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_CODE[data] * _powers(_BASE, len(data)), out=run[1:])
        return mix((run[self.end] - run[self.start]) * _powers(_BASE_INV, len(data))[self.start])

    def per_text(self) -> np.ndarray:
        return np.diff(self.first)

    def text(self, i: int) -> bytes:
        return self.data[self.start[i]:self.end[i]].tobytes().lower()
