"""Words and word hashes of Arrow text columns, without a Python loop over words.

A word is a run of bytes other than space, tab, line feed, vertical tab, form feed
and carriage return; only the letters A to Z are folded. Both rules work on UTF-8
bytes, so no text is decoded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_SOLID = np.ones(256, dtype=bool)
_SOLID[[9, 10, 11, 12, 13, 32]] = False

#: Bytes hashed at a time; a slice ends between words, so memory does not grow with a text.
SLICE = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class _Tables:
    """Powers of the hash base and of its inverse, grown on demand."""

    def __init__(self):
        self.size = 0

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.size:
            self.size = max(n, SLICE + 1)
            self.up = _powers(_BASE, self.size)
            self.down = _powers(pow(_BASE, -1, 1 << 64), self.size)
        return self.up, self.down


_TABLES = _Tables()


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the offsets of its rows; null is the empty text."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + n + 1]
    return (np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, np.uint8)), bounds


def _cut(data: np.ndarray, bounds: np.ndarray, start: int, stop: int, end: int) -> int:
    """The last place in (start, stop] that splits no word, else the first one after it."""
    gaps = np.flatnonzero(~_SOLID[data[start:stop]])
    row = int(np.searchsorted(bounds, stop, side="right")) - 1
    best = max(start + int(gaps[-1]) + 1 if len(gaps) else start, int(bounds[row]))
    if best > start:
        return best
    limit = int(bounds[np.searchsorted(bounds, stop)])
    while stop < limit:
        gaps = np.flatnonzero(~_SOLID[data[stop : min(stop + SLICE, limit)]])
        if len(gaps):
            return stop + int(gaps[0])
        stop = min(stop + SLICE, limit)
    return min(limit, end)


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the index of each row's first word (rows + 1)."""
    hashes, starts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    at, end = int(bounds[0]), int(bounds[-1])
    while at < end:
        stop = min(at + SLICE, end)
        if stop < end:
            stop = _cut(data, bounds, at, stop, end)
        part = _FOLD[data[at:stop]]
        solid = _SOLID[part]
        edges = bounds[(bounds > at) & (bounds < stop)] - at
        before = np.empty(len(part), bool)
        before[0] = False
        before[1:] = solid[:-1]
        before[edges] = False
        after = np.empty(len(part), bool)
        after[-1] = False
        after[:-1] = solid[1:]
        after[edges - 1] = False
        first = np.flatnonzero(solid & ~before)
        last = np.flatnonzero(solid & ~after) + 1
        up, down = _TABLES.upto(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[: len(part)], out=sums[1:])
        hashes.append(mix((sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64)))
        starts.append(first + at)
        at = stop
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), bounds)


def chunks(batch: pa.RecordBatch, column: str, most: int = 4 << 20, rows: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of a batch with about ``most`` bytes of text and at most ``rows`` rows, one at least."""
    _, bounds = utf8(batch.column(column))
    at = 0
    while at < batch.num_rows:
        stop = int(np.searchsorted(bounds, bounds[at] + most, side="right")) - 1
        stop = min(max(stop, at + 1), at + rows, batch.num_rows)
        yield at, stop
        at = stop


def gram_counts(data: np.ndarray, bounds: np.ndarray, bins: int, letters_only: bool = False, size: int = 3) -> np.ndarray:
    """How often each hashed run of ``size`` bytes occurs in each row: rows x bins.

    With ``letters_only`` letters are folded and all other ASCII becomes a blank.
    """
    lo, hi = int(bounds[0]), int(bounds[-1])
    out = np.zeros((len(bounds) - 1, bins), np.float32)
    for at in range(lo, hi, SLICE):
        part = data[at : min(at + SLICE + size - 1, hi)]
        part = (_LETTERS if letters_only else _IDENTITY)[part].astype(np.uint32)
        if len(part) < size:
            break
        grams = np.zeros(len(part) - size + 1, np.uint32)
        for k in range(size):
            grams = grams * np.uint32(0x01000193) + part[k : len(part) - size + 1 + k]
        grams = ((grams * np.uint32(0x9E3779B1)) >> np.uint32(12)) % np.uint32(bins)
        first = int(np.searchsorted(bounds, at, side="right")) - 1
        for row in range(first, len(bounds) - 1):
            a, b = max(int(bounds[row]), at) - at, min(int(bounds[row + 1]) - size + 1, at + SLICE) - at
            if bounds[row] >= at + SLICE:
                break
            if b > a:
                out[row] += np.bincount(grams[a:b], minlength=bins)
    return out


_IDENTITY = np.arange(256, dtype=np.uint8)
_LETTERS = _FOLD.copy()
_LETTERS[:128] = np.where((_LETTERS[:128] >= 97) & (_LETTERS[:128] <= 122), _LETTERS[:128], 32)
