"""Words and their 64-bit hashes, computed for whole Arrow columns with numpy.

A word is a maximal run of bytes other than space and ``\\x09`` to ``\\x0d``; ``lower`` folds A-Z
only. Both act on UTF-8 bytes, where multi-byte characters hold none of these bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20
_BLOCK, _SHORT = 1 << 20, 1 << 12
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_random = np.random.default_rng(20240816)
_BYTE = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ROOT = 0x9E3779B97F4A7C15
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; a bijection."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the root and of its inverse modulo 2**64."""
    if not _powers or len(_powers["up"]) < n:
        for name, base in (("up", _ROOT), ("down", pow(_ROOT, -1, 1 << 64))):
            factors = np.full(n, base, np.uint64)
            factors[0] = 1
            _powers[name] = np.multiply.accumulate(factors)
    return _powers["up"], _powers["down"]


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the offsets of its rows in them; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def slices(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """Batches of a few megabytes of text each, or one row."""
    for batch in batches:
        offsets = texts_of(batch.column(column))[1]
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[start] + SLICE_BYTES, "right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end


def hash_runs(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """One hash of all the bytes of each run, of any length over 0; long runs are summed by themselves, in blocks."""
    size = end - start
    out = np.zeros(len(start), np.uint64)
    short = np.flatnonzero(size <= _SHORT)
    for some in np.array_split(short, len(short) * _SHORT // _BLOCK + 1):
        if len(some):
            before = np.cumsum(size[some]) - size[some]
            place = np.arange(int(size[some].sum())) - np.repeat(before, size[some])
            values = _BYTE[data[np.repeat(start[some], size[some]) + place]] * _power(_SHORT)[0][place]
            out[some] = np.add.reduceat(values, before)
    for k in np.flatnonzero(size > _SHORT):
        for low in range(start[k], end[k], _BLOCK):
            part = data[low : min(low + _BLOCK, end[k])]
            out[k] = mix(out[k : k + 1] + (_BYTE[part] * _power(_BLOCK)[0][: len(part)]).sum(dtype=np.uint64))[0]
    return mix(out + size.astype(np.uint64))


class Words:
    """Words of a slice: ``hash``, byte ``start`` and ``end``, and ``first[d]:first[d + 1]`` of row d."""

    def __init__(self, column: pa.Array, lower: bool = True):
        self.data, self.offsets = texts_of(column)
        if lower:
            self.data = _LOWER[self.data]
        data, offsets = self.data, self.offsets
        blank = np.empty(len(data) + 2, bool)
        blank[0] = blank[-1] = True
        np.take(_SPACE, data, out=blank[1:-1])
        solid = ~blank[1:-1]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        self.start = np.flatnonzero(solid & (blank[:-2] | edge[:-1]))
        self.end = np.flatnonzero(solid & (blank[2:] | edge[1:])) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.count = np.diff(self.first)
        self.hash = np.empty(len(self.start), np.uint64)
        done = 0
        while done < len(self.start):
            low = self.start[done]
            last = max(int(np.searchsorted(self.end, low + _BLOCK, "right")), done + 1)
            high = self.end[last - 1]
            up, down = _power(high - low + 1)
            total = np.zeros(high - low + 1, np.uint64)
            np.cumsum(_BYTE[data[low:high]] * up[: high - low], out=total[1:])
            start = self.start[done:last] - low
            self.hash[done:last] = mix((total[self.end[done:last] - low] - total[start]) * down[start])
            done = last

    def row(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.count)), self.count)

    def text(self, k: int) -> bytes:
        return self.data[self.start[k] : self.end[k]].tobytes()


def shingles(words: Words, width: int = 5) -> Iterator[np.ndarray]:
    """For each row the sorted distinct hashes of its runs of ``width`` words.

    A row with fewer words has its whole sequence as one; a row without words has none.
    """
    odd = np.array([pow(_ROOT, 3 * j + 1, 1 << 64) for j in range(width)], np.uint64)
    hashes = words.hash
    n = max(len(hashes) - width + 1, 0)
    runs = np.full(n, width, np.uint64)
    for j in range(width):
        runs += hashes[j : j + n] * odd[j]
    runs = mix(runs)
    for low, count in zip(words.first, words.count):
        if count >= width:
            yield np.unique(runs[low : low + count - width + 1])
        elif count:
            yield mix(np.array([count], np.uint64) + (hashes[low : low + count] * odd[:count]).sum(dtype=np.uint64))
        else:
            yield np.zeros(0, np.uint64)
