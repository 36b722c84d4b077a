"""Word tables and per-text sums over Arrow string columns, in numpy.

Spark deals the rows out; these helpers turn one batch into arrays. They work
on slices of about ``SLICE`` bytes, so their memory doesn't depend on the size
of a batch, only on that of the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 1 << 20
_BASE, _BASE_INV = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
_BYTE = np.random.Generator(np.random.PCG64(20240607)).integers(1, 1 << 63, 256, dtype=np.uint64)
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_POW = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    if len(_POW[0]) < n:
        n = max(n, 2 * SLICE)
        for i, b in enumerate((_BASE, _BASE_INV)):
            p = np.full(n, b, np.uint64)
            p[0] = 1
            _POW[i] = np.multiply.accumulate(p)
    return _POW


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = h.copy()
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def slices(text: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, bytes, offsets)`` of runs of rows; null is empty."""
    text = pc.fill_null(text, "").cast(pa.large_string())
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
    data = text.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(text):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE, side="right")) - 1)
        yield at, end, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def parts(batches, rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batches in runs of ``rows`` rows, which bounds what a task holds at once."""
    for batch in batches:
        for at in range(0, max(1, batch.num_rows), rows):
            yield batch.slice(at, rows)


def sums(flag: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum over each row's bytes."""
    c = np.zeros(len(flag) + 1, np.int64)
    np.cumsum(flag, out=c[1:])
    return c[offsets[1:]] - c[offsets[:-1]]


class Words:
    """The words of a slice: where they start and end, their row, and their hashes.

    A word is a run of bytes for which ``inside`` holds; no word crosses rows.
    Hashes are of the bytes with A-Z lower-cased.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, inside: np.ndarray | None = None):
        inside = ~SPACE[data] if inside is None else inside
        first = np.zeros(len(data) + 1, bool)
        first[offsets] = True
        edge = np.ones(len(data) + 1, bool)
        edge[1:] = np.append(~inside, True)[:-1] | first[1:]
        edge[0] = True
        self.starts = np.flatnonzero(inside & edge[:-1])
        stop = np.ones(len(data), bool)
        if len(data):
            stop[:-1] = ~inside[1:] | first[1:-1]
        self.ends = np.flatnonzero(inside & stop) + 1
        self.row = np.searchsorted(offsets, self.starts, side="right") - 1
        self.data, self.n_rows = data, len(offsets) - 1
        self.first = np.searchsorted(self.row, np.arange(self.n_rows + 1))
        self._sum = None

    def hashes(self, length: int | None = None) -> np.ndarray:
        """Of whole words, or of their first ``length`` bytes."""
        power, inverse = _powers(len(self.data) + 1)
        if self._sum is None:
            self._sum = np.zeros(len(self.data) + 1, np.uint64)
            np.cumsum(_BYTE[LOWER[self.data]] * power[: len(self.data)], out=self._sum[1:])
        ends = self.ends if length is None else np.minimum(self.ends, self.starts + length)
        return mix((self._sum[ends] - self._sum[self.starts]) * inverse[self.starts] + (ends - self.starts).astype(np.uint64))

    def per_row(self, values: np.ndarray) -> np.ndarray:
        c = np.concatenate([[0], np.cumsum(values)])
        return c[self.first[1:]] - c[self.first[:-1]]


def word_hash(word: str) -> int:
    b = np.frombuffer(word.encode(), np.uint8)
    return int(Words(b, np.array([0, len(b)])).hashes()[0])
