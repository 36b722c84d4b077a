"""Batches of sequences as byte matrices, for Arrow functions."""

from __future__ import annotations

import numpy as np


def byte_matrix(texts: list[str], width: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """ASCII strings as rows of bytes, zeros behind their ends, and their lengths."""
    size = np.array([len(x) for x in texts], np.int64)
    width = width or max(1, int(size.max(initial=0)))
    return np.array([x.encode("ascii", "replace") for x in texts], f"S{width}").view(np.uint8).reshape(len(texts), width), size


def edits(data: np.ndarray, size: np.ndarray, pattern: str, *, anchored: bool = False, columns: int | None = None) -> np.ndarray:
    """Least edits between ``pattern`` and what ends at each place of each row, one machine word a row.

    ``out[i, j]``: over the parts of row ``i`` that end after its first ``j`` bytes,
    or, if ``anchored``, over its first ``j`` bytes alone. Substitutions, insertions and
    deletions count one each. Behind a row's end the value is that of no match. The
    columns of the edit matrix are kept as bit vectors of differences (Myers 1999).
    """
    m = len(pattern)
    if not 0 < m <= 64:
        raise ValueError("a pattern has 1 to 64 bases")
    columns = data.shape[1] if columns is None else min(columns, data.shape[1])
    equal = np.zeros(256, np.uint64)
    for k, base in enumerate(pattern.encode("ascii")):
        equal[base] |= np.uint64(1 << k)
    n, one, top = len(data), np.uint64(1), np.uint64(m - 1)
    plus, minus = np.full(n, ~np.uint64(0)), np.zeros(n, np.uint64)
    score = np.full(n, m, np.int16)
    out = np.full((n, columns + 1), m, np.int16)
    for j in range(columns):
        eq = equal[data[:, j]]
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        ph, mh = minus | ~(xh | plus), plus & xh
        score = score + ((ph >> top) & one).astype(np.int16) - ((mh >> top) & one).astype(np.int16)
        ph, mh = (ph << one) | (one if anchored else np.uint64(0)), mh << one
        plus, minus = mh | ~(xv | ph), ph & xv
        out[:, j + 1] = score
    out[np.arange(out.shape[1]) > size[:, None]] = m
    return out
