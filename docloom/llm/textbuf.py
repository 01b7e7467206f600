"""Vectorised work on whole texts as they lie in Arrow buffers: words, hashes of words and of word windows.

Words are runs of characters other than space and \\t \\n \\v \\f \\r; all six are single bytes in UTF-8, so words can be found on bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

WS = np.zeros(256, dtype=bool)
WS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)
_pows: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_pows.get("b", ())) < n:
        n = max(n, SLICE_BYTES + 1)
        for name, base in (("b", _BASE), ("i", _INV)):
            p = np.full(n, base, dtype=np.uint64)
            p[0] = 1
            np.multiply.accumulate(p, out=p)
            _pows[name] = p
    return _pows["b"][:n], _pows["i"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


class PrefixHash:
    """Hash of any byte range of a buffer in constant time: a polynomial modulo 2^64, mixed."""

    def __init__(self, buf: np.ndarray):
        n = len(buf)
        power, self.inv = _powers(n + 1)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * power[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inv[start])


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (length rows + 1, from 0) of a string or binary array; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    if col.null_count:
        col = col.fill_null("" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b"")
    n = len(col)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = col.buffers()
    offs = np.frombuffer(off, dtype=np.int64 if wide else np.int32)[col.offset : col.offset + n + 1].astype(np.int64)
    buf = np.frombuffer(data, dtype=np.uint8)[offs[0] : offs[-1]] if data is not None else np.zeros(0, np.uint8)
    return buf, offs - offs[0]


def slices(col: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of runs of whole rows of about most bytes; a longer row comes alone, whole."""
    buf, offs = buffers(col)
    at, n = 0, len(offs) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offs, offs[at] + most, "right")) - 1)
        yield at, to, buf[offs[at] : offs[to]], offs[at : to + 1] - offs[at]
        at = to


def word_bounds(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words, and for each row the index of its first word (length rows + 1)."""
    n = len(buf)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    ws = WS[buf]
    edge = np.empty(n + 1, dtype=bool)  # a word may start here, or has ended before here
    edge[0] = edge[n] = True
    edge[1:n] = ws[:-1]
    edge[offs] = True
    starts = np.flatnonzero(~ws & edge[:n])
    edge[:n] = ws
    edge[offs] = True
    ends = np.flatnonzero(~ws & edge[1:]) + 1
    return starts, ends, np.searchsorted(starts, offs)


def window_hash(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each window of k items of h (length len(h) - k + 1)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = (out ^ h[j : j + n]) * np.uint64(0x9FB21C651E98DF25)
        out ^= out >> np.uint64(35)
    return mix(out)
