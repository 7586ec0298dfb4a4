"""Vectorised text helpers on Arrow string columns (numpy inside Spark tasks).

A column is handled in chunks of whole texts of about ``CHUNK`` bytes, so the
temporary arrays stay near 60 bytes per byte of the chunk; a single text longer
than a chunk is one chunk of its own.
"""

from __future__ import annotations

import ctypes
import functools

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20

# The white space between words: U+0020 and U+0009..U+000D (fixed by the contracts).
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_R = np.uint64(0x9E3779B97F4A7C15)
_RINV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POWERS: dict[int, np.ndarray] = {}


def tidy(run):
    """A partition function that gives its worker's freed memory back at the end (idle workers
    stay beside the executor through later stages)."""
    @functools.wraps(run)
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # only the GNU library has it
            if trim:
                trim(0)
    return wrapped


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(base: np.uint64, n: int) -> np.ndarray:
    p = _POWERS.get(int(base))
    if p is None or len(p) < n:
        p = np.full(max(n, CHUNK) + 1, base, np.uint64)
        p[0] = 1
        np.multiply.accumulate(p, out=p)
        if len(p) <= CHUNK + 1:     # a longer text's table is not kept
            _POWERS[int(base)] = p
    return p[:n]


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its offsets; a null is an empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_binary()) if pa.types.is_large_binary(col.type) else col.cast(pa.large_string())
    if col.null_count:
        col = col.fill_null(b"" if pa.types.is_large_binary(col.type) else "")
    _, off, data = col.buffers()
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(off, np.int64)[col.offset:col.offset + len(col) + 1]
    bytes_ = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return bytes_[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(col: pa.Array, limit: int = CHUNK):
    """``(first row, end row, bytes, offsets)`` for runs of whole texts of about ``limit`` bytes."""
    data, off = utf8(col)
    i, n = 0, len(off) - 1
    while i < n:
        j = min(n, max(i + 1, int(np.searchsorted(off, off[i] + limit, side="right")) - 1))
        yield i, j, data[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


def words(data: np.ndarray, off: np.ndarray, separator: np.ndarray = SEPARATOR):
    """Byte starts and ends of the words of every text, and the text of each word."""
    return runs(separator[data], off)


def runs(sep: np.ndarray, off: np.ndarray):
    """Starts and ends of the runs of positions that are not ``sep``, and the text of each."""
    if len(sep) == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = ~sep
    first = inside.copy()
    first[1:] &= sep[:-1]
    heads = off[:-1][off[1:] > off[:-1]]
    first[heads] = inside[heads]
    last = inside.copy()
    last[:-1] &= sep[1:]
    tails = off[1:][off[1:] > off[:-1]] - 1
    last[tails] = inside[tails]
    s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
    return s, e, np.searchsorted(off, s, side="right") - 1


def span_hashes(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """A 64-bit rolling hash of each byte span ``[s, e)``, equal for equal bytes."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_R, n), out=sums[1:])
    inv = _powers(_RINV, n + 1)
    return mix((sums[e] - sums[s]) * inv[s] + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


_SEQ = [np.uint64(x) for x in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]


def window_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """The hash of every run of ``width`` consecutive hashes (order matters)."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, np.uint64(width))
    for k in range(width):
        out = mix(out * _SEQ[k % 4] + h[k:k + n] + np.uint64(k))
    return out


def bounds(doc: np.ndarray, n: int) -> np.ndarray:
    """Start of each text's run in the sorted array ``doc`` (n + 1 entries)."""
    return np.searchsorted(doc, np.arange(n + 1))


def lists(values: np.ndarray, counts, kind=pa.int64()) -> pa.Array:
    """An Arrow list column from flat values and the length of each list."""
    off = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=off[1:])
    return pa.ListArray.from_arrays(pa.array(off), pa.array(values, type=kind))


def empty_batch(schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([], type=f.type) for f in schema], schema=schema)
