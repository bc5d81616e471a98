"""Vectorised word scanning over Arrow text buffers.

Works on the UTF-8 bytes of a whole Arrow batch at once. A batch is cut into
slices of whole rows of about ``SLICE_BYTES`` (one longer row is a slice of its
own), so that working arrays stay small whatever the batch size.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SLICE_BYTES = 1 << 20

#: Base of the polynomial word hash: any odd 64-bit number; its inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)

_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; grows by doubling and is kept per process
    up to the slice size."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        out = np.full(max(n, SLICE_BYTES * 2), base, dtype=np.uint64)
        out[0] = 1
        with np.errstate(over="ignore"):
            have = np.multiply.accumulate(out)
        if len(have) <= 8 * SLICE_BYTES:
            _powers[base] = have
    return have[:n]


def spaces_table() -> np.ndarray:
    """True for bytes of words: everything but space and \\t \\n \\v \\f \\r."""
    keep = np.ones(256, dtype=bool)
    keep[[0x20, *range(0x09, 0x0E)]] = False
    return keep


def ascii_word_table() -> np.ndarray:
    """True for 0-9, a-z and every byte of a non-ASCII character."""
    keep = np.zeros(256, dtype=bool)
    keep[0x30:0x3A] = keep[0x61:0x7B] = keep[0x80:] = True
    return keep


def lower_table() -> np.ndarray:
    """A-Z to a-z, other bytes as they are."""
    out = np.arange(256, dtype=np.uint8)
    out[0x41:0x5B] += 32
    return out


def utf8(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array and the row offsets into them; null is empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    arr = pc.fill_null(arr.cast(pa.large_string()), "")
    bounds = np.frombuffer(arr.buffers()[1], dtype=np.int64)[arr.offset : arr.offset + len(arr) + 1]
    body = arr.buffers()[2]
    data = np.frombuffer(body, dtype=np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    return data, bounds


try:
    _trim = ctypes.CDLL("libc.so.6").malloc_trim
except (OSError, AttributeError):  # another C library
    _trim = None


def release_memory() -> None:
    """Give memory that a batch has used back to the system: a worker lives on, idle,
    beside the next stage's."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def slices(arr: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets from 0) of consecutive groups of rows."""
    data, bounds = utf8(arr)
    row, rows = 0, len(bounds) - 1
    while row < rows:
        end = int(np.searchsorted(bounds, bounds[row] + size, side="right")) - 1
        end = min(max(end, row + 1), rows)
        yield row, data[bounds[row] : bounds[end]], bounds[row : end + 1] - bounds[row]
        row = end
    release_memory()


def spans(data: np.ndarray, bounds: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of kept bytes that cross no bound."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = keep[data]
    turns = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        turns = np.append(0, turns)
    if inside[-1]:
        turns = np.append(turns, len(data))
    starts, ends = turns[::2], turns[1::2]
    inner = bounds[(bounds > 0) & (bounds < len(data))]
    cut = np.unique(inner[inside[inner] & inside[inner - 1]])  # bounds within a run
    if len(cut):
        starts, ends = (np.insert(x, np.searchsorted(x, cut), cut) for x in (starts, ends))
    return starts, ends


def rows_of(starts: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The row (range between two bounds) of each of the sorted starts."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(np.searchsorted(starts, bounds)))


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads a 64-bit hash over all its bits (a bijection)."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


#: Words of more bytes are hashed by XXH64: some long words (of 1024 bytes and more) share
#: the value of any polynomial modulo 2**64.
_POLYNOMIAL_BYTES = 64


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every span; equal bytes have equal hashes wherever they stand."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    n = len(data)
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(np.multiply(data, _power_table(_BASE, n), dtype=np.uint64), out=sums[1:])
        h = (sums[ends] - sums[starts]) * _power_table(_INVERSE, n)[starts]
        out = mix(h + (ends - starts).astype(np.uint64))
    for i in np.flatnonzero(ends - starts > _POLYNOMIAL_BYTES).tolist():
        out[i] = xxhash.xxh64_intdigest(data[starts[i] : ends[i]].tobytes())
    return out
