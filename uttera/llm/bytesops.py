"""Vectorised byte and word primitives shared by the operators: numpy over whole Arrow columns.

A *block* is a slice of an Arrow batch that holds about ``BLOCK`` bytes of text (always whole
rows), so that temporary arrays stay small whatever the batch size is.
"""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 20
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_INVERSE = _U(pow(int(_BASE), -1, 1 << 64))
_TABLE = np.random.default_rng(20240917).integers(1, 2**63, 256, dtype=np.int64).astype(_U) * _U(2) + _U(1)
_GRAM = np.random.default_rng(5).integers(1, 2**63, 64, dtype=np.int64).astype(_U) * _U(2) + _U(1)
_powers: list[np.ndarray] = []


def forget_encoders() -> None:
    """Drop the vocabularies and pieces that earlier tasks of this worker encoded with."""
    if tokens := sys.modules.get("uttera.llm.tokens"):
        tokens._loaded.clear()


def keep_heap(encoders: bool = False) -> None:
    """Let glibc reuse freed arrays instead of returning them to the system page by page; what an earlier task left behind goes back first.

    ``encoders``: those of earlier tasks stay.
    """
    if not encoders:
        forget_encoders()
    pa.default_memory_pool().release_unused()
    try:
        libc = ctypes.CDLL(None)
        libc.malloc_trim(0)
        libc.mallopt(-3, 64 << 20)  # M_MMAP_THRESHOLD
        libc.mallopt(-1, 128 << 20)  # M_TRIM_THRESHOLD
    except (OSError, AttributeError):
        pass  # another C library: only slower


def give_back() -> None:
    """Let glibc return freed arrays of a megabyte or more to the system at once: slower, but a worker holds no more than it uses."""
    forget_encoders()
    pa.default_memory_pool().release_unused()
    try:
        libc = ctypes.CDLL(None)
        libc.malloc_trim(0)
        libc.mallopt(-3, 1 << 20)  # M_MMAP_THRESHOLD
    except (OSError, AttributeError):
        pass  # another C library: only larger


def column(values: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and its len+1 offsets; null counts as empty."""
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if isinstance(values, pa.ChunkedArray):
        values = pa.concat_arrays(values.chunks) if values.num_chunks else pa.array([], pa.string())
    values = pc.fill_null(values.cast(pa.large_binary()), b"")
    _, offsets, data = values.buffers()
    off = np.frombuffer(offsets, np.int64)[values.offset : values.offset + len(values) + 1] if len(values) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def blocks(batches: Iterable[pa.RecordBatch], text: str = "text", limit: int = BLOCK) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of whole rows with about ``limit`` bytes in column ``text``: (rows, bytes, offsets)."""
    for batch in batches:
        data, off = column(batch.column(batch.schema.get_field_index(text)))
        a = 0
        while a < batch.num_rows:
            b = min(batch.num_rows, max(a + 1, int(np.searchsorted(off, off[a] + limit, "right")) - 1))
            yield batch.slice(a, b - a), data[off[a] : off[b]], off[a : b + 1] - off[a]
            a = b


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash."""
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        m = max(n, 2 * BLOCK)
        with np.errstate(over="ignore"):
            up, down = np.full(m, _BASE), np.full(m, _INVERSE)
            up[0] = down[0] = 1
            _powers[:] = [np.cumprod(up), np.cumprod(down)]
    return _powers[0], _powers[1]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Prefix sums from which the hash of any byte range follows; see ``range_hash``."""
    out = np.zeros(len(data) + 1, _U)
    np.cumsum(_TABLE[data] * powers(len(data) + 1)[0][: len(data)], out=out[1:])
    return out


def range_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range, a function of its bytes alone."""
    return mix((prefix[ends] - prefix[starts]) * powers(len(prefix))[1][starts] + (ends - starts).astype(_U) * _U(0xA0761D6478BD642F))


def lut(chars: Iterable[int]) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


#: Bytes of words split at ASCII white space, and of alphanumeric words (all bytes of non-ASCII letters count).
SPACE_WORD = ~lut([0x20, *range(0x09, 0x0E)])
ALNUM_WORD = ~lut([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def words(data: np.ndarray, off: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words in a block, and len+1 bounds of each row's words among them."""
    n = len(data)
    inside = np.zeros(n + 1, bool)
    inside[:n] = kind[data]
    begins = inside[:n].copy()
    begins[1:] &= ~inside[: n - 1]
    ends = inside[:n] & ~inside[1:]
    first = off[:-1][off[:-1] < off[1:]]
    begins[first] = inside[first]
    last = off[1:][off[:-1] < off[1:]] - 1
    ends[last] = inside[last]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return starts, stops, np.searchsorted(starts, off)


def grams(hashes: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word windows of each row, and their len+1 bounds; rows of fewer words have none."""
    counts = np.maximum(np.diff(bounds) - k + 1, 0)
    out_bounds = np.concatenate([[0], np.cumsum(counts)])
    m = len(hashes) - k + 1
    if m <= 0 or out_bounds[-1] == 0:
        return np.zeros(0, _U), np.zeros(len(bounds), np.int64)
    h = hashes[:m] * _GRAM[0]
    for i in range(1, k):
        h = h + hashes[i : i + m] * _GRAM[i]
    at = np.repeat(bounds[:-1] - out_bounds[:-1], counts) + np.arange(out_bounds[-1])
    return mix(h[at]), out_bounds


def rows_of(bounds: np.ndarray) -> np.ndarray:
    """Row number of each item."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def sum_rows(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of the items of each row, 0 for none."""
    total = np.zeros(len(values) + 1, values.dtype if values.dtype.kind in "fu" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]
