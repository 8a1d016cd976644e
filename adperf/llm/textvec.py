"""Word hashes of whole batches of texts, with array operations instead of a loop.

Words are runs of bytes other than the six ASCII blanks.  A word's hash is a
polynomial in its bytes modulo 2^64, taken as a difference of running sums, then
mixed.  Equal words have equal hashes; of unlike ones a pair collides with a chance
of about 2^-64.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa

BLANKS = (9, 10, 11, 12, 13, 32)
#: Bytes handled at a time; texts are not split, so a longer one is handled alone.
BLOCK = 1 << 20

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93  # odd, so it has an inverse modulo 2^64
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit numbers that spreads every bit."""
    x = x + _STEP
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


_exact_value = mix(np.arange(256, dtype=np.uint64))
_lower_value = _exact_value.copy()
_lower_value[65:91] = _exact_value[97:123]
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(BLOCK.bit_length(), int(n).bit_length())
    if size not in _powers:
        both = []
        for base in (_BASE, _INVERSE):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        if size > 4 * BLOCK:
            return both[0], both[1]  # for one long text; not kept
        _powers[size] = (both[0], both[1])
    return _powers[size]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts after each other, and where each begins and the last ends."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    flat = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return flat, offsets - offsets[0]


def blocks(offsets: np.ndarray, size: int = BLOCK) -> list[tuple[int, int]]:
    """Ranges of texts of about `size` bytes, or of one longer text."""
    out, first = [], 0
    n = len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        last = min(max(last, first + 1), n)
        out.append((first, last))
        first = last
    return out


def words(flat: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and the number of words in each text.

    `flat` and `offsets` as from `text_bytes`, or a part of them.
    """
    n = len(flat)
    counts = np.zeros(len(offsets) - 1, np.int64)
    if not n:
        return np.zeros(0, np.uint64), counts
    at = offsets - offsets[0]
    solid = (flat != 32) & (flat - np.uint8(9) > 4)  # unsigned: bytes below 9 are far above
    begins = np.empty(n, bool)
    begins[0] = True
    begins[1:] = ~solid[:-1]
    inner = at[:-1][at[:-1] < n]
    begins[inner] = True
    ends = np.empty(n, bool)
    ends[-1] = True
    ends[:-1] = ~solid[1:]
    ends[inner[inner > 0] - 1] = True
    start = np.flatnonzero(begins & solid)
    stop = np.flatnonzero(ends & solid) + 1
    up, down = _power_tables(n)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    values = np.take(_lower_value if lower else _exact_value, flat)
    values *= up[:n]
    np.cumsum(values, out=sums[1:])
    hashes = (sums[stop] - sums[start]) * down[start]
    hashes = mix(hashes ^ ((stop - start).astype(np.uint64) * _STEP))
    counts[:] = np.diff(np.searchsorted(start, at))
    return hashes, counts


def chained(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of every run of `n` neighbours in order."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(hashes) - n + 1, np.uint64)
    for k in range(n):
        total = total * np.uint64(_BASE) + hashes[k : len(hashes) - n + 1 + k]
    return mix(total)


def pack_sorted(keys: np.ndarray) -> bytes:
    """Ascending 64-bit numbers as the planes of their differences, which compress well."""
    steps = np.diff(keys, prepend=np.zeros(1, np.uint64))
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes()


def unpack_sorted(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def pack_counts(values: np.ndarray, dtype: type = np.uint64) -> bytes:
    """Whole numbers as byte planes."""
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(values.astype(dtype).view(np.uint8).reshape(-1, width).T).tobytes()


def unpack_counts(data: bytes, dtype: type = np.uint64) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    planes = np.frombuffer(data, np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


def release() -> None:
    """Give freed memory back to the system; workers live on and would keep it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass
