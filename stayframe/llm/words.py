"""Words, hashes and byte ranges of many texts at once.

The Arrow-side operators work on *chunks*: consecutive texts of a batch laid
end to end as one byte array of about ``CHUNK_BYTES``. A text longer than that
is a chunk of its own. Hashes are polynomials over a table of random 64-bit
values, one per byte, modulo 2**64, so the hash of any byte range comes from two
prefix sums. All hashes are fixed functions of the bytes: they are the same in
every task, run and Python version.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SHIFTS = (np.uint64(30), np.uint64(27), np.uint64(31))


#: what glibc calls the size from which memory is mapped, and given back, on its own
_MMAP_THRESHOLD, _MMAP_BYTES = -3, 1 << 20


@cache
def _libc():
    try:
        libc = ctypes.CDLL(None)
        libc.mallopt(_MMAP_THRESHOLD, _MMAP_BYTES)
        return libc
    except (OSError, AttributeError):  # another C library: nothing to set
        return None


def tidy_memory() -> None:
    """Give a worker's free memory back to the system, at the end of a task.

    Spark keeps Python workers for later tasks; without this each keeps the most that any task took.
    """
    pa.default_memory_pool().release_unused()
    libc = _libc()
    if libc is not None:
        libc.malloc_trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that every bit depends on every input bit."""
    x = (x ^ (x >> _SHIFTS[0])) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _SHIFTS[1])) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> _SHIFTS[2])


def random_values(n: int, seed: int) -> np.ndarray:
    """The same ``n`` 64-bit values for the same seed, everywhere."""
    start = np.uint64(seed * 0xD1342543DE82EF95 % (1 << 64))
    return mix(start + np.arange(1, n + 1, dtype=np.uint64) * _BASE)


_BYTE_VALUES = random_values(256, 1)
_ALL = np.arange(256, dtype=np.uint8)
LOWER = np.where((_ALL >= 65) & (_ALL <= 90), _ALL + 32, _ALL).astype(np.uint8)
#: bytes inside words ``[^\x20\x09-\x0D]+``
SPACED = ~((_ALL == 32) | ((_ALL >= 9) & (_ALL <= 13)))
#: bytes inside words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of lower-cased texts
PLAIN = ((_ALL >= 48) & (_ALL <= 57)) | ((_ALL >= 97) & (_ALL <= 122)) | (_ALL >= 128)

_powers: list[np.ndarray] = []


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to ``n`` of the base and of its inverse; kept up to the chunk size."""
    if _powers and len(_powers[0]) > n:
        return _powers[0], _powers[1]
    size = max(n, CHUNK_BYTES + CHUNK_BYTES // 4) + 1
    made = []
    for base in (_BASE, _BASE_INVERSE):
        table = np.full(size, base, np.uint64)
        table[0] = 1
        made.append(np.multiply.accumulate(table))
    if n <= 8 * CHUNK_BYTES:
        _powers[:] = made
    return made[0], made[1]


class Ranges:
    """Hashes of byte ranges of one byte array."""

    def __init__(self, data: np.ndarray):
        self.power, self.inverse = _tables(len(data))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[data] * self.power[: len(data)], out=self.sums[1:])

    def raw(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.inverse[start]

    def hash(self, start: np.ndarray, end: np.ndarray, salt: int = 0) -> np.ndarray:
        length = (end - start).astype(np.uint64)
        return mix(self.raw(start, end) + mix(length + np.uint64(salt)))


@dataclass
class Words:
    """Words of consecutive texts: where each starts and ends in the chunk, its
    hash, and per text the range ``first[i]:first[i + 1]`` of its words."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray
    ranges: Ranges


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(from, to, bytes, bounds) of runs of texts; NULL is an empty text.

    Text ``from + i`` is ``bytes[bounds[i]:bounds[i + 1]]``.
    """
    _libc()
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    values = texts.cast(pa.large_string()).fill_null("") if texts.null_count else texts.cast(pa.large_string())
    _, offsets, data = values.buffers()
    offsets = np.frombuffer(offsets, np.int64)[values.offset : values.offset + len(values) + 1] if len(values) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(values):
        to = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        to = min(max(to, at + 1), len(values))
        yield at, to, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def words_of(data: np.ndarray, bounds: np.ndarray, inside: np.ndarray, lower: bool = True) -> Words:
    """Words of the texts in one chunk: maximal runs of bytes marked in ``inside``."""
    if lower:
        data = LOWER[data]
    n = len(data)
    ranges = Ranges(data)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(none, none, none.astype(np.uint64), np.zeros(len(bounds), np.int64), ranges)
    mark = inside[data]
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = mark[:-1], mark[1:]
    edges = bounds[(bounds > 0) & (bounds < n)]
    before[edges], after[edges - 1] = False, False
    start, end = np.flatnonzero(mark & ~before), np.flatnonzero(mark & ~after) + 1
    return Words(start, end, ranges.hash(start, end), np.searchsorted(start, bounds), ranges)


def runs(hashes: np.ndarray, first: np.ndarray, n: int, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(hash of the ``n`` consecutive words from each word on, whether they are of one text)."""
    count = len(hashes)
    total = np.zeros(count, np.uint64)
    factors = random_values(n, 100 + salt) | np.uint64(1)
    for k in range(n):
        total[: max(count - k, 0)] += hashes[k:] * factors[k]
    end = np.repeat(first[1:], np.diff(first))
    return mix(total), np.arange(count) + n <= end


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as a Spark long."""
    return np.ascontiguousarray(x).view(np.int64)
