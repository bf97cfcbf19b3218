"""Words and hashes of whole Arrow string columns, by array operations on their UTF-8 bytes.

A column is cut into chunks of whole texts (`chunks`), so memory follows the chunk size or the
longest single text. A null text is treated as an empty one everywhere.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20
# Of glibc; other allocators do without.
TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)

# White space is the byte 0x20 and the bytes 0x09 to 0x0D.
SPACE_BYTES = (0x20, *range(0x09, 0x0E))

IS_WORD = np.ones(256, bool)
IS_WORD[list(SPACE_BYTES)] = False
# Letters a-z after lower-casing A-Z, digits, and every byte of a character beyond ASCII.
IS_ALNUM = np.zeros(256, bool)
IS_ALNUM[0x30:0x3A] = IS_ALNUM[0x61:0x7B] = IS_ALNUM[0x41:0x5B] = IS_ALNUM[0x80:] = True

CODES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
LOWER_CODES = CODES.copy()
LOWER_CODES[0x41:0x5B] = CODES[0x61:0x7B]
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
# Added for each place in a word, so that the sum below tells orders apart.
STEP = np.uint64(0xD1B54A32D192ED03)
FOLD = np.uint64(0xFF51AFD7ED558CCD)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def mixed_int(value: int) -> np.uint64:
    return mix(np.array([value], np.uint64))[0]


def slice_hashes(codes: Callable[[int, int], np.ndarray], starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each slice of a sequence; the slices follow one another without overlap.

    `codes(a, b)` gives 64-bit codes of the elements a to b. Each is mixed with its place in the slice before they are added, so that
    the sum is not linear in them. Work goes by blocks of about `CHUNK_BYTES` elements, or one longer slice.
    """
    size = ends - starts
    out = np.zeros(len(starts), np.uint64)
    k = 0
    while k < len(starts):
        stop = max(k + 1, int(np.searchsorted(ends, starts[k] + CHUNK_BYTES, "right")))
        low, high = int(starts[k]), int(ends[stop - 1])
        begin, end = starts[k:stop] - low, ends[k:stop] - low
        place = np.arange(high - low) - np.repeat(begin, np.diff(begin, append=high - low))
        x = np.zeros(high - low + 1, np.uint64)
        x[:-1] = codes(low, high) + place.astype(np.uint64) * STEP
        x ^= x >> np.uint64(32)
        x *= FOLD
        x ^= x >> np.uint64(29)
        x *= STEP
        x ^= x >> np.uint64(32)
        out[k:stop] = np.add.reduceat(x, np.stack((begin, end), axis=1).ravel())[::2]
        k = stop
    out[size == 0] = 0
    return mix(out + size.astype(np.uint64) * BASE)


class Texts:
    """The bytes of consecutive texts: `data`, and `bounds`, where text i is data[bounds[i]:bounds[i + 1]]."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        self.data, self.bounds = data, bounds

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def spans(self, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the longest runs of bytes in `member`, and first[i], the number of runs before text i."""
        inside = member[self.data]
        n = len(inside)
        starts, ends = inside.copy(), inside.copy()
        starts[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        cut = self.bounds[1:-1]
        cut = cut[(cut > 0) & (cut < n)]
        starts[cut] |= inside[cut]
        ends[cut - 1] |= inside[cut - 1]
        s = np.flatnonzero(starts)
        return s, np.flatnonzero(ends) + 1, np.searchsorted(s, self.bounds)

    def hashes(self, starts: np.ndarray, ends: np.ndarray, codes: np.ndarray = CODES) -> np.ndarray:
        """A 64-bit hash of each slice of the data; no two slices overlap."""
        if (starts[1:] < ends[:-1]).any():
            order = np.argsort(starts)
            out = np.empty(len(starts), np.uint64)
            out[order] = self.hashes(starts[order], ends[order], codes)
            return out
        return slice_hashes(lambda a, b: codes[self.data[a:b]], starts, ends)

    def counted(self, positions: np.ndarray) -> np.ndarray:
        """How many of the sorted positions lie in each text."""
        return np.diff(np.searchsorted(positions, self.bounds))


def texts_of(column: pa.Array) -> Texts:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    if not wide and not pa.types.is_string(column.type):
        column, wide = column.cast(pa.large_string()), True
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return Texts(np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64))
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset: column.offset + len(column) + 1]
    at = at.astype(np.int64)
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return Texts(data[at[0]: at[-1]], at - at[0])


def give_back() -> None:
    """Hand freed memory to the system: Spark uses a worker for many stages, and each would keep the peak of those before."""
    pa.default_memory_pool().release_unused()
    if TRIM:
        TRIM(0)


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, Texts]]:
    """(first row, row behind the last, texts) for runs of rows of about `limit` bytes; every row comes once."""
    whole = texts_of(column)
    row, n = 0, len(whole)
    while row < n:
        stop = int(np.searchsorted(whole.bounds, whole.bounds[row] + limit, "right")) - 1
        stop = min(n, max(row + 1, stop))
        low, high = whole.bounds[row], whole.bounds[stop]
        yield row, stop, Texts(whole.data[low:high], whole.bounds[row: stop + 1] - low)
        row = stop
    give_back()


def owners(first: np.ndarray) -> np.ndarray:
    """The text of each run, from `spans`' third result."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def windows(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of every window of `size` consecutive words of one text."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    start = np.arange(n)
    left = first[1:][owners(first)[:n]] - start
    keep = np.flatnonzero(left >= size)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total = total * BASE + hashes[k: k + n]
    return mix(total[keep]), keep


def repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(is in a group of two or more equal keys, is not the first of its group), by position."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    same = ordered[1:] == ordered[:-1]
    later, shared = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    later[order[1:][same]] = True
    shared[order[1:][same]] = shared[order[:-1][same]] = True
    return shared, later
