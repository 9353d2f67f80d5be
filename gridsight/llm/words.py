"""Words and their 64-bit hashes for whole Arrow columns of text, without a loop over words.

All hashing is modulo 2**64.  A word is cut into blocks of eight bytes; every block is mixed with its
number before the blocks are added, so no text has a structure that cancels out.
"""

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BASE = 0x9E3779B97F4A7C15
#: Bytes of text that are worked on at once; a longer text is a block of its own.
BLOCK = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Letters, digits and everything beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[65:91] = ALNUM[128:] = True
#: Everything but the blank and the five control characters that are white space.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[32, 9, 10, 11, 12, 13]] = False

def mix(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of ``x``."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and where each begins (one more entry than rows); null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    begin = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or begin[-1] == begin[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[begin[0] : begin[-1]], begin - begin[0]


def release() -> None:
    """Give memory that a task no longer needs back to the system: a worker process lives on,
    and several operators run in it one after the other."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def blocks(batches: Iterator[pa.RecordBatch], text: str, size: int = BLOCK) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of about ``size`` bytes of text: rows, their lower-case bytes, where each text begins."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < len(batch):
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + size, "right")))
            rows = batch.slice(at, to - at)
            data, begin = flat(rows.column(rows.schema.get_field_index(text)))
            yield rows, _LOWER[data], begin
            at = to
    release()


def spans(data: np.ndarray, begin: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and how many words each text has; no word crosses two texts."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(begin) - 1, np.int64)
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = kind[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cut = begin[:-1]
    first[cut] = inside[cut]
    starts = np.flatnonzero(first)
    last = inside[:-1] & ~inside[1:]
    cut = begin[1:][begin[1:] > 0] - 1
    last[cut] = inside[cut]
    ends = np.flatnonzero(last) + 1
    counts = np.diff(np.searchsorted(starts, begin))
    return starts, ends, counts


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The 64-bit hash of every word; no word is empty."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    size = ends - starts
    n = (size + 7) >> 3
    first = np.cumsum(n) - n
    number = np.arange(int(n.sum())) - np.repeat(first, n)
    at = np.repeat(starts, n) + 8 * number
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", buffer=padded, strides=(1,))[at]
    over = 8 - np.minimum(np.repeat(ends, n) - at, 8)  # bytes of the next word or none
    eight = eight & (~np.uint64(0) >> (over.astype(np.uint64) << np.uint64(3)))
    mixed = mix(eight + mix(number.astype(np.uint64) * np.uint64(BASE) + np.uint64(1)))
    return mix(np.add.reduceat(mixed, first) + size.astype(np.uint64) * np.uint64(BASE))


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """The hash of every run of ``n`` word hashes (``len(words) - n + 1`` of them)."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(words) - n + 1, np.uint64)
    for i in range(n):
        out = out * np.uint64(BASE) + words[i : len(words) - n + 1 + i]
    return mix(out + np.uint64(n))
