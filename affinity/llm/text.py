"""Word kernels: whole batches of texts at once, as numpy arrays.

A word is a maximal run of bytes other than ``0x20`` and ``0x09-0x0D``.
These bytes never occur inside a multi-byte UTF-8 character, so bytes and
code points give the same words.  A batch's texts lie in one Arrow buffer;
the kernels work on blocks of that buffer of bounded size, so memory does
not follow the number of rows in a batch.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# The same words, as a regular expression for JVM functions.
WORD = r"[^\x20\x09-\x0D]+"
BLOCK_BYTES = 512 << 10    # arrays of eight bytes for each byte of a block are held at a time

# Odd multipliers of the rolling sums, and the finalizer constants of a
# public 64-bit mixer (splitmix64).
_BYTE_BASE = np.uint64(0x9E3779B97F4A7C15)
_WORD_BASE = np.uint64(0xD6E8FEB86659FD93)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over the whole range (splitmix64 finalizer)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _MIX1
    x ^= x >> np.uint64(27)
    x *= _MIX2
    x ^= x >> np.uint64(31)
    return x


@lru_cache(maxsize=None)
def _byte_values(fold: bool) -> np.ndarray:
    codes = np.arange(256, dtype=np.uint64)
    if fold:
        codes[65:91] += np.uint64(32)
    return mix(codes + np.uint64(1))


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


POWERS_STEP = 1 << 16      # a worker holds its powers: no more of them than were asked for, to this step


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on use."""

    def __init__(self, base: np.uint64):
        self.base = base
        self.inverse = np.uint64(pow(int(base), -1, 1 << 64))
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = -(-n // POWERS_STEP) * POWERS_STEP
            for name, factor in (("up", self.base), ("down", self.inverse)):
                steps = np.full(size, factor, dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))
        return self.up[:n], self.down[:n]


_BYTES, _WORDS = _Powers(_BYTE_BASE), _Powers(_WORD_BASE)


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)     # of the GNU C library only


def give_back() -> None:
    """Hand memory that a Python worker has freed back to the system: workers
    live on from task to task, and the allocators hold what a large group took."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def _prefix(values: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values, dtype=np.uint64, out=out[1:])
    return out


def blocks(texts: pa.Array, max_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string array into runs of rows of about ``max_bytes`` of text
    (one row at least): (first row, end row, bytes, offsets from 0).  Null
    texts are empty.  The arrays of a chunked column are taken one by one."""
    if isinstance(texts, pa.ChunkedArray):
        first = 0
        for part in texts.chunks:
            for lo, hi, data, offs in blocks(part, max_bytes):
                yield first + lo, first + hi, data, offs
            first += len(part)
        return
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    n = len(texts)
    if not n:
        return
    _, offs, data = texts.buffers()
    offs = np.frombuffer(offs, dtype=np.int64)[texts.offset:texts.offset + n + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offs, offs[lo] + max_bytes, side="right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi, data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        lo = hi


def word_spans(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words of a block, and for each text the
    index of its first word (one more entry closes the last text)."""
    inside = ~_SPACE[buf]
    n = len(buf)
    edge = np.zeros(n + 1, dtype=bool)      # a text begins (or the block ends) here
    edge[offs] = True
    before = np.empty(n, dtype=bool)
    after = np.empty(n, dtype=bool)
    if n:
        before[0], after[-1] = False, False
        before[1:] = inside[:-1] & ~edge[1:n]
        after[:-1] = inside[1:] & ~edge[1:n]
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offs)


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = False) -> np.ndarray:
    """One 64-bit hash per word; ``fold`` lower-cases A-Z first."""
    up, down = _BYTES.to(len(buf) + 1)
    sums = _prefix(_byte_values(fold)[buf] * up[:-1])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


class Grams:
    """Hashes of runs of consecutive words, of any length, of one block."""

    def __init__(self, hashes: np.ndarray):
        self.up, self.down = _WORDS.to(len(hashes) + 1)
        self.sums = _prefix(hashes * self.up[:-1])

    def at(self, first: np.ndarray, k) -> np.ndarray:
        """Hash of the ``k`` words from each index of ``first``."""
        return mix((self.sums[first + k] - self.sums[first]) * self.down[first] + np.uint64(1) * np.asarray(k, dtype=np.uint64))


def spread(firsts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each i the indices firsts[i] .. firsts[i]+counts[i]-1, one after
    the other: (indices, i of each)."""
    owner = np.repeat(np.arange(len(counts)), counts)
    base = np.cumsum(counts) - counts
    return np.arange(len(owner)) - np.repeat(base, counts) + np.repeat(firsts, counts), owner
