"""Exchange of packed hashes between chunks and buckets.

To learn which of its hashes other chunks hold too, a chunk sends each
bucket (a range of hash values) one row with its sorted distinct hashes, and
gets back one bit per hash.  A hash costs a bucket one entry per chunk at
most, however many rows of the chunk hold it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BITS = 48                # of a hash that are sent where equality is checked later
ENTRY = "bucket int, chunk int, hashes binary, extra binary"
REPLY = "chunk int, kind int, bucket int, bits binary"
_ENTRY_TYPES = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
_REPLY_TYPES = [pa.int32(), pa.int32(), pa.int32(), pa.binary()]


def groups(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted distinct hashes, index of each entry's hash, how often)."""
    return np.unique(hashes, return_inverse=True, return_counts=True)


def borders(sorted_hashes: np.ndarray, buckets: int, bits: int = BITS) -> np.ndarray:
    """Borders of the buckets, by value range, in sorted hashes."""
    width = np.uint64(((1 << bits) - 1) // buckets + 1)
    return np.searchsorted(sorted_hashes, np.arange(1, buckets, dtype=np.uint64) * width)


def slices(cuts: np.ndarray, n: int) -> list[tuple[int, int, int]]:
    """(bucket, from, to) of the buckets that hold something."""
    edges = np.concatenate([[0], cuts, [n]]).tolist()
    return [(b, lo, hi) for b, (lo, hi) in enumerate(zip(edges, edges[1:])) if hi > lo]


def table(names: str, types: list, rows: list[tuple]) -> pa.Table:
    cols = list(zip(*rows)) if rows else [[] for _ in types]
    return pa.table([pa.array(list(c), t) for c, t in zip(cols, types)],
                    names=[x.split()[0] for x in names.split(", ")])


def entries(rows: list[tuple]) -> pa.Table:
    return table(ENTRY, _ENTRY_TYPES, rows)


def replies(rows: list[tuple]) -> pa.Table:
    return table(REPLY, _REPLY_TYPES, rows)


def pack(h: np.ndarray) -> np.ndarray:
    """The low 48 bits of each value, as rows of six bytes."""
    return np.ascontiguousarray(h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6])


def unpack(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), dtype=np.uint8)
    out[:, :6] = np.frombuffer(data, dtype=np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel().astype(np.uint64)


def bits(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, dtype=np.uint8), count=n).astype(bool)


def send(chunk: int, hashes: np.ndarray, often: np.ndarray, buckets: int) -> pa.Table:
    """Entry rows of a chunk: sorted distinct 48-bit hashes, and for each
    whether the chunk alone holds it more than once."""
    packed = pack(hashes)
    return entries([(b, chunk, packed[lo:hi].tobytes(), np.packbits(often[lo:hi]).tobytes())
                    for b, lo, hi in slices(borders(hashes, buckets), len(hashes))])


def meet(key, t):
    """Reply rows of a bucket: which hashes are held more than once."""
    parts = [unpack(x.as_py()) for x in t.column("hashes")]
    which, count = groups(np.concatenate(parts))[1:]
    often, at = count > 1, 0
    for p, x in zip(parts, t.column("extra")):
        often[which[at:at + len(p)][bits(x.as_py(), len(p))]] = True
        at += len(p)
    rows, at = [], 0
    for p, chunk in zip(parts, t.column("chunk").to_pylist()):
        flags = often[which[at:at + len(p)]]
        at += len(p)
        if flags.any():
            rows.append((chunk, 0, key[0].as_py(), np.packbits(flags).tobytes()))
    return replies(rows)


def answer(t: pa.Table, kind: int, cuts: np.ndarray, n: int) -> np.ndarray:
    """The flags of a chunk's ``n`` sorted hashes from its reply rows."""
    flags = np.zeros(n, dtype=bool)
    got = {(k, b): data for k, b, data in zip(*(t.column(c).to_pylist() for c in ("kind", "bucket", "bits")))}
    for b, lo, hi in slices(cuts, n):
        if (kind, b) in got:
            flags[lo:hi] = bits(got[kind, b], hi - lo)
    return flags
