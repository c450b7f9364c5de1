"""Removal of repeated passages by difference-cover anchors.

A window is ``WINDOW`` consecutive words.  Every word of a window whose word
sequence also starts earlier (smaller doc_id, or the same row and an earlier
word) is removed; windows are judged on the input.

Hashing and shuffling every window would move far more than the corpus.
Instead:

1. Anchors.  Runs of ``WINDOW - PERIOD + 1`` words are hashed only at
   positions whose remainder modulo ``PERIOD`` lies in a difference cover.
   For any two positions i and j there is one shift below PERIOD that takes
   both to cover positions, so two equal windows always share an anchor.
2. Only windows that hold an anchor met elsewhere are extended, that is
   hashed over their whole length; equal hashes are equal windows, and the
   smallest doc_id per hash says which of them came first.
3. Words of windows that came later are cut out.

Texts are dealt to chunks by a hash once; all three passes read that one
exchange.  Passes talk through packed rows, one per (chunk, bucket): sorted
hashes one way, one bit per hash the other.  A chunk sends each hash once
however often it holds it, so a passage that a third of all rows share costs
a bucket no more than one entry per chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from affinity.llm import packing as P
from affinity.llm import text as T
from affinity.llm.common import prepare

WINDOW = 20
PERIOD = 13
# A perfect difference set modulo 13 (each non-zero remainder
# is the difference of exactly one pair).
COVER = (0, 1, 3, 9)
ANCHOR = WINDOW - PERIOD + 1
BUCKETS_PER_CHUNK = 2
BLOCK_WORDS = 1 << 16     # some ten arrays of eight bytes a word are held for a run of rows
_NULL_ID = np.iinfo(np.int64).max


class Chunk:
    """Words, anchors and windows of one chunk's texts.  All but the words'
    hashes is made for runs of rows of about ``BLOCK_WORDS`` words (one row at
    least), so what a task holds beside the chunk does not follow its size."""

    def __init__(self, texts, ids, window: int = WINDOW):
        self.window, self.ids = window, ids
        hashes, counts = [], []
        for _, _, buf, offs in T.blocks(texts):
            starts, ends, first = T.word_spans(buf, offs)
            hashes.append(T.word_hashes(buf, starts, ends))
            counts.append(np.diff(first))
        self.words = np.concatenate(hashes) if hashes else np.zeros(0, dtype=np.uint64)
        self.counts = np.concatenate(counts) if counts else np.zeros(0, dtype=np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.counts)])

    def _blocks(self) -> Iterator[tuple[int, int, int, int]]:
        """(row, end row, word, end word) of each run of rows."""
        lo, n = 0, len(self.counts)
        while lo < n:
            hi = int(np.searchsorted(self.first, self.first[lo] + BLOCK_WORDS, side="right")) - 1
            hi = min(n, max(hi, lo + 1))
            yield lo, hi, int(self.first[lo]), int(self.first[hi])
            lo = hi

    def _positions(self, lo: int, hi: int, length: int) -> tuple[np.ndarray, np.ndarray]:
        """(index, row) of every run of ``length`` words in rows from ``lo`` to ``hi`` that hold a window."""
        counts = self.counts[lo:hi]
        at, row = T.spread(self.first[lo:hi], np.where(counts >= self.window, counts - length + 1, 0))
        return at, row + lo

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Word indices and hashes (48 bits) of all anchors."""
        cover = np.zeros(PERIOD, dtype=bool)
        cover[list(COVER)] = True
        found = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64))]
        for lo, hi, begin, end in self._blocks():
            at, row = self._positions(lo, hi, ANCHOR)
            at = at[cover[(at - self.first[row]) % PERIOD]]
            found.append((at, T.Grams(self.words[begin:end]).at(at - begin, ANCHOR) >> np.uint64(64 - P.BITS)))
        at, h = zip(*found)
        return np.concatenate(at), np.concatenate(h)

    def candidates(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index, row and hash of every window that holds one of ``anchors`` (in ascending order)."""
        found = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64))]
        for lo, hi, begin, end in self._blocks():
            a = anchors[slice(*np.searchsorted(anchors, [begin, end]))] - begin
            if not len(a):
                continue
            step = np.zeros(end - begin + 1, dtype=np.int64)
            np.add.at(step, np.maximum(a - (self.window - ANCHOR), 0), 1)
            np.add.at(step, a + 1, -1)
            near = np.cumsum(step[:-1]) > 0
            at, row = self._positions(lo, hi, self.window)
            use = near[at - begin]
            at, row = at[use], row[use]
            found.append((at, row, T.Grams(self.words[begin:end]).at(at - begin, self.window)))
        at, row, h = zip(*found)
        return np.concatenate(at), np.concatenate(row), np.concatenate(h)


def _ids(column: pa.ChunkedArray) -> np.ndarray:
    """doc_ids as integers; null ids come after all others."""
    return column.combine_chunks().cast(pa.int64()).fill_null(_NULL_ID).to_numpy(zero_copy_only=False)


def remove_repeats(docs: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: all its columns, then n_words, n_removed and
    kept_text (the kept words joined by one space).  Columns named like the
    three new ones, in any case, are replaced; ``marked`` keeps them."""
    new = ("n_words", "n_removed", "kept_text")
    return marked(docs, text, window).select(
        *[F.col(f"doc.`{c}`") for c in docs.columns if c.lower() not in new], *new)


def marked(docs: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: doc (all its columns as one struct, so none can
    clash), n_words, n_removed, kept_text.

    Null and empty texts: no words, kept text "".  A null doc_id counts as
    later than all others.  Rows of equal doc_id, repeated rows included, do
    not come earlier than one another, so neither removes the other's words.
    Empty table: no rows."""
    if window < WINDOW:
        raise ValueError(f"the cover is made for windows of {WINDOW} words and more")
    spark = docs.sparkSession
    n = prepare(spark)
    buckets = n * BUCKETS_PER_CHUNK
    columns = docs.columns
    others = [c for c in columns if c not in ("doc_id", text)]
    # by id and text, so rows without id are spread too; the other columns travel as one struct
    dealt = docs.select(F.col("doc_id"), F.col(f"`{text}`").alias("text"),
                        F.struct(*[F.col(f"`{c}`") for c in others], F.lit(None).cast("boolean").alias("_")).alias("rest"),
                        F.pmod(F.xxhash64("doc_id", F.col(f"`{text}`")), F.lit(n)).cast("int").alias("chunk"))
    dealt = dealt.repartition(n, "chunk")

    def send_anchors(key, t):
        c = Chunk(t.column("text"), None, window)
        h, _, count = P.groups(c.anchors()[1])
        del c
        T.give_back()
        return P.send(key[0].as_py(), h, count > 1, buckets)

    def candidates(t: pa.Table, replies: pa.Table):
        c = Chunk(t.column("text"), _ids(t.column("doc_id")), window)
        at, h = c.anchors()
        u, which, _ = P.groups(h)
        met = P.answer(replies, 0, P.borders(u, buckets), len(u))
        at, row, h = c.candidates(at[met[which]])
        u, which, _ = P.groups(h)
        least = np.full(len(u), _NULL_ID)
        np.minimum.at(least, which, c.ids[row])
        return c, at, row, u, which, least

    def send_windows(key, t, replies):
        rows = []
        if t.num_rows and replies.num_rows:
            _, _, _, u, _, least = candidates(t, replies)
            rows = [(b, key[0].as_py(), u[lo:hi].astype("<u8").tobytes(), least[lo:hi].astype("<i8").tobytes())
                    for b, lo, hi in P.slices(P.borders(u, buckets, 64), len(u))]
        return P.entries(rows)

    def later_windows(key, t):
        parts = [np.frombuffer(x.as_py(), dtype="<u8") for x in t.column("hashes")]
        ids = [np.frombuffer(x.as_py(), dtype="<i8") for x in t.column("extra")]
        u, which, _ = P.groups(np.concatenate(parts))
        least = np.full(len(u), _NULL_ID)
        np.minimum.at(least, which, np.concatenate(ids))
        rows, at = [], 0
        for p, own, chunk in zip(parts, ids, t.column("chunk").to_pylist()):
            flags = own > least[which[at:at + len(p)]]
            at += len(p)
            if flags.any():
                rows.append((chunk, 1, key[0].as_py(), np.packbits(flags).tobytes()))
        return P.replies(rows)

    def remove(key, t, replies):
        if not t.num_rows:
            return _result(t, np.zeros(0, np.int64), np.zeros(0, np.int64), [])
        c, at, row, u, which, least = candidates(t, replies)
        later = P.answer(replies, 1, P.borders(u, buckets, 64), len(u))
        gone = later[which] | (c.ids[row] > least[which])
        # or the same row has it at an earlier word
        order = np.lexsort((at, row, which))
        again = np.zeros(len(order), dtype=bool)
        a, b = order[1:], order[:-1]
        again[a] = (which[a] == which[b]) & (row[a] == row[b])
        at = at[gone | again]
        step = np.zeros(len(c.words) + 1, dtype=np.int32)
        np.add.at(step, at, 1)
        np.add.at(step, at + window, -1)
        removed = np.cumsum(step[:-1], dtype=np.int32) > 0
        total = np.concatenate([[0], np.cumsum(removed)])
        n_removed = total[c.first[1:]] - total[c.first[:-1]]
        del step, total, at, row, which
        kept, i = [], 0
        for part in t.column("text").chunks:      # one Arrow batch at a time as Python strings
            texts = []
            for value in part.to_pylist():
                words = (value or "").encode("utf-8").split()    # splits at the very six bytes
                if n_removed[i]:
                    flags = removed[c.first[i]:c.first[i + 1]].tolist()
                    words = [w for w, out in zip(words, flags) if not out]
                texts.append(b" ".join(words).decode("utf-8"))
                i += 1
            kept.append(pa.array(texts, pa.string()))
        return _result(t, c.counts, n_removed, kept)

    def _result(t, n_words, n_removed, kept) -> pa.Table:
        return pa.table([*[t.column(c) for c in ("doc_id", "text", "rest")], pa.array(n_words, pa.int64()),
                         pa.array(n_removed, pa.int64()), pa.chunked_array(kept, pa.string())], names=out.names)

    def by_chunk(left, right, fn, schema):
        def run(key, t, replies):
            found = fn(key, t, replies)
            T.give_back()
            return found
        return left.groupBy("chunk").cogroup(right.groupBy("chunk")).applyInArrow(run, schema)
    anchors = dealt.groupBy("chunk").applyInArrow(send_anchors, P.ENTRY)
    met = anchors.groupBy("bucket").applyInArrow(P.meet, P.REPLY)
    windows = by_chunk(dealt, met, send_windows, P.ENTRY)
    later = windows.groupBy("bucket").applyInArrow(later_windows, P.REPLY)
    out = StructType([dealt.schema[c] for c in ("doc_id", "text", "rest")])
    for name, kind in (("n_words", "long"), ("n_removed", "long"), ("kept_text", "string")):
        out = out.add(name, kind)
    whole = {"doc_id": F.col("doc_id"), text: F.col("text")}
    return by_chunk(dealt, met.unionByName(later), remove, out).select(
        F.struct(*[whole.get(c, F.col(f"rest.`{c}`")).alias(c) for c in columns]).alias("doc"), "n_words", "n_removed", "kept_text")


def substring_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 per row of ``docs``."""
    d = remove_repeats(docs.select("doc_id", "text"))
    return d.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
