"""Phrase collocation mining by direct-address tiling.

Texts are read once, in blocks; a block has its own dictionary of words and
its text as codes of it.  The words that are frequent in all blocks together
are ranked by that frequency, and a block is recoded to its words' ranks.
Pairs of neighbouring codes are split into tiles of the (code, code) plane.
Frequent codes are small, so a few tiles near the origin hold most pairs and
are counted in place, as one dense ``bincount`` each; the others are sorted
as coordinates and counted by runs.  Pairs that are frequent in all blocks
are ranked by frequency again, blocks are recoded to them, and the next
round pairs those: two neighbouring k-word phrases are one phrase of k + 1.

No dictionary is broadcast: a block gets what it holds itself.  Every total
is a sum over blocks by word or pair, so a frequent one is one number from
each block, whatever the size of the corpus.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinity.llm import text as T
from affinity.llm.common import cut, few, prepare, ranked
from affinity.session import ensure_checkpoint_dir

MIN_COUNT = 100
MAX_WORDS = 5
COVERED_PCT = 100          # of its count that a longer phrase must have to replace one inside it
TOP = 2000
NO_LANG = "und"
BLOCK_BYTES = 16 << 20     # of text in one block (one text at least)
TILE = 1024                # ids along a side of a tile
DENSE = TILE * TILE // 16  # pairs from which a tile is counted in place

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_BREAK = np.zeros(256, dtype=bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_OUTSIDE = _BREAK.copy()
_OUTSIDE[[0x20, 0x09]] = True


def words_of(buf: np.ndarray, offs: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words of the texts at ``offs`` in a buffer, A-Z lower-cased, in order;
    the text of each, and a number that is equal for words of one piece."""
    inside = ~_OUTSIDE[buf]
    n = len(buf)
    edge = np.zeros(n + 1, dtype=bool)
    edge[offs] = True
    runs_on = np.zeros(n + 1, dtype=bool)              # the byte before belongs to the same word
    runs_on[1:n] = inside[:-1] & inside[1:] & ~edge[1:n]
    starts = np.flatnonzero(inside & ~runs_on[:-1])
    ends = np.flatnonzero(inside & ~runs_on[1:]) + 1
    owner = np.searchsorted(offs, starts, side="right") - 1
    piece = np.searchsorted(np.flatnonzero(_BREAK[buf]), starts) + owner
    at = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    data = _FOLD[buf[inside]]
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(at), pa.py_buffer(data))
    return words, owner, piece


def coded(texts: pa.Array, langs: pa.Array) -> tuple[pa.Array, pa.Array, np.ndarray, np.ndarray]:
    """A block's dictionary (languages, words, counts), frequent words first,
    and its texts as codes of it, -1 between pieces."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offs, data = texts.buffers()
    offs = np.frombuffer(offs, dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    buf = np.frombuffer(data, dtype=np.uint8)[offs[0]:offs[-1]] if data is not None else np.zeros(0, np.uint8)
    words, owner, piece = words_of(buf, offs - offs[0])
    lang = pc.fill_null(langs, NO_LANG).dictionary_encode()
    word = words.dictionary_encode()
    key = lang.indices.to_numpy()[owner].astype(np.int64) * max(1, len(word.dictionary)) + word.indices.to_numpy()
    used, code, count = np.unique(key, return_inverse=True, return_counts=True)
    order = np.argsort(-count, kind="stable")
    place = np.empty(len(order), dtype=np.int32)
    place[order] = np.arange(len(order), dtype=np.int32)
    used, code, count = used[order], place[code], count[order]
    which, name = np.divmod(used, max(1, len(word.dictionary)))
    gaps = np.flatnonzero(np.diff(piece)) + 1
    return (lang.dictionary.take(pa.array(which)), word.dictionary.take(pa.array(name)), count,
            np.insert(code, gaps, -1))


class _Tables:
    """Tables of one run as compressed Parquet in a folder of its own under
    the shared checkpoint folder; each goes as soon as nothing reads it."""

    def __init__(self, spark):
        self.spark = spark
        self.folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/phrases-{uuid.uuid4().hex}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        df.write.option("compression", "zstd").parquet(f"{self.folder}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{name}")

    def drop(self, name: str = "") -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}".rstrip("/"))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def read_blocks(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """Rows of all blocks: a row per word (block, lang, word, code, n) and a
    row per block (block, n, seq), where n is the number of codes."""
    names = ["block", "lang", "word", "code", "n", "seq"]

    def block(number: int, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(parts).combine_chunks()
        langs, words, count, seq = coded(*[t.column(c).combine_chunks() for c in ("text", "lang")])
        k = len(words)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(k + 1, number, np.int64)), *[pa.concat_arrays([x.cast(pa.string()), pa.nulls(1, pa.string())])
                                                           for x in (langs, words)],
             pa.concat_arrays([pa.array(np.arange(k, dtype=np.int32)), pa.nulls(1, pa.int32())]),
             pa.array(np.append(count, len(seq)).astype(np.int64)),
             pa.concat_arrays([pa.nulls(k, pa.binary()), pa.array([squeezed(seq)], pa.binary())])], names=names)

    def run(batches):
        first = TaskContext.get().partitionId() << 32
        held, size, number = [], 0, 0
        for b in batches:
            for piece in _by_bytes(b, BLOCK_BYTES):
                if held and size + piece.nbytes > BLOCK_BYTES:
                    yield block(first + number, held)
                    held, size, number = [], 0, number + 1
                held.append(piece)
                size += piece.nbytes
        if held:
            yield block(first + number, held)
    return docs.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang")).mapInArrow(
        run, "block long, lang string, word string, code int, n long, seq binary")


def _by_bytes(b: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """A batch in runs of rows of about ``most`` bytes of text."""
    for lo, hi, _, _ in T.blocks(b.column("text"), most):
        yield b.slice(lo, hi - lo)


def squeezed(codes: np.ndarray) -> bytes:
    """Codes of -1 and up, compressed: their lower and upper halves apart, as
    the upper ones are mostly zero where small codes are the frequent ones."""
    halves = np.ascontiguousarray((codes + 1).astype("<u4").view("<u2").reshape(-1, 2).T)
    return pa.compress(halves.tobytes(), codec="zstd", asbytes=True) if len(codes) else b""


def unsqueezed(data: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, np.int32)
    halves = np.frombuffer(pa.decompress(data, decompressed_size=4 * n, codec="zstd", asbytes=True), dtype="<u2").reshape(2, n)
    return np.ascontiguousarray(halves.T).view("<u4").ravel().astype(np.int64).astype(np.int32) - 1


def _packed(seq: np.ndarray) -> np.ndarray:
    """Codes without what no pair can come from: single codes between gaps,
    and gaps after gaps."""
    some = seq >= 0
    left, right = np.append(False, some[:-1]), np.append(some[1:], False)
    keep = (some & (left | right)) | (~some & left)
    return seq[keep]


_CODES = "block long, ids binary, n long, seq binary"


def _coded_rows(seq: np.ndarray, block: int, ids: np.ndarray) -> pa.Table:
    """A block's row (block, ids, n, seq), seq in places of ids; none without pairs."""
    seq = _packed(seq)
    rows = [block] if len(seq) else []
    return pa.table({"block": pa.array(rows, pa.int64()),
                     "ids": pa.array([ids.astype("<i8").tobytes()] if rows else [], pa.binary()),
                     "n": pa.array([len(seq)] if rows else [], pa.int64()),
                     "seq": pa.array([squeezed(seq)] if rows else [], pa.binary())})


def _frequent(rows: DataFrame, keys: list[str], least: int) -> DataFrame:
    """Rows (block, keys, n, ...), one for each block and key, of the keys that
    reach ``least`` in all blocks together, with their total ``f`` and an
    ``id``.  Rows of a key are brought together once; its id is the place of
    its first row, so no table of ids has to be joined back."""
    key = Window.partitionBy(*keys)
    d = rows.withColumn("f", F.sum("n").over(key)).filter(F.col("f") >= least)
    return d.withColumn("id", F.monotonically_increasing_id()).withColumn("id", F.min("id").over(key))


def _in_order(f: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Frequent ones first."""
    return np.lexsort((ids, -f))


def _word_codes(texts: DataFrame, words: DataFrame) -> DataFrame:
    """Blocks (block, n, seq) in ids of their frequent words."""
    def run(key, t: pa.Table, got: pa.Table) -> pa.Table:
        seq = unsqueezed(t.column("seq")[0].as_py(), t.column("n")[0].as_py()) if t.num_rows else np.zeros(0, np.int32)
        f, own, code = (got.column(c).to_numpy() for c in ("f", "id", "code"))
        order = _in_order(f, own)
        place = np.full(int(seq.max(initial=-1)) + 2, -1, dtype=np.int32)        # the last stays -1, for gaps
        place[code[order]] = np.arange(len(order), dtype=np.int32)
        return _coded_rows(place[seq], key[0].as_py(), own[order])
    have = words.select(F.col("block").alias("to"), "code", "f", "id")
    return texts.groupBy("block").cogroup(have.groupBy("to")).applyInArrow(run, _CODES)


def count_pairs(seq: np.ndarray, n_ids: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, second, count) of the pairs of neighbouring codes.  Codes are
    in order of frequency; tiles with many pairs are counted in place, the
    rest as sorted coordinates."""
    both = (seq[:-1] >= 0) & (seq[1:] >= 0)
    a, b = seq[:-1][both].astype(np.int64), seq[1:][both].astype(np.int64)
    side = -(-n_ids // TILE)
    tile = a // TILE * side + b // TILE
    if side * side <= 1 << 20:
        held = np.bincount(tile, minlength=1)
        dense = np.flatnonzero(held >= DENSE)
    else:
        held, often = np.unique(tile, return_counts=True)
        dense = held[often >= DENSE]
    out, rest = [], np.ones(len(a), dtype=bool)
    for t in dense.tolist():
        here = tile == t
        rest &= ~here
        cells = np.bincount(a[here] % TILE * TILE + b[here] % TILE, minlength=TILE * TILE)
        at = np.flatnonzero(cells)
        out.append((t // side * TILE + at // TILE, t % side * TILE + at % TILE, cells[at]))
    at, often = np.unique(a[rest] * n_ids + b[rest], return_counts=True)
    out.append((at // max(1, n_ids), at % max(1, n_ids), often))
    return tuple(np.concatenate(x) for x in zip(*out))


def _block_arrays(b, i: int) -> tuple[np.ndarray, np.ndarray]:
    return (np.frombuffer(b.column("ids")[i].as_py(), dtype="<i8"),
            unsqueezed(b.column("seq")[i].as_py(), b.column("n")[i].as_py()))


def _pairs(codes: DataFrame) -> DataFrame:
    """Pairs of every block: (block, a, b, n)."""
    names = ["block", "a", "b", "n"]

    def run(batches):
        for batch in batches:
            for i, block in enumerate(batch.column("block").to_pylist()):
                ids, seq = _block_arrays(batch, i)
                a, b, n = count_pairs(seq, len(ids))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(a), block, np.int64)), pa.array(ids[a]), pa.array(ids[b]),
                                                  pa.array(n.astype(np.int64))], names=names)
    return codes.mapInArrow(run, ", ".join(f"{c} long" for c in names))


def _recoded(codes: DataFrame, pairs: DataFrame) -> DataFrame:
    """Blocks in ids of their frequent pairs."""
    def run(key, t: pa.Table, got: pa.Table) -> pa.Table:
        if not t.num_rows or not got.num_rows:
            return _coded_rows(np.zeros(0, np.int32), 0, np.zeros(0, np.int64))
        old, seq = _block_arrays(t, 0)
        f, new, a, b = (got.column(c).to_numpy() for c in ("f", "id", "a", "b"))
        by_id = np.argsort(old)

        def place(x: np.ndarray) -> np.ndarray:
            return by_id[np.searchsorted(old[by_id], x)]
        order = _in_order(f, new)
        keys = place(a[order]) * len(old) + place(b[order])
        by_key = np.argsort(keys)
        both = (seq[:-1] >= 0) & (seq[1:] >= 0)
        mine = seq[:-1].astype(np.int64) * len(old) + seq[1:]
        at = np.minimum(np.searchsorted(keys[by_key], mine), len(keys) - 1)
        found = both & (keys[by_key[at]] == mine)
        return _coded_rows(np.where(found, by_key[at], -1).astype(np.int32), key[0].as_py(), new[order])
    have = pairs.select(F.col("block").alias("to"), "a", "b", "f", "id")
    return codes.groupBy("block").cogroup(have.groupBy("to")).applyInArrow(run, _CODES)


def _longer(phrases: DataFrame, pairs: DataFrame) -> DataFrame:
    """Frequent pairs (a, b, f, id) of phrases as phrases one word longer."""
    first = phrases.select(F.col("id").alias("a"), "lang", F.col("phrase").alias("head"), "pre")
    second = phrases.select(F.col("id").alias("b"), "last", "suf")
    own = F.array(F.col("f"))
    return pairs.join(first, "a").join(second, "b").select(
        "id", "lang", F.concat_ws(" ", "head", "last").alias("phrase"), "last", "f",
        F.concat("pre", own).alias("pre"), F.concat("suf", own).alias("suf"), "a", "b")


# the lowest score over all cuts, by exact decimals; ties to the smallest k
_CUT = """array_min(transform(sequence(1, size(pre) - 1), k -> struct(
  (cast(1000 as decimal(20,0)) * cast(a as decimal(20,0)) * cast(n as decimal(20,0)))
    div (cast(pre[k - 1] as decimal(20,0)) * cast(suf[size(suf) - k - 1] as decimal(20,0))) as score,
  k as k, pre[k - 1] as l, suf[size(suf) - k - 1] as r)))"""


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, covered_pct: int = COVERED_PCT,
                 top: int = TOP, text: str = "text", lang: str = "lang") -> DataFrame:
    """The ``top`` phrases of every language: lang, rank, phrase, a, l, r, n, score.

    A phrase of 2 to ``max_words`` words counts with ``min_count``
    occurrences or more; it is left out where a longer phrase holds it and
    has ``covered_pct`` percent of its occurrences.  Null or empty texts have
    no word, a null language is ``und``, repeated rows count each, ties go by
    rank as stated in the contract (score and count descending, phrase
    ascending in bytes).  Empty table: no rows.  Other columns are not read."""
    spark = docs.sparkSession
    prepare(spark)
    tables = _Tables(spark)
    try:
        return _mined(tables, docs.select(text, lang).toDF("text", "lang"), min_count, max_words, covered_pct, top)
    finally:
        tables.drop()


def _mined(tables: _Tables, docs: DataFrame, min_count: int, max_words: int, covered_pct: int, top: int) -> DataFrame:
    blocks = tables.keep(read_blocks(docs, "text", "lang"), "blocks")
    known = blocks.filter("seq is null")
    total = cut(known.groupBy("lang").agg(F.sum("n").alias("n")).coalesce(1))
    words = _frequent(known.select("block", "lang", "word", "code", "n"), ["lang", "word"], min_count)
    words = tables.keep(words.select("block", "lang", "word", "code", "f", "id"), "words")
    own = F.array(F.col("f"))
    level = words.groupBy("id").agg(F.first("lang").alias("lang"), F.first("word").alias("word"), F.first("f").alias("f"))
    level = cut(level.select("id", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "f", own.alias("pre"), own.alias("suf")))
    codes = tables.keep(_word_codes(blocks.filter("seq is not null").select("block", "n", "seq"), words), "codes1")
    tables.drop("blocks")
    tables.drop("words")
    found = []
    for size in range(2, max_words + 1):
        pairs = tables.keep(_frequent(_pairs(codes), ["a", "b"], min_count).select("block", "a", "b", "f", "id"), f"pairs{size}")
        ids = pairs.groupBy("id").agg(F.first("a").alias("a"), F.first("b").alias("b"), F.first("f").alias("f"))
        level = cut(_longer(level, ids))
        found.append(level)
        if size < max_words:
            codes = tables.keep(_recoded(codes, pairs), f"codes{size}")
        tables.drop(f"codes{size - 1}")
        tables.drop(f"pairs{size}")
    kept = None
    for this, longer in zip(found, [*found[1:], None]):
        rows = this.select("id", "lang", "phrase", F.col("f").alias("a"), "pre", "suf")
        if longer is not None:
            over = longer.select(F.col("a").alias("id"), "f").unionByName(longer.select(F.col("b").alias("id"), "f"))
            over = over.groupBy("id").agg(F.max("f").alias("over"))
            rows = rows.join(over, "id", "left").filter(
                F.col("over").isNull() | (100 * F.col("over") < covered_pct * F.col("a"))).drop("over")
        kept = rows if kept is None else kept.unionByName(rows)
    kept = kept.join(few(total), "lang").withColumn("cut", F.expr(_CUT))
    kept = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    best = ranked(kept, ["lang"], [F.desc("score"), F.desc("a"), F.col("phrase")]).filter(F.col("rank") < top)
    return best.select("lang", (F.col("rank") + 1).alias("rank"), "phrase", "a", "l", "r", "n", "score")
