"""Byte-level BPE encoding and decoding.

Long texts are cut into overlapping chunks that are pre-tokenised in
parallel.  Pre-tokenising depends only on where it starts, so once two
neighbouring chunks have a piece boundary in common inside their overlap,
they agree from there on: the text is cut at these resynchronisation points
and each part is encoded by itself.  Where an overlap has no common boundary
(a run longer than the overlap), the chunks from there to the text's end are
joined and cut in one go, so the result is always that of the whole text.
Decoding concatenates the tokens' bytes.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from affinity.llm import text as T
from affinity.llm.common import stable

CHUNK = 32_768          # characters a chunk answers for
OVERLAP = 1_024         # characters a chunk reads on into the next one
MARGIN = 4              # boundaries this near to a cut-off end are not trusted
CACHE = 400_000         # pieces kept per Python worker
_LONG = 64              # bytes from which merging goes through a heap


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file: base64 token and rank per line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


# The public pre-tokenisation pattern, and a form of it for the
# standard library's faster ``re``.  Both match alike on texts made only of
# the characters of ``_SIMPLE`` (Latin letters, ASCII, common punctuation;
# checked for each character in tests); other texts take the first form.
_PUBLIC = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_PLAIN = r" ?[^\W\d_]+|'(?:[stmd]|re|ve|ll)| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"
_SIMPLE = "\x00-\x1b\x20-\x7f\xa0-\xb1\xb4-\xb8\xba\xbb\xbf-\u01bf\u0200-\u021f\u2010-\u2027"
_NONE = np.int64(1) << 40


class Codec:
    """Encoder and decoder of one vocabulary; lives in a Python worker.
    ``cache[piece]`` is a piece's ids as little-endian 32-bit integers."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.plain = re.compile(_PLAIN) if pattern == _PUBLIC else None
        self.odd = re.compile(f"[^{_SIMPLE}]")
        size = max(ranks.values(), default=-1) + 1
        words = [b""] * size
        for token, rank in ranks.items():
            words[rank] = token
        self.bytes_of = words
        self.cache: dict[str, bytes] = {}
        self._pairs: tuple | None = None

    def _matcher(self, text: str):
        return self.pattern if self.plain is None or self.odd.search(text) else self.plain

    def pieces(self, text: str) -> list[str]:
        return self._matcher(text).findall(text)

    def starts(self, text: str) -> list[int]:
        return [m.start() for m in self._matcher(text).finditer(text)]

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Every two tokens that join into a token: sorted keys and ranks."""
        if self._pairs is None:
            ranks, keys, to = self.ranks, [], []
            for token, rank in ranks.items():
                for i in range(1, len(token)):
                    left, right = ranks.get(token[:i]), ranks.get(token[i:])
                    if left is not None and right is not None:
                        keys.append(left << 32 | right)
                        to.append(rank)
            k, r = np.array(keys, dtype=np.int64), np.array(to, dtype=np.int64)
            o = np.argsort(k)
            self._pairs = np.append(k[o], np.int64(-1)), np.append(r[o], _NONE)
        return self._pairs

    def merge_many(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of many pieces at once: in every piece join the neighbouring
        pair of lowest rank, the leftmost of equals, until none is left."""
        keys, to = self.pairs()
        n = len(keys) - 1

        def rank(left, right):
            key = left << 32 | right
            at = np.searchsorted(keys[:n], key)
            return np.where(keys[at] == key, to[at], _NONE)
        single = np.array([self.ranks[bytes([i])] for i in range(256)], dtype=np.int64)
        tok = single[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        own = np.repeat(np.arange(len(pieces)), [len(p) for p in pieces])
        out: list = [None] * len(pieces)
        same = np.append(own[1:] == own[:-1], False) if len(own) else np.zeros(0, dtype=bool)
        r = np.full(len(tok), _NONE)
        i = np.flatnonzero(same)
        r[i] = rank(tok[i], tok[i + 1])
        while len(tok):
            first = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
            size = np.diff(np.append(first, len(tok)))
            best = np.repeat(np.minimum.reduceat(r, first), size)
            open_ = best < _NONE
            if not open_.all():
                done = np.flatnonzero(~open_[first])
                bits = tok.astype("<u4")
                for f, c, o in zip(first[done].tolist(), size[done].tolist(), own[first[done]].tolist()):
                    out[o] = bits[f:f + c].tobytes()
                tok, own, r, best = tok[open_], own[open_], r[open_], best[open_]
                if not len(tok):
                    break
            hit = np.flatnonzero(r == best)
            hit = hit[np.append(True, own[hit[1:]] != own[hit[:-1]])]
            tok[hit] = r[hit]
            stay = np.ones(len(tok), dtype=bool)
            stay[hit + 1] = False
            at = hit - np.arange(len(hit))          # its place once the right halves are gone
            tok, own, r = tok[stay], own[stay], r[stay]
            last = len(tok) - 1
            for i in (at, at[at > 0] - 1):
                j = np.minimum(i + 1, last)
                r[i] = np.where((i < last) & (own[i] == own[j]), rank(tok[i], tok[j]), _NONE)
        return out

    def _merge_heap(self, piece: bytes) -> list[int]:
        """The same for one long piece: a heap of pairs over a linked list."""
        ranks, n = self.ranks, len(piece)
        if piece in ranks:
            return [ranks[piece]]
        part: list = [piece[i:i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, bytes, bytes]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n and (r := ranks.get(part[i] + part[j])) is not None:
                heapq.heappush(heap, (r, i, part[i], part[j]))
        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            if part[i] is not left or (j := after[i]) >= n or part[j] is not right:
                continue                                     # a part of it was merged meanwhile
            part[i], part[j] = left + right, None
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [ranks[p] for p in part if p is not None]

    def part_pieces(self, text: str, ahead: str) -> list[str]:
        """Pieces of a part that ends at a piece boundary, before ``ahead``:
        where a piece ends may hang on what follows it."""
        pieces = self.pieces(text + ahead)
        size = len(text) + len(ahead)
        while size > len(text):
            size -= len(pieces.pop())
        return pieces

    def encode(self, texts: list[str], ahead: list[str] | None = None) -> list[bytes]:
        """Ids of texts, or of parts that end at a piece boundary."""
        ahead = ahead or [""] * len(texts)
        cache = self.cache
        if len(cache) > CACHE:
            cache.clear()
        out: list[bytes] = []
        for lo in range(0, len(texts), 64):
            cut = [self.part_pieces(t, a) if a else self.pieces(t) for t, a in zip(texts[lo:lo + 64], ahead[lo:lo + 64])]
            new = {p for pieces in cut for p in pieces if p not in cache}
            local = {}
            if new:
                plain = []
                for p in new:
                    b = p.encode("utf-8")
                    if b in self.ranks:                      # a whole piece that is a token stays one
                        cache[p] = self.ranks[b].to_bytes(4, "little")
                    elif len(b) < _LONG:
                        plain.append((p, b))
                    else:
                        local[p] = np.array(self._merge_heap(b), dtype="<u4").tobytes()
                cache.update(zip([p for p, _ in plain], self.merge_many([b for _, b in plain])))
            for pieces in cut:
                out.append(b"".join([cache[p] if p in cache else local[p] for p in pieces] if local
                                    else [cache[p] for p in pieces]))
        return out

    def decode(self, bits: bytes) -> bytes:
        words = self.bytes_of
        return b"".join([words[i] for i in np.frombuffer(bits, dtype="<u4").tolist()])


_CODECS: dict = {}


def share(spark: SparkSession, ranks: dict[bytes, int], pattern: str) -> tuple:
    """Broadcast a vocabulary, with a key of its content under which a
    worker keeps its codec (and the codec's cache) across tasks."""
    key = hashlib.sha1(pattern.encode() + b"".join(
        token + rank.to_bytes(4, "little") for token, rank in sorted(ranks.items()))).hexdigest()
    return key, spark.sparkContext.broadcast((ranks, pattern))


def codec(shared: tuple) -> Codec:
    key, value = shared
    if key not in _CODECS:
        _CODECS[key] = Codec(*value.value)
    return _CODECS[key]


def _over(df: DataFrame, text: str, schema: str, fn) -> DataFrame:
    """mapInArrow with the other columns kept: ``fn(batch, text values)``
    yields the new columns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield fn(batch, batch.column(text).to_pylist())
        T.give_back()
    return df.mapInArrow(run, schema)


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text",
           chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Per row of ``docs``: row (number in the scan), doc_id, ids (binary,
    little-endian unsigned 32-bit).  Null and empty texts: no ids.  Repeated
    rows each get a row.  Other columns are not read.

    ``ranks`` is a vocabulary file's content (a fixed size of about a
    megabyte), broadcast once."""
    spark = docs.sparkSession
    shared = share(spark, ranks, pattern)
    d = stable(docs).select(F.monotonically_increasing_id().alias("row"), "doc_id",
                    F.coalesce(F.col(text), F.lit("")).alias("part"))
    short = F.length("part") <= chunk + overlap

    def encoded(batch, texts):
        c = codec(shared)
        return pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("doc_id"), batch.column("seg"),
             pa.array(c.encode(texts, batch.column("ahead").to_pylist()), pa.binary())], names=["row", "doc_id", "seg", "ids"])
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"row long, doc_id {id_type}, seg int, ids binary"
    whole = _over(d.filter(short).select("row", "doc_id", F.lit(0).alias("seg"), "part", F.lit("").alias("ahead")),
                  "part", schema, encoded)
    cuts = _cut_long(d.filter(~short), shared, chunk, overlap)
    parts = _over(cuts, "part", schema, encoded)
    # ids of one text come together only here; a text is one row anyway
    joined = parts.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.sort_array(F.collect_list(F.struct("seg", "ids"))).alias("p")).select(
        "row", "doc_id", F.unhex(F.array_join(F.transform("p.ids", F.hex), "")).alias("ids"))      # joined once, as text
    return whole.select("row", "doc_id", "ids").unionByName(joined)


def _cut_long(long: DataFrame, shared, chunk: int, overlap: int) -> DataFrame:
    """Cut long texts at resynchronisation points: (row, doc_id, seg, part,
    ahead: the characters after it)."""
    n = F.length("part")
    last = F.floor((n - 1) / chunk).cast("int")
    ch = long.select("row", "doc_id", F.posexplode(F.sequence(F.lit(0), last)).alias("i", "_i"), "part").select(
        "row", "doc_id", "i", (n > (F.col("i") + 1) * chunk + overlap).alias("cut"),
        F.col("part").substr(F.col("i") * chunk + 1, F.lit(chunk + overlap)).alias("part"))
    spread = ch.repartition(F.col("row"), F.col("i"))

    def bounds(batch, texts):
        c = codec(shared)
        heads, tails = [], []
        for t, is_cut in zip(texts, batch.column("cut").to_pylist()):
            s = c.starts(t)
            end = len(t) - MARGIN if is_cut else len(t)
            heads.append([x for x in s if x <= overlap - MARGIN])
            tails.append([x - chunk for x in s if chunk <= x <= end])
        return pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("i"), pa.array(heads, pa.list_(pa.int32())),
             pa.array(tails, pa.list_(pa.int32()))], names=["row", "i", "head", "tail"])
    edges = _over(spread.select("row", "i", "cut", "part"), "part",
                  "row long, i int, head array<int>, tail array<int>", bounds)
    w = Window.partitionBy("row").orderBy("i")
    # offset, inside chunk i, of the first boundary that chunk i-1 also has
    met = F.array_min(F.array_intersect(F.col("head"), F.lag("tail").over(w)))
    e = edges.withColumn("sync", F.when(F.col("i") == 0, F.lit(0)).otherwise(met))
    # a chunk is in step only if all before it are
    e = e.withColumn("ok", F.min(F.col("sync").isNotNull()).over(w))
    e = e.withColumn("start", F.when(F.col("ok"), F.col("sync")))
    e = e.withColumn("stop", F.lead("start").over(w))      # inside the next chunk; null: none, or out of step
    e = e.withColumn("seg", (F.sum(F.col("ok").cast("int")).over(w) - 1).cast("int"))
    e = e.select("row", "i", "start", "stop", "seg", F.lead("i").over(w).isNull().alias("end"))
    j = spread.join(e, ["row", "i"])
    # own characters of the chunk: from its start to the next chunk's start;
    # chunks out of step add exactly their own chunk to the segment before
    first = F.coalesce(F.col("start"), F.lit(0))
    size = F.when(F.col("stop").isNotNull(), F.lit(chunk) + F.col("stop") - first).otherwise(
        F.when(F.col("end"), F.length("part")).otherwise(F.lit(chunk) - first))
    j = j.select("row", "doc_id", "i", "seg", F.col("part").substr(first + 1, size).alias("part"),
                 F.col("part").substr(first + 1 + size, F.lit(MARGIN)).alias("ahead"))
    parts = F.sort_array(F.collect_list(F.struct("i", "part", "ahead")))
    return j.groupBy("row", "seg").agg(F.first("doc_id").alias("doc_id"), parts.alias("p")).select(
        "row", "doc_id", "seg", F.array_join(F.col("p.part"), "").alias("part"),
        F.element_at("p", -1)["ahead"].alias("ahead"))


def decode(encoded: DataFrame, ranks: dict[bytes, int], ids: str = "ids", out: str = "bytes") -> DataFrame:
    """Adds the decoded bytes of a binary id column; the other columns stay,
    but one named like ``out``, in any case, is replaced.  Null ids give
    empty bytes."""
    spark = encoded.sparkSession
    encoded = encoded.select(*[F.col(f"`{c}`") for c in encoded.columns if c.lower() != out.lower()])
    shared = share(spark, ranks, "")
    schema = StructType(list(encoded.schema.fields)).add(out, "binary")

    def run(batches):
        c = codec(shared)
        for batch in batches:
            new = pa.array([c.decode(x) if x else b"" for x in batch.column(ids).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, new], names=[*batch.schema.names, out])
    return encoded.mapInArrow(run, schema)


def digests(decoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of encoded and decoded rows."""
    return decoded.select("doc_id", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                          F.sha2("ids", 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))


def encode_and_decode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Encode whole texts by a vocabulary file (default: the public 50k byte
    vocabulary) and decode the ids again: doc_id, n_tokens, ids_sha256,
    decoded_sha256."""
    import public_tokenizers
    ranks = load_ranks(path or public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return digests(decode(encode(docs, ranks, public_tokenizers.PATTERN), ranks))
