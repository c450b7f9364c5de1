"""Quality classifier: histogram gradient-boosted trees over document
statistics.

The statistics of all texts are computed in one pass, with numpy over whole
blocks of texts.  The trees are fitted on the driver to a bounded sample of
labelled rows (``MAX_TRAIN`` rows of about thirty numbers), on binned
statistics, and flattened into arrays: scoring walks all rows of a batch
down all trees by array indexing.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.llm import text as T
from affinity.llm.common import cut, hash_sample, prepare
from affinity.sources.tables import read_table

MAX_TRAIN = 40_000       # labelled rows that reach the driver at most
FOLDS = 5                # rows whose crc32 leaves 0 are held out
KEEP_FROM = 0.3          # score from which a text counts as good
TREES, DEPTH, BINS, RATE = 120, 4, 64, 0.1
L2, MIN_WEIGHT = 0.3, 0.3

# Byte classes: what a text is made of.
_CLASSES = ("space", "newline", "lower", "upper", "digit", "stop", "bang", "quote", "symbol", "other", "lead", "tail")


def _byte_classes() -> np.ndarray:
    c = np.full(256, _CLASSES.index("other"), dtype=np.int64)

    def put(name, chars):
        c[[ord(x) for x in chars]] = _CLASSES.index(name)
    put("space", " \t\r\v\f")
    put("newline", "\n")
    put("lower", "abcdefghijklmnopqrstuvwxyz")
    put("upper", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    put("digit", "0123456789")
    put("stop", ".,;:")
    put("bang", "!?")
    put("quote", "\"'()[]{}-")
    put("symbol", "#*$%&|<>@^~_=+\\/`")
    c[0x80:0xC0] = _CLASSES.index("tail")
    c[0xC0:] = _CLASSES.index("lead")
    return c


_CLASS = _byte_classes()
STATISTICS = ([f"share_{c}" for c in _CLASSES if c != "tail"]
              + ["log_bytes", "log_words", "log_lines", "word_mean", "word_sd", "word_max", "words_per_line",
                 "distinct_words", "distinct_pairs", "same_as_before", "top_word", "distinct_lines",
                 "end_symbol", "end_bang", "end_stop", "start_upper", "all_upper", "lone_symbol", "short_words"])


def _per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of per-word values by text (texts without words: 0)."""
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[first[1:]] - total[first[:-1]]


def _distinct(hashes: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """By text: number of distinct hashes, and the count of the commonest."""
    order = np.lexsort((hashes, owner))
    h, o = hashes[order], owner[order]
    new = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (o[1:] != o[:-1]))) if len(h) else np.zeros(0, dtype=int)
    run = np.diff(np.append(new, len(h)))
    top = np.zeros(n)
    np.maximum.at(top, o[new], run)
    return np.bincount(o[new], minlength=n).astype(float), top


def block_statistics(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """One row of STATISTICS per text of a block."""
    n, k = len(offs) - 1, len(_CLASSES)
    size = np.diff(offs)
    doc = np.repeat(np.arange(n), size)
    cls = _CLASS[buf]
    by_class = np.bincount(doc * k + cls, minlength=n * k).reshape(n, k).astype(float)
    chars = np.maximum(1.0, size - by_class[:, k - 1])
    starts, ends, first = T.word_spans(buf, offs)
    h = T.word_hashes(buf, starts, ends)
    words = np.diff(first).astype(float)
    w = np.maximum(words, 1.0)
    owner = np.repeat(np.arange(n), np.diff(first))
    length = (ends - starts).astype(float)
    upto = np.concatenate([[0], np.cumsum(cls == _CLASSES.index("upper"))])
    letters = np.concatenate([[0], np.cumsum((cls == _CLASSES.index("lower")) | (cls >= _CLASSES.index("lead")))])
    upper = upto[ends] - upto[starts]
    lower = letters[ends] - letters[starts]
    mean = _per_text(length, first) / w
    longest = np.zeros(n)
    np.maximum.at(longest, owner, length)
    head, tail = cls[starts], cls[ends - 1]

    def share(mask):
        return _per_text(mask, first) / w
    same = np.append(False, (h[1:] == h[:-1]) & (owner[1:] == owner[:-1])) if len(h) else np.zeros(0, dtype=bool)
    distinct, top = _distinct(h, owner, n)
    pair_at = np.flatnonzero(owner[1:] == owner[:-1]) if len(h) else np.zeros(0, dtype=int)
    pairs = T.Grams(h).at(pair_at, 2)
    distinct_pairs, _ = _distinct(pairs, owner[pair_at], n)
    lines = by_class[:, 1] + 1
    # distinct lines: hashes of the words between line breaks
    breaks = np.concatenate([[0], np.cumsum(buf == 10)])
    line_of = breaks[starts]
    line_first = np.flatnonzero(np.append(True, (line_of[1:] != line_of[:-1]) | (owner[1:] != owner[:-1]))) if len(h) \
        else np.zeros(0, dtype=int)
    line_len = np.diff(np.append(line_first, len(h)))
    line_hash = T.Grams(h).at(line_first, line_len)
    full_lines = np.bincount(owner[line_first], minlength=n).astype(float)
    distinct_lines, _ = _distinct(line_hash, owner[line_first], n)
    index = _CLASSES.index
    cols = [by_class[:, i] / chars for i, c in enumerate(_CLASSES) if c != "tail"]
    cols += [np.log1p(size), np.log1p(words), np.log1p(lines), mean,
             np.sqrt(np.maximum(0.0, _per_text(length * length, first) / w - mean * mean)), longest,
             words / np.maximum(full_lines, 1.0), distinct / w, distinct_pairs / np.maximum(words - 1, 1.0), share(same),
             top / w, distinct_lines / np.maximum(full_lines, 1.0),
             share((tail == index("symbol")) & (length > 1)), share(tail == index("bang")), share(tail == index("stop")),
             share(head == index("upper")), share((upper > 1) & (lower == 0)),
             share((length == 1) & (head == index("symbol"))), share(length <= 2)]
    return np.column_stack(cols).astype(np.float32)


def batch_statistics(texts: pa.Array) -> np.ndarray:
    parts = [block_statistics(buf, offs) for _, _, buf, offs in T.blocks(texts)]
    return np.concatenate(parts) if parts else np.zeros((0, len(STATISTICS)), dtype=np.float32)


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id and stats (binary, one 32-bit float per statistic) of every
    row, in the shared folder.  Null texts count as empty."""
    src = docs.select("doc_id", text)
    id_type = src.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            x = batch_statistics(b.column(1))
            width = x.shape[1] * 4
            bits = pa.Array.from_buffers(pa.binary(), len(x), [
                None, pa.py_buffer(np.arange(0, (len(x) + 1) * width, width, dtype=np.int32)),
                pa.py_buffer(np.ascontiguousarray(x))])
            yield pa.RecordBatch.from_arrays([b.column(0), bits], names=["doc_id", "stats"])
        T.give_back()
    return cut(src.mapInArrow(run, f"doc_id {id_type}, stats binary"))


def unpack(stats) -> np.ndarray:
    joined = b"".join(stats)
    return np.frombuffer(joined, dtype="<f4").reshape(-1, len(STATISTICS))


@dataclass
class Trees:
    """Complete binary trees of one depth in heap order: inner node ``i`` of
    tree ``t`` asks whether statistic ``feature[t, i]`` is above
    ``border[t, i]``; its children are 2i+1 and 2i+2."""

    base: float
    feature: np.ndarray
    border: np.ndarray
    leaf: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 per row."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        depth = (self.feature.shape[1] + 1).bit_length() - 1 if self.feature.size else 0
        for f, b, leaf in zip(self.feature, self.border, self.leaf):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, f[node]] > b[node])
            total += leaf[node - len(f)]
        return 1.0 / (1.0 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Boost trees on the logistic loss; splits are looked for between the
    bins of each statistic.  Without rows, or with one label only, the score
    is the share of label 1 (0.5 without rows)."""
    inner, leaves = (1 << depth) - 1, 1 << depth
    p = (y.sum() + 1.0) / (len(y) + 2.0)
    model = Trees(float(np.log(p / (1 - p))), np.zeros((0, inner), np.int64), np.zeros((0, inner), np.float32),
                  np.zeros((0, leaves)))
    if not len(y) or y.min() == y.max():
        return model
    n, k = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])).astype(np.float32) for j in range(k)]
    binned = np.column_stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)])
    flat = binned + np.arange(k) * BINS                       # (statistic, bin) as one number
    margin = np.full(n, model.base)
    features, borders, leaf_values = [], [], []
    for _ in range(trees):
        prob = 1.0 / (1.0 + np.exp(-margin))
        g, h = prob - y, prob * (1 - prob)
        node = np.zeros(n, dtype=np.int64)                    # within its level
        f, b = np.zeros(inner, np.int64), np.full(inner, np.inf, np.float32)
        cut_at = np.full(inner, BINS, np.int64)
        for level in range(depth):
            width = 1 << level
            cell = (node[:, None] * (k * BINS) + flat).ravel()
            G, H = (np.bincount(cell, weights=np.repeat(v, k), minlength=width * k * BINS).reshape(width, k, BINS)
                    .cumsum(axis=2) for v in (g, h))
            gt, ht = G[:, :, -1:], H[:, :, -1:]
            gain = G * G / (H + L2) + (gt - G) ** 2 / (ht - H + L2) - gt * gt / (ht + L2)
            gain[(H < MIN_WEIGHT) | (ht - H < MIN_WEIGHT)] = -1.0
            best = gain.reshape(width, -1).argmax(axis=1)
            good = gain.reshape(width, -1)[np.arange(width), best] > 1e-6
            for i in np.flatnonzero(good):
                j, c = divmod(int(best[i]), BINS)
                if c < len(edges[j]):
                    f[width - 1 + i], b[width - 1 + i], cut_at[width - 1 + i] = j, edges[j][c], c
            at = width - 1 + node
            node = 2 * node + (binned[np.arange(n), f[at]] > cut_at[at])
        gs, hs = (np.bincount(node, weights=v, minlength=leaves) for v in (g, h))
        value = -RATE * gs / (hs + L2)
        margin += value[node]
        features.append(f)
        borders.append(b)
        leaf_values.append(value)
    return Trees(model.base, np.array(features), np.array(borders), np.array(leaf_values))


def held_out(doc_id: str = "doc_id"):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == 0


def train(stats: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Trees:
    """Fit to the labelled rows that are not held out, at most ``max_train``
    of them: those of the smallest hashes of doc_id, a sample that does not
    depend on order or partitions.  Rows without label, and labels without
    row, are left out."""
    y = labels.filter(F.col("quality").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    got = hash_sample(stats.join(y, "doc_id"), "doc_id", max_train, seed=1).select("quality", "stats").toArrow()
    if not got.num_rows:
        return fit(np.zeros((0, len(STATISTICS)), np.float32), np.zeros(0))
    return fit(unpack(got.column("stats").to_pylist()), (got.column("quality").to_numpy() > 0).astype(float))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted.

    Null and empty texts are scored as texts without words.  A null doc_id is
    neither held out nor learnt from.  Repeated rows: one result each.  Empty
    table: no rows.  Only doc_id and text of ``docs``, doc_id and quality of
    ``labels`` are read; doc_id only joins the two."""
    spark = docs.sparkSession
    prepare(spark)
    stats = statistics(docs)
    model = spark.sparkContext.broadcast(train(stats, labels))
    id_type = stats.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            s = model.value.score(unpack(b.column("stats").to_pylist()))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(s)], names=["doc_id", "score"])
    scored = stats.mapInArrow(run, f"doc_id {id_type}, score double")
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= KEEP_FROM).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the rows that the classifier rejects; same columns.
    The second pass over the texts scores and filters rows where they lie."""
    spark = docs.sparkSession
    prepare(spark)
    model = spark.sparkContext.broadcast(train(statistics(docs, text), labels))

    def run(batches):
        for b in batches:
            s = model.value.score(batch_statistics(b.column(text)))
            yield b.filter(pa.array(s >= KEEP_FROM))
        T.give_back()
    return docs.mapInArrow(run, docs.schema)


def quality_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
