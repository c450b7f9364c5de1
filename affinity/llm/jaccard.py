"""N-gram Jaccard join with adaptive multi-match prefixes.

A text's shingles are put in one order for all texts, rare ones first.  If
two texts reach the threshold, then for any L their prefixes of length
``size - least overlap + L`` share at least L shingles.  Each text takes the
L that its estimated cost favours: a longer prefix looks at more postings,
but asks for more shared shingles before anything is verified.  Two texts
become a candidate pair when they share the smaller of their two L.

Estimates come from a count sketch of fixed size over all texts; they steer
the order and L, never the result.  Texts of equal sets are one node.
Prefix shingles that no other node has are sorted out by packed exchange
before rows are made of them.

Links are only needed as far as they join components, and a family of near
copies must not be paired with itself.  Where many nodes share a shingle,
each is measured against one hub of them (the one with least of its own).
Those linked with it are one component.  The others near it are compared by
their differences from the hub: by the triangle inequality, and because a
linked pair has to share part of these differences, few pairs are left, and
they are verified.  What is not near the hub goes on to another hub; at
last, the pairs left of different components are verified by the rule above.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm import packing as P
from affinity.llm import text as T
from affinity.llm.common import cut, cut_narrow, narrow_parts, pick_rows, prepare, stable
from affinity.llm.components import components

SHINGLE = 5
THRESHOLD_PCT = 80
MAX_L = 64
SKETCH_BITS = 18           # cells of the count sketch: 2**18, one megabyte
SEGMENTS = 16
USUAL = 0.1                # further holders of a shingle that estimates show none for
FALL = 0.8                 # candidates left with each further shingle asked for
VERIFY_COST = 0.3          # of a candidate, in postings per shingle of the text
BROADCAST_ROWS = 500_000   # rows of two numbers that are broadcast if they are no more
BUCKETS_PER_CHUNK = 2
SMALL = 64                 # nodes at one shingle that are simply paired with each other
WORTH = 0.3                # share of postings that a round of hubs has to settle to be followed by another


def shingles(texts, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of every text: runs of ``size``
    words, A-Z lower-cased; a shorter text is one shingle, an empty one none."""
    for lo, hi, buf, offs in T.blocks(texts):
        starts, ends, first = T.word_spans(buf, offs)
        grams = T.Grams(T.word_hashes(buf, starts, ends, fold=True))
        words = np.diff(first)
        count = np.where(words >= size, words - size + 1, np.minimum(words, 1))
        at, owner = T.spread(first[:-1], count)
        h = grams.at(at, np.minimum(size, words[owner]))
        edges = np.concatenate([[0], np.cumsum(count)]).tolist()
        for i in range(hi - lo):
            yield lo + i, np.unique(h[edges[i]:edges[i + 1]])


def set_key(u: np.ndarray) -> int:
    """64-bit key of a set: equal for equal sets."""
    return int(T.mix(np.array([T.mix(u).sum(dtype=np.uint64) + np.uint64(len(u))]))[0].astype(np.int64))


def needed_overlap(n, pct: int):
    """Shingles a set of n must share with any set it links with."""
    return -(-pct * n // 100)


def prefix_choice(excess: np.ndarray, n: int, pct: int) -> tuple[int, int]:
    """(L, prefix length) of least estimated cost, from the estimated further
    holders of each shingle in order."""
    need = needed_overlap(n, pct)
    choices = np.arange(1, min(MAX_L, need) + 1)
    lengths = n - need + choices
    holders = np.cumsum(excess + USUAL)[lengths - 1]
    cost = lengths + holders + VERIFY_COST * n * holders * FALL ** (choices - 1)
    best = int(np.argmin(cost))
    return int(choices[best]), int(lengths[best])


def _first_pass(docs: DataFrame, size: int) -> DataFrame:
    """row, doc_id, n, node of every text, and the tasks' sketches (seg, cells)."""
    id_type = docs.schema["doc_id"].dataType

    def run(batches):
        cells = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
        for b in batches:
            n, node, pending = np.zeros(b.num_rows, np.int32), np.zeros(b.num_rows, np.int64), []
            for i, u in shingles(b.column("text"), size):
                n[i] = len(u)
                if len(u):
                    node[i] = set_key(u)
                    pending.append(u >> np.uint64(64 - SKETCH_BITS))
                if len(pending) >= 512:
                    cells += np.bincount(np.concatenate(pending).astype(np.int64), minlength=1 << SKETCH_BITS)
                    pending = []
            if pending:
                cells += np.bincount(np.concatenate(pending).astype(np.int64), minlength=1 << SKETCH_BITS)
            k = b.num_rows
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), b.column("doc_id"), pa.array(n), pa.array(node, mask=n == 0),
                 pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary())], names=["row", "doc_id", "n", "node", "seg", "cells"])
        if cells.any():
            parts = np.split(cells, SEGMENTS)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(SEGMENTS, pa.int64()), pa.nulls(SEGMENTS, _arrow(id_type)), pa.nulls(SEGMENTS, pa.int32()),
                 pa.nulls(SEGMENTS, pa.int64()), pa.array(range(SEGMENTS), pa.int32()),
                 pa.array([p.astype("<i8").tobytes() for p in parts], pa.binary())],
                names=["row", "doc_id", "n", "node", "seg", "cells"])
        T.give_back()
    return cut(docs.mapInArrow(run, f"row long, doc_id {id_type.simpleString()}, n int, node long, seg int, cells binary"))


def _arrow(spark_type):
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(spark_type)


def _sketch(first: DataFrame) -> np.ndarray:
    """Sum of all tasks' sketches, less what cells hold on average: the
    estimated holders beyond the usual.  Its size is fixed."""
    def total(key, t):
        cells = sum(np.frombuffer(x.as_py(), dtype="<i8") for x in t.column("cells"))
        return pa.table({"seg": [key[0].as_py()], "cells": pa.array([cells.tobytes()], pa.binary())}).cast(
            pa.schema([("seg", pa.int32()), ("cells", pa.binary())]))
    parts = first.filter("seg is not null").select("seg", "cells").groupBy("seg").applyInArrow(
        total, "seg int, cells binary").collect()
    cells = np.zeros(1 << SKETCH_BITS)
    width = len(cells) // SEGMENTS
    for r in parts:
        cells[r.seg * width:(r.seg + 1) * width] = np.frombuffer(r.cells, dtype="<i8")
    usual = float(np.median(cells))
    return np.maximum(0.0, cells - usual - 3 * usual ** 0.5).astype(np.float32)


def _live_postings(docs: DataFrame, excess: np.ndarray, size: int, pct: int, chunks: int) -> DataFrame:
    """Rows (tok, node, n, l) of the prefix shingles that several nodes have."""
    shared = docs.sparkSession.sparkContext.broadcast(excess)

    def prefixes(batches):
        seen: set[int] = set()
        for b in batches:
            out = []
            for _, u in shingles(b.column("text"), size):
                if not len(u) or (node := set_key(u)) in seen:
                    continue                       # an equal set of this task is out already
                if len(seen) > 1_000_000:
                    seen.clear()
                seen.add(node)
                e = shared.value[u >> np.uint64(64 - SKETCH_BITS)]
                order = np.lexsort((u, e))
                l, length = prefix_choice(e[order], len(u), pct)
                out.append((node % chunks, node, len(u), l, u[order[:length]].astype("<u8").tobytes()))
            cols = list(zip(*out)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(cols, (pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary()))],
                names=["chunk", "node", "n", "l", "toks"])
        seen.clear()
        T.give_back()
    dealt = docs.select("text").mapInArrow(prefixes, "chunk int, node long, n int, l int, toks binary")
    buckets = chunks * BUCKETS_PER_CHUNK

    def tokens(t: pa.Table):
        _, pick = np.unique(t.column("node").to_numpy(), return_index=True)
        t = t.take(pa.array(pick))
        toks = [np.frombuffer(x.as_py(), dtype="<u8") for x in t.column("toks")]
        owner = np.repeat(np.arange(len(toks)), [len(x) for x in toks])
        tok = np.concatenate(toks) if toks else np.zeros(0, dtype=np.uint64)
        return t, tok, owner, P.groups(tok >> np.uint64(64 - P.BITS))

    def send(key, t):
        u, _, count = tokens(t)[3]
        T.give_back()
        return P.send(key[0].as_py(), u, count > 1, buckets)

    def pick(key, t, replies):
        names = ["tok", "node", "n", "l"]
        if not t.num_rows or not replies.num_rows:
            return pa.table([pa.array([], x) for x in (pa.int64(), pa.int64(), pa.int32(), pa.int32())], names=names)
        t, tok, owner, (u, which, _) = tokens(t)
        met = P.answer(replies, 0, P.borders(u, buckets), len(u))[which]
        own = owner[met]
        T.give_back()
        return pa.table([pa.array(tok[met].view(np.int64)), *[pa.array(t.column(c).to_numpy()[own]) for c in names[1:]]],
                        names=names)
    met = dealt.groupBy("chunk").applyInArrow(send, P.ENTRY).groupBy("bucket").applyInArrow(P.meet, P.REPLY)
    return cut(dealt.groupBy("chunk").cogroup(met.groupBy("chunk")).applyInArrow(pick, "tok long, node long, n int, l int"))


def _few(df: DataFrame) -> DataFrame:
    """Broadcast a kept table of a few numbers a row if its counted rows are
    few; a larger one is left to a shuffled join."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _with_sets(pairs: DataFrame, docs: DataFrame, rows: DataFrame, size: int, a: str, b: str) -> DataFrame:
    """Adds set_a and set_b, the sorted hashes of both nodes, to kept pairs.
    Only texts of nodes in a pair are read.  Sets are one row a node, so
    where many pairs share a node AQE splits the pairs."""
    def run(batches):
        for batch in batches:
            found = [u.astype("<u8").tobytes() for _, u in shingles(batch.column("text"), size)]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(found, pa.binary())], names=["node", "set"])
        T.give_back()
    nodes = pairs.select(F.col(a).alias("node")).union(pairs.select(F.col(b).alias("node"))).distinct()
    wanted = _few(cut_narrow(rows.join(nodes, "node").select("row", "node")))
    # few of the texts that a scan task reads are wanted: several tasks' sets fit one file
    sets = docs.select("row", "text").join(wanted, "row").select("node", "text").mapInArrow(run, "node long, set binary")
    sets = cut(sets.coalesce(2 * narrow_parts(docs.sparkSession)))
    one = sets.select(F.col("node").alias(b), F.col("set").alias("set_b")).join(_few(pairs), b)
    return one.join(sets.select(F.col("node").alias(a), F.col("set").alias("set_a")), a)


def _hashes(value: pa.Scalar) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), dtype="<u8")


def _verified(pairs: DataFrame, with_sets, pct: int) -> DataFrame:
    """The pairs (a, b) that reach the threshold."""
    def run(batches):
        for batch in batches:
            keep = []
            for a, b in zip(batch.column("set_a"), batch.column("set_b")):
                both = np.concatenate([_hashes(a), _hashes(b)])
                both.sort()
                shared = int((both[1:] == both[:-1]).sum())
                keep.append(100 * shared >= pct * (len(both) - shared))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep))
        T.give_back()
    return with_sets(pairs, "a", "b").select("a", "b", "set_a", "set_b").mapInArrow(run, "a long, b long")


def difference_prefixes(size_h: int, size_x: int, difference: int, pct: int) -> tuple[int, int]:
    """How many of a node's ``difference`` from its hub h, in order, have to
    be looked at for a partner that is not linked with h (short), and, if
    the node itself is not, for a partner that is (long).

    Two sets link only if they differ from each other in at most
    c = (100 - pct) / (100 + pct) of their joint size, and what two nodes
    differ in is the symmetric difference of their differences from h.  So a
    node not linked with h and a partner share more than half of (the
    partner's difference plus c times (size of h less the partner's))."""
    twice = 2 * (100 + pct)
    short = max(1, ((100 + pct) * difference + (100 - pct) * (size_h - size_x)) // twice + 1)
    long = max(1, -(-((100 + pct) * difference - (100 - pct) * (size_h + size_x)) // twice))
    return max(0, difference - short + 1), max(0, difference - long + 1)


def _measured(pairs: DataFrame, with_sets, pct: int) -> DataFrame:
    """Every node against its hub: (h, x, n, ring, short, deltas).  Ring 0 is
    linked with h, ring 1 within twice, ring 2 within three times the
    threshold's distance, ring 3 beyond.  By the triangle inequality of the
    Jaccard distance, nodes link only with their own and neighbouring rings."""
    def run(batches):
        for batch in batches:
            n, rings, shorts, deltas = [], [], [], []
            for a, b in zip(batch.column("set_a"), batch.column("set_b")):
                hub, own = _hashes(a), _hashes(b)
                extra = np.setdiff1d(own, hub, assume_unique=True)
                missing = np.setdiff1d(hub, own, assume_unique=True)
                shared = len(own) - len(extra)
                union = len(hub) + len(extra)
                ring = next((r for r in range(3) if 100 * shared >= ((r + 1) * pct - 100 * r) * union), 3)
                short, long = difference_prefixes(len(hub), len(own), len(extra) + len(missing), pct)
                # what the hub lacks comes first: it is rarer
                d = np.concatenate([extra, missing])[:(short, max(short, long), short, 0)[ring]]
                n.append(len(own))
                rings.append(ring)
                shorts.append(short)
                deltas.append(d.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("h"), batch.column("x"), pa.array(n, pa.int32()), pa.array(rings, pa.int32()),
                 pa.array(shorts, pa.int32()), pa.array(deltas, pa.list_(pa.int64()))],
                names=["h", "x", "n", "ring", "short", "deltas"])
    return with_sets(pairs, "h", "x").select("h", "x", "set_a", "set_b").mapInArrow(
        run, "h long, x long, n int, ring int, short int, deltas array<long>")


def _differences(homes: DataFrame, with_sets, pct: int) -> DataFrame:
    """What every node x and its hub h differ in: (h, x, n, linked, delta)."""
    def run(batches):
        for batch in batches:
            n, linked, deltas = [], [], []
            for a, b in zip(batch.column("set_a"), batch.column("set_b")):
                hub, own = _hashes(a), _hashes(b)
                d = np.setxor1d(hub, own, assume_unique=True)
                shared = (len(hub) + len(own) - len(d)) // 2
                n.append(len(own))
                linked.append(100 * shared >= pct * (shared + len(d)))
                deltas.append(d.astype("<u8").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("h"), batch.column("x"), pa.array(n, pa.int32()), pa.array(linked, pa.bool_()),
                 pa.array(deltas, pa.binary())], names=["h", "x", "n", "linked", "delta"])
    return with_sets(homes, "h", "x").select("h", "x", "set_a", "set_b").mapInArrow(
        run, "h long, x long, n int, linked boolean, delta binary")


def _verified_by_differences(pairs: DataFrame, differences: DataFrame, pct: int) -> DataFrame:
    """The pairs (a, b) of nodes with one hub that reach the threshold: two
    nodes differ in the symmetric difference of what they differ from the hub
    in, so the sets themselves need not be moved."""
    def run(batches):
        for batch in batches:
            keep = []
            for n_a, n_b, a, b in zip(batch.column("n_a").to_pylist(), batch.column("n_b").to_pylist(),
                                      batch.column("d_a"), batch.column("d_b")):
                apart = len(np.setxor1d(_hashes(a), _hashes(b), assume_unique=True))
                shared = (n_a + n_b - apart) // 2
                keep.append(100 * shared >= pct * (shared + apart))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep))
    for side in ("a", "b"):
        pairs = pairs.join(differences.select(F.col("x").alias(side), F.col("n").alias(f"n_{side}"),
                                              F.col("delta").alias(f"d_{side}")), side)
    return pairs.select("a", "b", "n_a", "n_b", "d_a", "d_b").mapInArrow(run, "a long, b long")


def _verified_through_hubs(pairs: DataFrame, rank: DataFrame, with_sets, pct: int) -> DataFrame:
    """The kept pairs (a, b) that reach the threshold, with each node's set
    moved about once: every node is measured against the best ranked of its
    partners, and pairs with the same hub are compared by differences."""
    ends = pairs.select(F.col("a").alias("x"), F.col("b").alias("y")).union(pairs.select("b", "a"))
    order = F.struct("rank", F.xxhash64("node").alias("order"), "node")
    ranked = cut_narrow(rank.join(ends.select(F.col("x").alias("node")).distinct(), "node").select("node", order.alias("o")))
    best = ends.join(ranked.select(F.col("node").alias("y"), "o"), "y").groupBy("x").agg(F.min("o").alias("o"))
    homes = best.join(ranked.select(F.col("node").alias("x"), F.col("o").alias("own")), "x").select(
        "x", F.least("o", "own")["node"].alias("h"))
    homes = cut_narrow(homes)
    differences = cut_narrow(_differences(cut_narrow(homes.filter("h != x")), with_sets, pct))
    for side in ("a", "b"):
        pairs = pairs.join(_few(homes.select(F.col("x").alias(side), F.col("h").alias(f"h_{side}"))), side)
    pairs = cut_narrow(pairs.filter("h_a != b and h_b != a"))        # the others are measured already
    same = pairs.filter("h_a = h_b").select("a", "b")
    others = cut_narrow(pairs.filter("h_a != h_b").select("a", "b"))
    return (differences.filter("linked").select(F.col("h").alias("a"), F.col("x").alias("b"))
            .unionByName(_verified_by_differences(same, differences, pct))
            .unionByName(_verified(others, with_sets, pct)))


def _pairs(j: DataFrame, pct: int) -> DataFrame:
    """Condition on sizes that any link meets."""
    return j.filter(100 * F.least("n", "n_b") >= pct * F.greatest("n", "n_b"))


def _renamed(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*keys, *[F.col(c).alias(f"{c}_b") for c in df.columns if c not in keys])


def _ring_candidates(measured: DataFrame, pct: int) -> DataFrame:
    """Pairs of ring 1 with rings 0, 1 and 2 of the same hub that share a
    difference from it inside their prefixes."""
    d = measured.filter("ring < 3").select("h", "x", "n", "ring", "short", F.posexplode("deltas").alias("i", "delta"))
    d = d.select("h", "delta", "x", "n", "ring", (F.col("i") < F.col("short")).alias("early"))
    left, right = d.filter("ring = 1"), _renamed(d.filter("early"), ["h", "delta"])
    j = left.join(right, ["h", "delta"]).filter(
        (F.col("ring_b") == 0) | F.col("early") & ((F.col("ring_b") == 2) | (F.col("x") < F.col("x_b"))))
    return _pairs(j, pct).select(F.least("x", "x_b").alias("a"), F.greatest("x", "x_b").alias("b")).distinct()


def _prefix_candidates(postings: DataFrame, pct: int) -> DataFrame:
    """Pairs that share as many prefix shingles as the smaller of their two L."""
    j = postings.join(_renamed(postings, ["tok"]), "tok").filter(F.col("node") < F.col("node_b"))
    return _pairs(j, pct).groupBy(F.col("node").alias("a"), F.col("node_b").alias("b")).agg(
        F.count(F.lit(1)).alias("shared"), F.first(F.least("l", "l_b")).alias("l")).filter("shared >= l").select("a", "b")


def _in_components(df: DataFrame, labels: DataFrame | None, node: str, out: str) -> DataFrame:
    if labels is None:
        return df.withColumn(out, F.col(node))
    own = labels.select(F.col("node").alias(node), F.col("comp").alias("_comp"))
    return df.join(own, node, "left").withColumn(out, F.coalesce("_comp", node)).drop("_comp")


def node_components(docs: DataFrame, first: DataFrame, size: int, pct: int, chunks: int) -> DataFrame | None:
    """(node, comp) of all linked nodes; None without any link."""
    live = _live_postings(docs, _sketch(first), size, pct, chunks)
    rows = first.filter("node is not null").groupBy("node").agg(F.min("row").alias("row"))

    def with_sets(pairs: DataFrame, a: str, b: str) -> DataFrame:
        return _with_sets(pairs, docs, rows, size, a, b)
    # shingles of many nodes, found by counts combined map-side, go through hubs
    many = live.groupBy("tok").agg(F.count(F.lit(1)).alias("held")).filter(F.col("held") > SMALL).select("tok")
    many = cut_narrow(many)
    rest = live.join(_few(many), "tok", "left_anti")
    # a hub should have little of its own: most of its prefix is shared
    prefix = F.col("n") - F.ceil(F.col("n") * pct / 100) + F.col("l")
    rank = cut_narrow(live.groupBy("node").agg((-F.count(F.lit(1)) / F.first(prefix)).alias("rank")))
    open_ = cut_narrow(live.join(_few(many), "tok").join(rank, "node"))
    links = labels = None

    def link(new: DataFrame) -> None:
        nonlocal links, labels
        links = new if links is None else links.unionByName(new)
        labels = cut_narrow(components(links))
    while True:
        hubs = open_.groupBy("tok").agg(F.count(F.lit(1)).alias("held"), F.min(F.struct(
            "rank", F.xxhash64("node").alias("order"), "node", "n")).alias("hub"))
        hubs = hubs.filter(F.col("held") > SMALL).select("tok", F.col("hub.node").alias("h"), F.col("hub.n").alias("n_h"))
        families = cut_narrow(open_.join(hubs, "tok").select("tok", "h", F.col("node").alias("x"), "n", "n_h"))
        postings = families.count()
        if not postings:
            break
        # sizes alone put the others beyond ring 2
        near = families.filter("h != x").filter(
            100 * F.least("n", "n_h") >= (3 * pct - 200) * F.greatest("n", "n_h")).select("h", "x").distinct()
        measured = cut_narrow(_measured(cut_narrow(near), with_sets, pct))
        link(measured.filter("ring = 0").select(F.col("h").alias("a"), F.col("x").alias("b")))
        pairs = _in_components(_in_components(_ring_candidates(measured, pct), labels, "a", "_a"), labels, "b", "_b")
        new = cut_narrow(_verified(cut_narrow(pairs.filter("_a != _b").select("a", "b")), with_sets, pct))
        if not new.isEmpty():
            link(new)
        # hubs, ring 0 and ring 1 have met all they could link with at this shingle
        done = families.join(measured.filter("ring < 2").select("h", "x", F.lit(True).alias("_done")), ["h", "x"], "left")
        done = done.filter(F.coalesce("_done", F.col("h") == F.col("x"))).select("tok", F.col("x").alias("node"))
        open_ = cut_narrow(open_.join(done, ["tok", "node"], "left_anti"))
        if done.count() < WORTH * postings:
            break                      # mostly unrelated texts: hubs tell little about them
    pairs = cut_narrow(_prefix_candidates(rest.unionByName(open_.drop("rank")), pct))
    pairs = _in_components(_in_components(pairs, labels, "a", "_a"), labels, "b", "_b")
    pairs = cut_narrow(pairs.filter("_a != _b").select("a", "b"))
    new = cut_narrow(_verified_through_hubs(pairs, rank, with_sets, pct))
    if not new.isEmpty():
        link(new)
    return labels


def jaccard_components(docs: DataFrame, size: int = SHINGLE, pct: int = THRESHOLD_PCT, text: str = "text") -> DataFrame:
    """Per row of ``docs``: row (number in the scan), doc_id, n_shingles,
    component_id (smallest doc_id reachable by links), keeper (the row of
    that doc_id that stands for the component).

    Two texts link when 100 * |A and B| >= pct * |A or B|, so texts of equal
    sets always do.  Null, empty and blank texts have no shingle and link
    with nothing: their own doc_id, keeper of themselves.  A null doc_id
    counts only where a component has no other.  Repeated rows are one node.
    Empty table: no rows.  Other columns are not read."""
    spark = docs.sparkSession
    chunks = prepare(spark)
    d = stable(docs).select(F.monotonically_increasing_id().alias("row"), "doc_id", F.col(text).alias("text"))
    first = _first_pass(d, size)
    rows = first.filter("seg is null").select("row", "doc_id", "n", "node")
    labels = node_components(d, first, size, pct, chunks)
    nodes = rows.filter("node is not null").groupBy("node").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("least"))
    if labels is None:
        nodes = nodes.withColumn("comp", F.col("node"))
    else:
        nodes = nodes.join(labels.withColumnRenamed("comp", "_c"), "node", "left").withColumn(
            "comp", F.coalesce("_c", "node")).drop("_c")
    nodes = cut_narrow(nodes)
    least = nodes.groupBy("comp").agg(F.min("least").alias("least"))
    of_node = nodes.select("node", "comp").join(least, "comp").select(
        F.col("node").alias("_node"), F.col("least.doc_id").alias("_id"), F.col("least.row").alias("_row"))
    j = rows.join(of_node, F.col("node") == F.col("_node"), "left")
    return j.select("row", "doc_id", F.col("n").cast("long").alias("n_shingles"),
                    F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("_id")).alias("component_id"),
                    F.coalesce("_row", "row").alias("keeper"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Four-word shingles, similarity 0.85 or more: doc_id, n_shingles, component_id."""
    return jaccard_components(docs, size=4, pct=85).select("doc_id", "n_shingles", "component_id")


def keep_one(docs: DataFrame, size: int = SHINGLE, pct: int = THRESHOLD_PCT) -> DataFrame:
    """``docs`` with one row of each component, that of the smallest doc_id;
    texts without shingles all stay.  Same columns."""
    docs = stable(docs)
    return pick_rows(docs, jaccard_components(docs, size, pct).filter("row = keeper"))
