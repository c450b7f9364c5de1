"""Approximate nearest neighbours by balanced posting lists.

Vectors are clustered on a bounded sample by splitting clusters until each
is small, so lists are balanced.  Every vector goes to its nearest list and,
if it lies near a border, to further lists whose distance is within a ratio
of the nearest.  Centroids (a bounded number) are searched through a graph
of their neighbours held in memory.  A query looks into all lists whose
centroids are within a distance ratio of its nearest one.  That ratio is
measured: it is the one that finds ``RECALL`` of the nearest neighbours
inside the sample, so data without clusters costs more, not recall.

Largest inner product is turned into smallest distance by one more
component that gives all indexed vectors the same norm.

Equal vectors are one entry: all have the same score for any query, so of
their ids only the smallest ``k + 1`` can be in a result.  Lists are dealt
to shards of bounded size, and a long list to several, so no list is one
task's work.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinity.llm.common import cut, hash_sample, prepare, stable

K = 20
QUERY_EVERY = 20
SAMPLE = 40_000            # vectors of the sample; half of them are clustered, the others are the test
LIST_ROWS = 160            # entries aimed at per list
FIT_ROWS = 8               # clustered vectors per list at least, so lists are bounded by the sample
REPLICAS = 4               # lists a border vector goes to at most
REPLICA_RATIO = 1.03       # of its distance to the nearest list
RECALL = 0.95              # aimed at on the test half of the sample
CALIBRATION = 400          # sample vectors used as queries for that
DEGREE, BEAM, ENTRIES = 24, 64, 64
SHARD = 8_192              # entries of one unit of search
QUERY_BLOCK = 2_048        # queries of one unit of search
WORK_BYTES = 64 << 20      # of vectors gathered at a time
SEED = 7


@dataclass
class Lists:
    """Centroids with their graph; ``extra`` is the squared norm all indexed
    vectors get."""

    centroids: np.ndarray
    neighbours: np.ndarray
    entry: np.ndarray
    extra: float

    def lift(self, x: np.ndarray) -> np.ndarray:
        """Vectors to be indexed, with the component that evens out norms."""
        rest = np.sqrt(np.maximum(0.0, self.extra - (x * x).sum(axis=1)))
        return np.column_stack([x, rest]).astype(np.float32)

    def lift_queries(self, x: np.ndarray) -> np.ndarray:
        """Queries as directions: scaled to the norm of the indexed vectors,
        which changes no order of inner products."""
        norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
        return np.column_stack([x * (math.sqrt(self.extra) / np.maximum(norm, 1e-300)), np.zeros(len(x))]).astype(np.float32)

    def nearest(self, x: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
        """(lists, distances), nearest first, of up to ``beam`` lists per row
        (-1 where there are fewer): best-first search along the graph, for
        all rows at once."""
        c = self.centroids
        norms = (c * c).sum(axis=1)
        own = (x * x).sum(axis=1)
        if beam >= len(c):                        # all of them
            d = np.maximum(norms - 2 * x @ c.T + own[:, None], 0.0)
            order = np.argsort(d, axis=1, kind="stable")
            return order, np.sqrt(np.take_along_axis(d, order, 1))
        width = max(4, beam // 8)
        most = max(1, WORK_BYTES // (width * max(1, self.neighbours.shape[1]) * c.shape[1] * 4))
        if len(x) > most:                         # fewer rows at a time
            parts = [self.nearest(x[i:i + most], beam) for i in range(0, len(x), most)]
            return tuple(np.concatenate(p) for p in zip(*parts))
        rows = np.arange(len(x))[:, None]

        def distance(ids):
            d = norms[ids] - 2 * np.einsum("ijk,ik->ij", c[ids], x) + own[:, None]
            return np.maximum(d, 0.0)
        seen = np.zeros((len(x), len(c)), dtype=bool)
        found = np.broadcast_to(self.entry, (len(x), len(self.entry))).copy()
        seen[rows, found] = True
        near = distance(found)
        done = np.zeros(found.shape, dtype=bool)
        while True:
            order = np.argsort(near, axis=1, kind="stable")[:, :beam]
            found, near, done = (np.take_along_axis(a, order, 1) for a in (found, near, done))
            step = np.argsort(done * 1e9 + near, axis=1, kind="stable")[:, :width]     # the nearest not yet expanded
            open_ = ~np.take_along_axis(done, step, 1) & np.isfinite(np.take_along_axis(near, step, 1))
            if not open_.any():
                break
            np.put_along_axis(done, step, True, 1)
            more = self.neighbours[np.take_along_axis(found, step, 1)].reshape(len(x), -1)
            more = np.sort(np.where(np.repeat(open_, self.neighbours.shape[1], axis=1), more, -1), axis=1)
            new = (more >= 0) & ~seen[rows, np.maximum(more, 0)]
            new[:, 1:] &= more[:, 1:] != more[:, :-1]
            ids = np.maximum(more, 0)
            seen[rows, ids] |= new
            d = np.where(new, distance(ids), np.inf)
            found = np.concatenate([found, ids], axis=1)
            near = np.concatenate([near, d], axis=1)
            done = np.concatenate([done, ~new], axis=1)
        return np.where(np.isfinite(near), found, -1), np.sqrt(near)

    def homes(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lists of each lifted vector, nearest first, and which of them it
        goes to: the nearest, and others within the ratio that are not
        nearer to one already taken than to the vector."""
        c = self.centroids
        ids, d = self.nearest(x, min(len(c), 4 * REPLICAS))
        take = (ids >= 0) & (d <= np.maximum(d[:, :1] * REPLICA_RATIO, 1e-12))
        take[:, REPLICAS:] = False
        for j in range(1, min(REPLICAS, ids.shape[1])):
            for i in range(j):
                gap = np.sqrt(((c[ids[:, j]] - c[ids[:, i]]) ** 2).sum(axis=1))
                take[:, j] &= ~(take[:, i] & (gap < d[:, j] * 0.5))
        take[:, 0] = True
        return ids, take

    def within(self, x: np.ndarray, ratio: float, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
        """Lists of each lifted query, nearest first, and their distances:
        all that are within ``ratio`` of the nearest, and some more.  Where
        ``beam`` lists are not enough, more are looked for."""
        while True:
            beam = len(self.centroids) if 2 * beam >= len(self.centroids) else beam
            ids, d = self.nearest(x, beam)
            if beam >= len(self.centroids) or (d[:, -1] > ratio * d[:, 0]).all():
                return ids, d
            beam *= 4


def calibrated_ratio(lists: Lists, x: np.ndarray, total: int, k: int) -> tuple[float, int]:
    """(ratio, lists a query usually has within it): the distance ratio within
    which queries find RECALL of their nearest neighbours, measured inside
    the sample ``x``, of which no vector was clustered: the neighbours of a
    sampled query there are as far as its nearest k among all ``total``
    vectors."""
    if len(x) < 3 or len(lists.centroids) < 2:
        return math.inf, len(lists.centroids)
    near = max(1, min(len(x) - 1, round(k * len(x) / total)))
    asked = np.arange(0, len(x), max(1, len(x) // CALIBRATION))
    score = x[asked] @ x.T
    score[np.arange(len(asked)), asked] = -np.inf
    best = np.argpartition(-score, near - 1, axis=1)[:, :near]
    q = lists.lift_queries(x[asked])
    c = lists.centroids
    d = np.sqrt(np.maximum((c * c).sum(axis=1) - 2 * q @ c.T + (q * q).sum(axis=1)[:, None], 0.0))
    ids, take = lists.homes(lists.lift(x[best.ravel()]))
    owner = np.repeat(np.arange(len(asked)), near)[:, None]
    to = np.where(take, d[owner, np.maximum(ids, 0)], np.inf).min(axis=1)
    needed = to / np.maximum(d.min(axis=1)[owner[:, 0]], 1e-12)
    ratio = float(np.quantile(needed, RECALL)) * (1 + 1e-6)
    return ratio, int(np.quantile((d <= ratio * d.min(axis=1)[:, None]).sum(axis=1), 0.9))


def _means(x: np.ndarray, k: int, rng, rounds: int = 8) -> np.ndarray:
    """Index of the cluster of each row (Lloyd's rounds)."""
    c = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        own = ((c * c).sum(axis=1) - 2 * x @ c.T).argmin(axis=1)
        count = np.bincount(own, minlength=k)
        sums = np.zeros((k, x.shape[1]))
        np.add.at(sums, own, x)
        c = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], c).astype(np.float32)
    return own


def balanced_centroids(x: np.ndarray, lists: int, seed: int = SEED) -> np.ndarray:
    """Split the largest cluster in up to eight until there are ``lists``."""
    rng = np.random.default_rng(seed)
    heap = [(-len(x), 0, np.arange(len(x)))]
    whole: list[np.ndarray] = []
    number = 1
    while heap and len(heap) + len(whole) < lists:
        size, _, members = heapq.heappop(heap)
        k = min(8, lists - len(heap) - len(whole), -size)
        own = _means(x[members], k, rng) if k > 1 else np.zeros(len(members), dtype=int)
        parts = [members[own == i] for i in range(k)]
        parts = [p for p in parts if len(p)]
        if len(parts) < 2:
            whole.append(members)                   # equal vectors cannot be split
            continue
        for p in parts:
            heapq.heappush(heap, (-len(p), number, p))
            number += 1
    groups = whole + [m for _, _, m in heap]
    return np.array([x[m].mean(axis=0) for m in groups], dtype=np.float32).reshape(len(groups), x.shape[1])


def build_lists(x: np.ndarray, lists: int, extra: float, seed: int = SEED) -> Lists:
    """Cluster a sample and link each centroid to its nearest ones."""
    out = Lists(np.zeros((0, 0), np.float32), np.zeros((0, 0), np.int64), np.zeros(0, np.int64), extra)
    c = balanced_centroids(out.lift(x), max(1, lists), seed)
    degree = min(DEGREE, len(c))
    norms = (c * c).sum(axis=1)
    links = np.zeros((len(c), degree), dtype=np.int64)
    for lo in range(0, len(c), 1024):
        d = norms - 2 * c[lo:lo + 1024] @ c.T
        links[lo:lo + 1024] = np.argpartition(d, degree - 1, axis=1)[:, :degree]
    rng = np.random.default_rng(seed)
    entry = np.sort(rng.choice(len(c), min(ENTRIES, len(c)), replace=False))
    return Lists(c, links, entry, extra)


def _matrix(column) -> np.ndarray:
    """Rows of a list column of one length as a matrix of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def usable(vectors: DataFrame, vec: str) -> DataFrame:
    """Rows (row, vec_id, v) whose vector takes part: not null, not empty, all
    components finite, not all zero, and of the length most rows have."""
    v = F.col("v")
    d = stable(vectors).select(F.monotonically_increasing_id().alias("row"), "vec_id", F.col(vec).cast("array<double>").alias("v"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    d = d.filter(F.col("vec_id").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0))
    lengths = d.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    # -0.0 and 0.0 are the same component
    return d.filter(F.size("v") == (lengths[0].n if lengths else 0)).withColumn("v", F.transform(v, lambda x: x + F.lit(0.0)))


def build_index(rows: DataFrame, k: int = K):
    """Entries, list sizes, lists, (probe ratio, beam) and postings of usable rows."""
    spark = rows.sparkSession
    first = Window.partitionBy("v").orderBy("vec_id", "row")
    # the limit is applied map-side before the exchange, so a vector that a third of the rows have stays small
    least = rows.withColumn("_r", F.row_number().over(first)).filter(F.col("_r") <= k + 1)
    entries = least.groupBy("v").agg(F.sort_array(F.collect_list(F.struct("vec_id", "row"))).alias("members"))
    entries = cut(entries.select(F.col("members")[0]["row"].alias("entry"), "v", "members"))
    total, extra = entries.agg(F.count(F.lit(1)), F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))).first()
    if not total:
        return entries, None, None, None, None
    sample = hash_sample(entries, "entry", SAMPLE, SEED).select("v").toArrow()
    x = _matrix(sample.column("v"))
    # rows come in the order of a hash, so every other one is a random half
    fit, test = x[::2], x[1::2] if len(x) >= 64 else x
    lists = build_lists(fit, min(-(-total // LIST_ROWS), max(1, len(fit) // FIT_ROWS)), float(extra))
    ratio, usual = calibrated_ratio(lists, test, total, k)
    probing = ratio, max(BEAM, usual + usual // 4)
    shared = spark.sparkContext.broadcast(lists)

    def assign(batches):
        index = shared.value
        for b in batches:
            ids, take = index.homes(index.lift(_matrix(b.column("v"))))
            at, col = np.nonzero(take)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[at, col].astype(np.int32)), pa.array(col == 0), *[b.column(n).take(pa.array(at))
                                                                              for n in ("entry", "v", "members")]],
                names=["list", "main", "entry", "v", "members"])
    postings = cut(entries.select("entry", "v", "members").mapInArrow(
        assign, "list int, main boolean, entry long, v array<double>, members array<struct<vec_id:bigint,row:bigint>>"))
    sizes = postings.groupBy("list").agg(F.count(F.lit(1)).alias("n"), F.count_if("main").alias("main"))
    return entries, sizes.toArrow(), lists, probing, postings


def _best(score: np.ndarray, k: int) -> np.ndarray:
    """Mask of each row's k best, with all that come within rounding of them."""
    if score.shape[1] <= k:
        return np.ones(score.shape, dtype=bool)
    least = -np.partition(-score, k - 1, axis=1)[:, k - 1:k]
    return score >= least - 1e-9 * np.maximum(1.0, np.abs(least))


def search(vectors: DataFrame, queries, k: int = K, vec: str = "embedding") -> DataFrame:
    """The ``k`` rows of largest inner product with each query row:
    query_id, rank, vec_id, score.  ``queries`` is a condition on vec_id.

    Rows without id, and vectors that are null, empty, zero, of another
    length than most, or that hold null or non-finite components take no
    part, neither as query nor as candidate.  A query's own row is no
    candidate; another row of the same id or vector is.  Ties go to the
    smaller vec_id, then to the row that is scanned first.  Empty table: no
    rows."""
    spark = vectors.sparkSession
    parts = prepare(spark)
    rows = usable(vectors, vec)
    entries, sizes, lists, probing, postings = build_index(rows, k)
    schema = "query_id long, rank int, vec_id long, score double"
    if postings is None:
        return spark.createDataFrame([], schema)
    n_lists = len(lists.centroids)
    n, main = np.zeros(n_lists, np.int64), np.zeros(n_lists, np.int64)
    n[sizes.column("list").to_numpy()] = sizes.column("n").to_numpy()
    main[sizes.column("list").to_numpy()] = sizes.column("main").to_numpy()
    # blocks of each list, and the shard of each block: neighbouring blocks fill a shard
    blocks = np.maximum(1, -(-n // SHARD))
    first = np.cumsum(blocks) - blocks
    rows_of = np.repeat(n / blocks, blocks)
    shard = (np.cumsum(rows_of) - rows_of) // SHARD
    asked = rows.filter(queries).select("row", "vec_id", "v")
    # one search per distinct query vector
    wanted = cut(entries.select("entry", "v").join(asked.select("v").distinct(), "v", "left_semi").select("entry", "v"))
    shared = spark.sparkContext.broadcast((lists, probing, main, blocks, first, shard.astype(np.int32)))

    def probe(batches):
        index, (ratio, beam), main, blocks, first, shard = shared.value
        for b in batches:
            ids, d = index.within(index.lift_queries(_matrix(b.column("v"))), ratio, beam)
            some = ids >= 0
            before = np.where(some, main[np.maximum(ids, 0)], 0).cumsum(axis=1)
            enough = np.concatenate([np.zeros((len(ids), 1), bool), before[:, :-1] > 2 * (k + 1)], axis=1)
            at, col = np.nonzero(some & ((d <= d[:, :1] * ratio) | ~enough))
            chosen = ids[at, col]
            each = blocks[chosen]
            at, chosen = np.repeat(at, each), np.repeat(chosen, each)
            block = np.arange(len(at)) - np.repeat(np.cumsum(each) - each, each)
            to = shard[first[chosen] + block]
            order = np.lexsort((chosen, to, at))
            at, chosen, to = at[order], chosen[order], to[order]
            new = np.flatnonzero(np.append(True, (at[1:] != at[:-1]) | (to[1:] != to[:-1]))) if len(at) else at
            lists_of = pa.ListArray.from_arrays(pa.array(np.append(new, len(at)).astype(np.int32)),
                                                pa.array(chosen.astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(to[new]), lists_of, *[b.column(c).take(pa.array(at[new])) for c in ("entry", "v")]],
                names=["shard", "lists", "entry", "v"])
    probes = cut(wanted.repartition(parts).mapInArrow(probe, "shard int, lists array<int>, entry long, v array<double>"))
    # queries of one shard in blocks too
    q_blocks = probes.groupBy("shard").agg((F.floor((F.count(F.lit(1)) - 1) / QUERY_BLOCK) + 1).cast("int").alias("qb"))
    probes = probes.join(q_blocks, "shard").withColumn("qblock", F.pmod(F.xxhash64("entry"), F.col("qb")).cast("int"))
    places = spark.createDataFrame(
        [(i, int(blocks[i]), shard[first[i]:first[i] + blocks[i]].astype(int).tolist()) for i in range(n_lists)],
        "list int, blocks int, shards array<int>")
    # lists are bounded by the sample, so their table is broadcast
    spread = postings.join(F.broadcast(places), "list").withColumn(
        "shard", F.get("shards", F.pmod(F.xxhash64("entry"), F.col("blocks")).cast("int"))).join(q_blocks, "shard")
    spread = spread.withColumn("qblock", F.explode(F.sequence(F.lit(0), F.col("qb") - 1)))
    keys = ["shard", "qblock"]
    out = "q long, entry long, score double, members array<struct<vec_id:bigint,row:bigint>>"

    def compare(key, p, q):
        names = ["q", "entry", "score", "members"]
        member_type = pa.list_(pa.struct([("vec_id", pa.int64()), ("row", pa.int64())]))
        if not p.num_rows or not q.num_rows:
            return pa.table([pa.array([], t) for t in (pa.int64(), pa.int64(), pa.float64(), member_type)], names=names)
        x, y = _matrix(p.column("v")), _matrix(q.column("v"))
        entry, home = p.column("entry").to_numpy(), p.column("list").to_numpy()
        by_list = np.argsort(home, kind="stable")
        edges = np.flatnonzero(np.append(True, home[by_list][1:] != home[by_list][:-1]))
        wants = q.column("lists").combine_chunks()
        asked_by = np.repeat(np.arange(q.num_rows), np.diff(wants.offsets.to_numpy()))
        asked_for = wants.flatten().to_numpy()
        found = []
        for lo, hi in zip(edges, np.append(edges[1:], len(home))):
            members = by_list[lo:hi]
            who = asked_by[asked_for == home[members[0]]]
            if len(who):
                score = y[who] @ x[members].T
                at, col = np.nonzero(_best(score, k + 1))
                found.append((who[at], members[col], score[at, col]))
        if not found:
            return pa.table([pa.array([], t) for t in (pa.int64(), pa.int64(), pa.float64(), member_type)], names=names)
        at, col, score = (np.concatenate(z) for z in zip(*found))
        # each query's best of all these lists; an entry may be in REPLICAS of them
        order = np.lexsort((-score, at))
        at, col, score = at[order], col[order], score[order]
        start = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        size = np.diff(np.append(start, len(at)))
        last = np.repeat(score[start + np.minimum(size, REPLICAS * (k + 1)) - 1], size)
        keep = score >= last - 1e-9 * np.maximum(1.0, np.abs(last))
        at, col = at[keep], col[keep]
        # row by row, so equal vectors have equal scores
        step = max(1, WORK_BYTES // (8 * x.shape[1]))
        exact = np.concatenate([(y[at[i:i + step]] * x[col[i:i + step]]).sum(axis=1) for i in range(0, len(at), step)])
        # once per query and entry, then each query's best of the whole shard, ties included
        order = np.lexsort((entry[col], -exact, at))
        at, col, exact = at[order], col[order], exact[order]
        new = np.append(True, (at[1:] != at[:-1]) | (entry[col[1:]] != entry[col[:-1]]))
        at, col, exact = at[new], col[new], exact[new]
        start = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        size = np.diff(np.append(start, len(at)))
        last = np.repeat(exact[start + np.minimum(size, k + 1) - 1], size)
        keep = exact >= last
        at, col, exact = at[keep], col[keep], exact[keep]
        pick = pa.array(col)
        return pa.table([q.column("entry").take(pa.array(at)), p.column("entry").take(pick), pa.array(exact),
                         p.column("members").take(pick).cast(member_type)], names=names)
    found = spread.select(*keys, "list", "entry", "v", "members").groupBy(*keys).cogroup(
        probes.select(*keys, "lists", "entry", "v").groupBy(*keys)).applyInArrow(compare, out)
    order = [F.col("score").desc(), F.col("vec_id"), F.col("row")]
    best = Window.partitionBy("q").orderBy(*order)
    # the same entry may come from lists of several shards; of an entry's members only the first k + 1 count
    top = found.groupBy("q", "entry").agg(F.max("score").alias("score"), F.first("members").alias("members"))
    top = top.select("q", "score", F.explode("members").alias("m")).select("q", "score", "m.vec_id", "m.row")
    top = top.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= k + 1)
    # back to the query rows, each without itself
    ids = entries.select(F.col("entry").alias("q"), F.col("v").alias("_v"))
    each = asked.join(ids, F.col("v") == F.col("_v")).select(F.col("row").alias("_row"), F.col("vec_id").alias("query_id"), "q")
    j = each.join(top, "q").filter("row != _row")
    mine = Window.partitionBy("_row").orderBy(*order)
    return j.withColumn("rank", F.row_number().over(mine)).filter(F.col("rank") <= k).select(
        F.col("query_id").cast("long"), "rank", F.col("vec_id").cast("long"), "score")


def nearest_neighbours(embeddings: DataFrame) -> DataFrame:
    """Every 20th vector against all rows."""
    return search(embeddings, F.col("vec_id") % QUERY_EVERY == 0)
