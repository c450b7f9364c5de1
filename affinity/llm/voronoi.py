"""Exact top-k search by a Voronoi join.

Vectors of integers are ranked by inner product.  Every candidate gets one
more component that brings it to the length of the longest, every query a
zero there: then the largest inner product is the smallest Euclidean
distance, and triangle inequalities hold.

Queries and candidates are grouped by their nearest pivot.  Summaries give
bounds: per pivot a histogram of its candidates' distances, and for every
query an upper bound of its k-th distance (its k-th among the sample that
the pivots come from).  A candidate at distance d from its pivot can only be
among a query's best if d is within that bound of the query's own distance
from the pivot.  So a group of queries needs of each cell one ring of
distances, the hull of its queries' rings; candidates outside are not sent.
Cells of queries whose rings overlap for the most part share one copy of the
candidates.

A group's candidates are dealt into slices and its queries into blocks of
bounded size, so a task holds no more than one of each, and the best of all
slices are put together.  Distances only decide what is sent, with a margin
above their rounding; scores are exact integers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinity.llm.common import cut, hash_sample, prepare

K = 10
SCALE = 1024
PIVOTS = 256               # at most; their pairs are what the driver holds
SAMPLE_VALUES = 1 << 18    # components in the sample that pivots and first bounds come from
BINS = 64                  # of the histogram of distances
QUERY_BLOCK = 16384        # queries, and candidates, of one task at most (roughly: dealt by hash)
SLICE_ROWS = 16384
SLICE_LEAST = 512          # candidates that are not dealt out further
SHARED = 0.75              # groups are put together if one copy costs no more than this share of two
MARGIN = 1e-6              # of the longest vector: above the rounding of distances
SEED = 12
SCORE_CELLS = 1 << 22      # scores held at once
MOST = (1 << 63) - 1


def whole_vectors(vectors: DataFrame, vec: str, queries: Column) -> DataFrame:
    """Rows (row, vec_id, asked, v) that take part, kept; v holds 1024 * x,
    exact in doubles, and _matrix takes the floors, exact in doubles too."""
    v = F.transform(F.col(vec).cast("array<double>"), lambda x: x * F.lit(float(SCALE)))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    d = vectors.select(F.monotonically_increasing_id().alias("row"), "vec_id", v.alias("v"))
    d = d.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & finite)
    return cut(d.select("row", "vec_id", F.coalesce(queries, F.lit(False)).alias("asked"), "v"))


def _matrix(column) -> np.ndarray:
    """Rows of a list column of one length as a matrix of whole doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(flat).reshape(len(column), -1)


class Space:
    """Pivots, sample and the length that candidates are brought to."""

    def __init__(self, sample: np.ndarray, pivots: int, square: float):
        self.sample, self.square = sample, square
        self.pivots = np.unique(sample[:pivots], axis=0)
        self.lift = self._lift(self.pivots)

    def _lift(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0.0, self.square - (x * x).sum(axis=1)))

    def of_candidates(self, x: np.ndarray) -> np.ndarray:
        """Distances of candidates from the pivots."""
        inner = x @ self.pivots.T + np.outer(self._lift(x), self.lift)
        return np.sqrt(np.maximum(0.0, 2 * (self.square - inner)))

    def of_queries(self, q: np.ndarray, to: np.ndarray | None = None) -> np.ndarray:
        """Distances of queries from the pivots, or from the candidates ``to``."""
        to = self.pivots if to is None else to
        return np.sqrt(np.maximum(0.0, (q * q).sum(axis=1)[:, None] + self.square - 2 * q @ to.T))

    def bound(self, q: np.ndarray, k: int) -> np.ndarray:
        """No query's k-th nearest other candidate is farther than this."""
        if len(self.sample) < k + 1:
            return np.full(len(q), np.inf)
        return np.partition(self.of_queries(q, self.sample), k, axis=1)[:, k]      # one may be the query's own row


def _assigned(rows: DataFrame, shared, width: float) -> DataFrame:
    """Candidates with the cell of their nearest pivot, their distance from
    it and its bin, kept."""
    def run(batches):
        for b in batches:
            d = shared.value.of_candidates(_matrix(b.column("v")))
            cell = d.argmin(axis=1) if d.size else np.zeros(0, np.int64)
            dist = d[np.arange(len(d)), cell]
            bins = np.minimum(dist / width, BINS - 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in ("row", "vec_id", "asked")], pa.array(cell.astype(np.int32)), pa.array(dist),
                 pa.array(bins), b.column("v")], names=["row", "vec_id", "asked", "cell", "dist", "bin", "v"])
    return cut(rows.mapInArrow(run, "row long, vec_id long, asked boolean, cell int, dist double, bin int, v array<double>"))


def _asked(rows: DataFrame, shared, k: int) -> DataFrame:
    """Queries with the cell of their nearest pivot and their ring around
    every pivot: qcell, lo, hi (arrays by pivot)."""
    def run(batches):
        for b in batches:
            space, q = shared.value, _matrix(b.column("v"))
            for at in range(0, len(q), 256):
                d = space.of_queries(q[at:at + 256])
                reach = space.bound(q[at:at + 256], k)[:, None]
                n, p = d.shape
                ends = pa.array((np.arange(n + 1) * p).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(d.argmin(axis=1).astype(np.int32)), *[pa.ListArray.from_arrays(ends, pa.array(x.ravel()))
                                                                    for x in (d - reach, d + reach)]],
                    names=["qcell", "lo", "hi"])
    return rows.filter("asked").select("v").mapInArrow(run, "qcell int, lo array<double>, hi array<double>")


def plan_groups(lo: np.ndarray, hi: np.ndarray, asked: np.ndarray, held: np.ndarray, width: float) -> list[list[int]]:
    """Put cells of queries together.  lo, hi (cells x pivots) are rings,
    asked the queries of each cell, held (pivots x bins) the candidates.
    Cells join the group that saves most, if one copy of the candidates for
    both is clearly less than two and the group stays within a block."""
    before = np.concatenate([np.zeros((len(held), 1)), held.cumsum(axis=1)], axis=1)
    pivots = np.arange(len(held))

    def needed(a, b):
        first = np.clip(np.floor(a / width), 0, BINS).astype(int)
        last = np.where(b < 0, 0, np.clip(np.floor(np.minimum(b, 1e300) / width) + 1, 0, BINS)).astype(int)
        return np.maximum(0, before[pivots, last] - before[pivots, np.minimum(first, BINS)]).sum(axis=-1)
    groups: list[dict] = []
    for c in np.argsort(-asked, kind="stable"):
        if not asked[c]:
            continue
        own = needed(lo[c], hi[c])
        best, saved = None, 0.0
        for g in groups:
            if g["asked"] + asked[c] > QUERY_BLOCK:
                continue
            both = needed(np.minimum(g["lo"], lo[c]), np.maximum(g["hi"], hi[c]))
            if both <= SHARED * (g["rows"] + own) and g["rows"] + own - both > saved:
                best, saved = (g, both), g["rows"] + own - both
        if best is None:
            groups.append({"cells": [int(c)], "lo": lo[c], "hi": hi[c], "asked": asked[c], "rows": own})
        else:
            g, both = best
            g.update(cells=g["cells"] + [int(c)], lo=np.minimum(g["lo"], lo[c]), hi=np.maximum(g["hi"], hi[c]),
                     asked=g["asked"] + asked[c], rows=both)
    return groups


def exact_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of whole vectors, exact.  Doubles hold them if no sum
    can pass 2**53, else integers without bound are used, and a product that
    passes 64 bits stands at their end."""
    most = np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * max(1, q.shape[1])
    if most < 2 ** 53:
        return (q @ x.T).astype(np.int64)
    whole = [[int(a) for a in r] for r in q], [[int(a) for a in r] for r in x]
    s = np.array(whole[0], dtype=object) @ np.array(whole[1], dtype=object).T
    return np.clip(s, -MOST - 1, MOST).astype(np.int64)


def best_of(q: np.ndarray, own: np.ndarray, x: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int):
    """(query, candidate, score) of each query's k best among candidates
    other than its own row; ties to the smaller id, then row."""
    order = np.lexsort((rows, ids))
    x, rows = x[order], rows[order]
    by_row = np.argsort(rows)
    out = []
    for at in range(0, len(q), max(1, SCORE_CELLS // max(1, len(x)))):
        part = slice(at, at + max(1, SCORE_CELLS // max(1, len(x))))
        s = exact_scores(q[part], x)
        at_own = np.searchsorted(rows[by_row], own[part])
        at_own = by_row[np.minimum(at_own, len(rows) - 1)]
        mine = rows[at_own] == own[part]
        open_ = np.ones(s.shape, dtype=bool)
        open_[np.flatnonzero(mine), at_own[mine]] = False
        low = np.where(open_, s, np.iinfo(np.int64).min)
        if s.shape[1] > k:
            least = np.partition(low, s.shape[1] - k, axis=1)[:, s.shape[1] - k:s.shape[1] - k + 1]
            open_ &= s >= least
        i, j = np.nonzero(open_)
        o = np.lexsort((j, -s[i, j].astype(np.float64), i)) if np.abs(s).max(initial=0) < 2 ** 53 else np.array(
            sorted(range(len(i)), key=lambda z: (i[z], -int(s[i[z], j[z]]), j[z])), dtype=np.int64)
        i, j = i[o], j[o]
        place = np.arange(len(i)) - np.searchsorted(i, i)
        i, j = i[place < k], j[place < k]
        out.append((i + at, order[j], s[i, j]))
    return [np.concatenate(c) for c in zip(*out)]


def _solved(candidates: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Each query's best of each slice: (asker, query_id, row, vec_id, score)."""
    names = ["asker", "query_id", "row", "vec_id", "score"]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table([pa.array([], pa.int64())] * len(names), names=names)
        ids, rows = (right.column(c).to_numpy() for c in ("vec_id", "row"))
        asker, query = (left.column(c).to_numpy() for c in ("row", "vec_id"))
        i, j, s = best_of(_matrix(left.column("v")), asker, _matrix(right.column("v")), ids, rows, k)
        return pa.table([pa.array(a) for a in (asker[i], query[i], rows[j], ids[j], s)], names=names)
    keys = ["grp", "block", "slice"]
    return queries.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInArrow(run, ", ".join(f"{c} long" for c in names))


def search(vectors: DataFrame, queries: Column, k: int = K, vec: str = "embedding") -> DataFrame:
    """The ``k`` rows of largest inner product of floor(1024 * x) with each
    row that meets ``queries``: query_id, rank, vec_id, score.

    Rows without id and vectors that are null, empty, of another length than
    most, or that hold null or non-finite components (also after the scaling)
    take no part; zero vectors do.  A query's own row is no candidate; another
    row of the same id is.  Ties go to the smaller vec_id, then to the row
    scanned first.  A score beyond 64 bits stands at their end.  Empty table:
    no rows.  Other columns are not read."""
    spark = vectors.sparkSession
    parts = prepare(spark)
    rows = whole_vectors(vectors, vec, queries)
    lengths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    schema = "query_id long, rank int, vec_id long, score long"
    if not lengths:
        return spark.createDataFrame([], schema)
    length = lengths[0]["n"]
    rows = rows.filter(F.size("v") == length)
    norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + F.pow(F.abs(x) + 1, F.lit(2.0)))     # above that of the floors
    total, asked, square = rows.agg(F.count(F.lit(1)), F.count_if("asked"), F.max(norm)).first()
    if not asked:
        return spark.createDataFrame([], schema)
    sample = _matrix(hash_sample(rows, "row", max(64, SAMPLE_VALUES // length), SEED).select("v").toArrow().column("v"))
    pivots = int(min(PIVOTS, max(1, total ** 0.5 / 4)))
    space = Space(sample, pivots, float(square))
    longest = float(square) ** 0.5
    width = 2.0 * longest / BINS or 1.0
    shared = spark.sparkContext.broadcast(space)
    data = _assigned(rows, shared, width)

    # summaries, all bounded by the pivots: candidates by bin, rings by cell of queries
    p = len(space.pivots)
    held = np.zeros((p, BINS))
    for r in data.groupBy("cell", "bin").count().collect():
        held[r.cell, r.bin] = r["count"]
    asks = _asked(rows, shared, k)
    per_cell = asks.select("qcell", F.posexplode(F.arrays_zip("lo", "hi")).alias("cell", "ring")).groupBy("qcell", "cell").agg(
        F.min("ring.lo").alias("lo"), F.max("ring.hi").alias("hi"), F.count(F.lit(1)).alias("n"))
    lo, hi, n = np.full((p, p), np.inf), np.full((p, p), -np.inf), np.zeros(p, np.int64)
    for r in per_cell.collect():
        lo[r.qcell, r.cell], hi[r.qcell, r.cell], n[r.qcell] = r.lo, r.hi, r.n
    slack = MARGIN * longest
    groups = plan_groups(lo - slack, hi + slack, n, held, width)
    rings, homes = [], []
    for g, x in enumerate(groups):
        blocks = int(-(-x["asked"] // QUERY_BLOCK))
        wanted = max(1.0, float(x["rows"]))
        slices = int(max(-(-wanted // SLICE_ROWS), min(-(-parts // len(groups)), -(-wanted // SLICE_LEAST))))
        homes += [(c, g, blocks, slices) for c in x["cells"]]
        rings += [(j, g, blocks, slices, float(x["lo"][j]), float(x["hi"][j])) for j in range(p) if x["hi"][j] >= x["lo"][j]]
    rings = F.broadcast(spark.createDataFrame(rings, "cell int, grp int, blocks int, slices int, lo double, hi double"))
    homes = F.broadcast(spark.createDataFrame(homes, "qcell int, grp int, blocks int, slices int"))

    deal = F.xxhash64(F.lit(SEED), "row")
    needed = data.join(rings, "cell").filter("dist >= lo AND dist <= hi")
    needed = needed.select("grp", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
                           F.pmod(deal, F.col("slices")).cast("int").alias("slice"), "row", "vec_id", "v")
    out = _solved(needed, _dealt(rows, shared).join(homes, "qcell").select(
        "grp", F.pmod(deal, F.col("blocks")).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"), "row", "vec_id", "v"), k)
    first = Window.partitionBy("asker").orderBy(F.desc("score"), "vec_id", "row")
    out = out.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= k)
    return out.select("query_id", "rank", "vec_id", "score")


def _dealt(rows: DataFrame, shared) -> DataFrame:
    """Queries with the cell of their nearest pivot."""
    def run(batches):
        for b in batches:
            q = _matrix(b.column("v"))
            cell = shared.value.of_queries(q).argmin(axis=1) if len(q) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), *[b.column(c) for c in ("row", "vec_id", "v")]],
                                             names=["qcell", "row", "vec_id", "v"])
    return rows.filter("asked").select("row", "vec_id", "v").mapInArrow(run, "qcell int, row long, vec_id long, v array<double>")


def top_k(vectors: DataFrame) -> DataFrame:
    """Queries are the rows whose vec_id is divisible by 100; ten each."""
    return search(vectors, F.col("vec_id") % 100 == 0)
