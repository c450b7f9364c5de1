import numpy as np
import pytest
from conftest import SF01

from affinity.llm import voronoi

E = "vec_id long, embedding array<float>"


def brute(ids, x, every=100, k=10):
    """(query_id, rank, vec_id, score) by all inner products, in integers."""
    whole = [[int(np.floor(1024 * np.float64(np.float32(a)))) for a in v] for v in x]
    out = []
    for i, q in enumerate(whole):
        if ids[i] % every == 0:
            s = sorted((-sum(a * b for a, b in zip(q, v)), ids[j], j) for j, v in enumerate(whole) if j != i)[:k]
            out += [(ids[i], rank, v, -score) for rank, (score, v, _) in enumerate(s, 1)]
    return sorted(out)


def got(df):
    assert df.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    return sorted(map(tuple, df.collect()))


def test_whole_table(spark):
    e = spark.read.parquet(f"{SF01}/embeddings.parquet")
    rows = e.collect()
    assert got(voronoi.top_k(e)) == brute([r.vec_id for r in rows], [r.embedding for r in rows])


@pytest.mark.parametrize("spread", [0.02, 0.3, 5.0])
def test_lengths_clusters_copies_and_ties(spark, spread, monkeypatch):
    """Vectors of very different lengths, in clusters, with copies; many
    blocks and slices give the same rows."""
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(12, 6))
    x = centres[rng.integers(0, 12, 900)] + rng.normal(size=(900, 6)) * spread
    x *= rng.uniform(0.1, 6, size=(900, 1))
    x[300:600] = x[5]
    x[700] = 0.0
    x = x.astype(np.float32)
    ids = [int(i) for i in rng.permutation(900)]
    d = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, x)], E).selectExpr("*", "1 AS row", "2 AS v", "3 AS grp", "4 AS slice")
    want = brute(ids, x)
    assert got(voronoi.top_k(d)) == want
    for name, value in (("QUERY_BLOCK", 3), ("SLICE_ROWS", 40), ("SLICE_LEAST", 20), ("SCORE_CELLS", 100), ("SAMPLE_VALUES", 600)):
        monkeypatch.setattr(voronoi, name, value)
    assert got(voronoi.top_k(d)) == want


def test_rows_that_take_no_part(spark):
    rows = [(0, [1.0, 2.0]), (100, [3.0, -1.0]), (1, [0.5, 0.5]), (1, [0.5, 0.5]), (200, [0.0, 0.0]), (0, [1.0, 2.0])]
    odd = [(300, None), (400, []), (500, [1.0, None]), (600, [float("nan"), 1.0]), (700, [float("inf"), 1.0]),
           (800, [1.0]), (None, [1.0, 1.0])]
    assert got(voronoi.top_k(spark.createDataFrame(rows + odd, E))) == brute([r[0] for r in rows], [r[1] for r in rows])


def test_small_and_empty_tables(spark):
    d = spark.createDataFrame([(100, [1.0]), (7, [2.0])], E)
    assert got(voronoi.top_k(d)) == [(100, 1, 7, 2048 * 1024)]
    assert got(voronoi.top_k(d.limit(1))) == []
    assert got(voronoi.top_k(d.limit(0))) == []
    assert got(voronoi.top_k(d.filter("vec_id = 7"))) == []


def test_products_beyond_doubles(spark):
    """Scores past 2**53 stay exact; past 64 bits they stand at the end."""
    rows = [(0, [2.0 ** 20, 1.0]), (1, [2.0 ** 20 + 1, 3.0]), (2, [2.0 ** 20 + 1, 2.0]), (3, [2.0 ** 20 + 1, 5.0]), (4, [2.0 ** 40, 0.0])]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    big = 1024 * 1024
    assert got(voronoi.top_k(d)) == [(0, 1, 4, 2 ** 63 - 1)] + [
        (0, 2 + i, v, big * (2 ** 20 * (2 ** 20 + 1) + n)) for i, (v, n) in enumerate(((3, 5), (1, 3), (2, 2)))]


def test_rings_leave_out_far_cells():
    """Of clusters far apart, a group of queries needs its own only, and
    groups with the same needs share one copy."""
    rng = np.random.default_rng(3)
    centres = np.eye(8) * 1000
    x = np.floor(np.repeat(centres, 200, axis=0) + rng.normal(size=(1600, 8)) * 5)
    rng.shuffle(x)
    space = voronoi.Space(x[:400], 16, float(((np.abs(x) + 1) ** 2).sum(axis=1).max()))
    d = space.of_candidates(x)
    cell = d.argmin(axis=1)
    dist = d[np.arange(len(x)), cell]
    q = x[:40]
    reach = space.bound(q, 10)[:, None]
    of = space.of_queries(q)
    home = of.argmin(axis=1)
    p = len(space.pivots)
    lo, hi, n = np.full((p, p), np.inf), np.full((p, p), -np.inf), np.zeros(p, int)
    for c in range(p):
        if (home == c).any():
            lo[c], hi[c], n[c] = (of - reach)[home == c].min(axis=0), (of + reach)[home == c].max(axis=0), (home == c).sum()
    width = 2 * space.square ** 0.5 / voronoi.BINS
    held = np.zeros((p, voronoi.BINS))
    np.add.at(held, (cell, np.minimum(dist / width, voronoi.BINS - 1).astype(int)), 1)
    groups = voronoi.plan_groups(lo, hi, n, held, width)
    sent = sum(((dist >= g["lo"][cell]) & (dist <= g["hi"][cell])).sum() for g in groups)
    assert sorted(c for g in groups for c in g["cells"]) == np.flatnonzero(n).tolist()
    assert sent < 2 * len(x) < len(groups) * len(x)
