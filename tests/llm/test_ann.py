import numpy as np
from conftest import SF01

from affinity.llm import ann

E = "vec_id long, embedding array<float>"


def exact(ids, x, q, k=20):
    s = np.array([float((x[q] * v).sum()) for v in x])
    keep = np.arange(len(x)) != q
    o = np.lexsort((ids, -s))
    o = o[keep[o]][:k]
    return [(int(ids[i]), s[i]) for i in o]


def results(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return {q: sorted(v) for q, v in out.items()}


def test_recall_and_scores(spark):
    e = spark.read.parquet(f"{SF01}/embeddings.parquet")
    rows = e.collect()
    ids = np.array([r.vec_id for r in rows])
    x = np.array([r.embedding for r in rows], dtype=float)
    got = results(ann.nearest_neighbours(e))
    hit = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        want = exact(ids, x, q)
        mine = got[ids[q]]
        assert [r for r, _, _ in mine] == list(range(1, 21))
        assert all(abs(s - float((x[q] * x[np.flatnonzero(ids == v)[0]]).sum())) < 1e-12 for _, v, s in mine)
        hit += sum(s >= want[-1][1] - 1e-12 for _, _, s in mine)
        total += len(want)
    assert hit / total >= 0.9


def test_lengths_copies_and_unusable_vectors(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 8)) * rng.uniform(0.2, 4, size=(300, 1))
    rows = [(int(i), [float(np.float32(a)) for a in v]) for i, v in enumerate(x)]
    rows += [(1000 + i, rows[3][1]) for i in range(60)] + [(40, rows[40][1])]
    good = list(rows)
    rows += [(400, None), (420, []), (440, [0.0] * 8), (460, [1.0] * 7 + [None]), (480, [float("nan")] * 8),
             (500, [float("inf")] * 8), (520, [1.0] * 5), (None, [1.0] * 8)]
    d = spark.createDataFrame(rows, E).selectExpr("*", "1 AS row", "2 AS v", "3 AS entry", "4 AS list")
    ids = np.array([r[0] for r in good])
    m = np.array([r[1] for r in good])
    out = ann.nearest_neighbours(d).collect()
    got, hit, total = {}, 0, 0
    for r in out:
        got.setdefault(r.query_id, []).append(r)
    queries = [i for i in range(len(good)) if ids[i] % 20 == 0]
    assert set(got) == {int(ids[i]) for i in queries} and len(out) == 20 * len(queries)
    for q in queries:
        if ids[q] == 40:
            continue                                             # its repeat is told apart only by the row
        want = exact(ids, m, q)
        mine = [(r.vec_id, r.score) for r in sorted(got[int(ids[q])], key=lambda r: r["rank"])]
        hit += sum(s >= want[-1][1] - 1e-9 for _, s in mine)
        total += 20
        if ids[q] == 1000 or ids[q] == 1020:
            # ties go to the smaller id, and the own row is left out
            same = [v for v, s in mine if abs(s - mine[0][1]) < 1e-12 and v >= 1000]
            assert same == sorted(same) and int(ids[q]) not in same
    assert hit / total >= 0.9
    # a repeated row has its twin as a neighbour
    assert sum(r.vec_id == 40 for r in got[40]) == 2


def test_small_and_empty_tables(spark):
    rows = [(i, [float(i + 1), 1.0]) for i in range(7)]
    d = spark.createDataFrame(rows, E)
    got = results(ann.nearest_neighbours(d))
    assert {q: [v for _, v, _ in r] for q, r in got.items()} == {0: [6, 5, 4, 3, 2, 1]}
    assert ann.nearest_neighbours(d.limit(0)).count() == 0
    assert ann.nearest_neighbours(d.limit(1)).count() == 0


def test_shards_and_blocks_do_not_change_the_result(spark, monkeypatch):
    e = spark.read.parquet(f"{SF01}/embeddings.parquet")
    want = results(ann.nearest_neighbours(e))
    for shard, block in ((16, 7), (100, 4096)):
        monkeypatch.setattr(ann, "SHARD", shard)
        monkeypatch.setattr(ann, "QUERY_BLOCK", block)
        assert want == results(ann.nearest_neighbours(e))


def test_ratio_is_measured():
    """Vectors without clusters need a wide ratio, clustered ones a narrow one,
    and either finds its neighbours."""
    rng = np.random.default_rng(9)
    flat = rng.normal(size=(3000, 16))
    tight = rng.normal(size=(60, 16))[rng.integers(0, 60, 3000)] * 3 + rng.normal(size=(3000, 16)) * 0.1
    shares = []
    for x in (flat, tight):
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
        lists = ann.build_lists(x, 60, float((x * x).sum(axis=1).max()))
        ratio, usual = ann.calibrated_ratio(lists, x, len(x), 20)
        asked = np.arange(1, 3000, 50)
        ids, d = lists.within(lists.lift_queries(x[asked]), ratio, usual)
        chosen = [set(i[(i >= 0) & (r <= ratio * r[0])].tolist()) for i, r in zip(ids, d)]
        home, take = lists.homes(lists.lift(x))
        score = x[asked] @ x.T
        score[np.arange(len(asked)), asked] = -9
        best = np.argsort(-score, axis=1)[:, :20]
        hit = np.mean([any(h in c for h in home[j][take[j]]) for c, b in zip(chosen, best) for j in b])
        assert hit > 0.93
        shares.append(np.mean([len(c) for c in chosen]) / len(lists.centroids))
    assert shares[1] < shares[0] / 2


def test_graph_finds_the_nearest_centroids():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(4000, 12))
    lists = ann.build_lists(x, 300, float((x * x).sum(axis=1).max()))
    q = lists.lift(x[:200])
    ids, _ = lists.nearest(q, 64)
    exact = ((lists.centroids[None] - q[:, None]) ** 2).sum(axis=2).argmin(axis=1)
    assert np.mean(ids[:, 0] == exact) > 0.95
