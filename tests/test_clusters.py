import random

import pytest

from affinity.operators import clusters as K

SCHEMA = "unit long, a double, b double, extra string"


def blobs(seed=1, n=90):
    rnd = random.Random(seed)
    at = [(0, 0), (10, 100), (0, 100), (10, 0)]
    return [(i, at[i % 4][0] + rnd.gauss(0, 0.5), at[i % 4][1] + rnd.gauss(0, 5), "x") for i in range(n)]


def scaled(rows):
    cols = list(zip(*[(a, b) for _, a, b, _ in rows]))
    ends = [(min(c), max(c)) for c in cols]
    return {r[0]: tuple((v - lo) / (hi - lo) if hi > lo else 0.0 for v, (lo, hi) in zip(r[1:3], ends)) for r in rows}


def dist(p, q):
    return sum((x - y) * (x - y) for x, y in zip(p, q))


def mean(ps):
    return tuple(sum(c) / len(ps) for c in zip(*ps))


def lloyd(points, centres):
    for _ in range(K.MAX_ITER):
        home = {u: min(range(len(centres)), key=lambda i: (dist(p, centres[i]), i)) for u, p in points.items()}
        new = [mean([points[u] for u in points if home[u] == i]) if i in home.values() else c for i, c in enumerate(centres)]
        if new == centres:
            break
        centres = new
    return {u: min(range(len(centres)), key=lambda i: (dist(p, centres[i]), i)) for u, p in points.items()}, centres


def farthest(points, centres):
    return points[min(points, key=lambda u: (-min(dist(points[u], c) for c in centres), u))]


@pytest.mark.parametrize("k", [1, 3, 4, 7])
def test_k_means_against_plain_loops(spark, k):
    rows = blobs()
    points = scaled(rows)
    centres = [farthest(points, [mean(list(points.values()))])]
    while len(centres) < k:
        centres.append(farthest(points, centres))
    home, centres = lloyd(points, centres)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    model = K.k_means(df, ["a", "b"], k)
    assert {r.unit: r.cluster for r in model.assign(df, "unit").collect()} == home
    table = {r.cluster: r for r in model.table(df, "unit").collect()}
    for i, c in enumerate(centres):
        mine = [points[u] for u in points if home[u] == i]
        assert table[i].n == len(mine) and table[i].cost == pytest.approx(sum(dist(p, c) for p in mine))
    if k == 4:
        assert len({(u % 4, c) for u, c in home.items()}) == 4      # the blobs


def test_fewer_rows_than_clusters_ties_and_nulls(spark):
    rows = [(1, 1.0, 1.0, ""), (2, 1.0, 1.0, ""), (3, 2.0, 1.0, ""), (4, None, 1.0, ""), (5, float("nan"), 1.0, ""), (None, 2.0, 2.0, "")]
    df = spark.createDataFrame(rows, SCHEMA)
    model = K.k_means(df, ["a", "b"], 5)
    got = {r.unit: r.cluster for r in model.assign(df, "unit").collect()}
    assert len(model.centres) == 2 and got[1] == got[2] != got[3] and set(got) == {1, 2, 3}
    assert {r.b for r in model.table(df, "unit").collect()} == {1.0}
    same = spark.createDataFrame([(i, 3.0, 3.0, "") for i in range(4)], SCHEMA)
    assert {r.cluster for r in K.k_means(same, ["a", "b"], 3).assign(same, "unit").collect()} == {0}
    none = K.k_means(df.limit(0), ["a", "b"], 3)
    assert none.assign(df, "unit").count() == 0 and none.table(df, "unit").count() == 0


def test_bisecting_against_plain_loops(spark):
    rows = blobs(5, 60)
    points = scaled(rows)
    parts = {1: list(points)}

    def cost(us):
        c = mean([points[u] for u in us])
        return sum(dist(points[u], c) for u in us)
    while len(parts) < 5:
        node = min(parts, key=lambda n: (-cost(parts[n]), n))
        mine = {u: points[u] for u in parts.pop(node)}
        first = farthest(mine, [mean(list(mine.values()))])
        home, _ = lloyd(mine, [first, farthest(mine, [first])])
        for side in (0, 1):
            parts[2 * node + side] = [u for u in mine if home[u] == side]
    df = spark.createDataFrame(rows, SCHEMA)
    model = K.bisecting_k_means(df, ["a", "b"], 5)
    assert {r.unit: r.node for r in model.assign(df, "unit").collect()} == {u: n for n, us in parts.items() for u in us}
    table = {r.node: r for r in model.table(spark).collect()}
    assert {n for n, r in table.items() if r.leaf} == set(parts) and len(table) == 9
    assert all(table[n].n == len(us) and table[n].cost == pytest.approx(cost(us)) for n, us in parts.items())
    assert table[1].parent is None and table[3].parent == 1


def test_bisecting_stops_at_equal_rows(spark):
    rows = [(i, float(i % 2), 0.0, "") for i in range(8)]
    model = K.bisecting_k_means(spark.createDataFrame(rows, SCHEMA), ["a", "b"], 6)
    assert sorted(p.node for p in model.parts.values()) == [1, 2, 3]
    assert not K.bisecting_k_means(spark.createDataFrame([], SCHEMA), ["a", "b"], 2).parts
