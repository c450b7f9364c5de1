import random

import pytest

from affinity.operators.tree import LEAST_GAIN, DecisionTree

SCHEMA = "id long, x0 double, x1 double, c double, y double"


def purity(n, n1):
    return (n1 * n1 + (n - n1) ** 2) / n


def grow(rows, cats, depth, least, bins):
    """Plain recursion over lists: (node, n, n1, feature, rule) of every node."""
    out = []

    def at(node, part, d):
        n, n1 = len(part), sum(y for _, y in part)
        best = None
        for f in range(len(part[0][0])):
            lo, hi = min(x[f] for x, _ in part), max(x[f] for x, _ in part)
            if lo == hi or n1 in (0, n) or d == depth:
                continue

            def bin_of(v):
                return v if f in cats else min(bins - 1, float(int((v - lo) / (hi - lo) * bins)))
            held = {}
            for x, y in part:
                held.setdefault(bin_of(x[f]), []).append((x[f], y))
            order = sorted(held, key=lambda b: (sum(y for _, y in held[b]) / len(held[b]) if f in cats else 0, b))
            for k in range(1, len(order)):
                left = [y for b in order[:k] for _, y in held[b]]
                if min(len(left), n - len(left)) < least:
                    continue
                score = purity(len(left), sum(left)) + purity(n - len(left), n1 - sum(left))
                rule = sorted(order[:k]) if f in cats else max(v for v, _ in held[order[k - 1]])
                if score > purity(n, n1) * (1 + LEAST_GAIN) and (best is None or score > best[0]):
                    best = (score, f, rule)
        out.append((node, n, n1, None if best is None else best[1], None if best is None else best[2]))
        if best:
            _, f, rule = best
            goes = [(x[f] in rule) if f in cats else x[f] <= rule for x, _ in part]
            at(2 * node, [r for r, g in zip(part, goes) if g], d + 1)
            at(2 * node + 1, [r for r, g in zip(part, goes) if not g], d + 1)
    at(1, rows, 0)
    return sorted(out)


def data(seed, n=400):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        x0, x1, c = rnd.gauss(0, 3), float(rnd.randrange(6)), float(rnd.randrange(5))
        p = 0.9 if (x0 > 1) != (c in (1.0, 4.0)) else 0.15
        rows.append((i, x0, x1, c, float(rnd.random() < p)))
    return rows


@pytest.mark.parametrize("seed,depth,least", [(1, 4, 2), (2, 3, 25), (3, 6, 1)])
def test_tree_is_the_one_of_plain_recursion(spark, seed, depth, least):
    rows = data(seed)
    model = DecisionTree(["x0", "x1", "c"], "y", ("c",), depth, least, 16).fit(spark.createDataFrame(rows, SCHEMA))
    got = sorted((t.node, t.n, t.n1, None if t.feature is None else ["x0", "x1", "c"].index(t.feature),
                  sorted(t.categories) if t.categories is not None else t.threshold) for t in model.nodes.values())
    assert got == grow([((a, b, c), int(y)) for _, a, b, c, y in rows], {2}, depth, least, 16)
    assert len(got) > 5


def test_children_hold_their_parents_rows(spark):
    df = spark.createDataFrame(data(7), SCHEMA)
    model = DecisionTree(["x0", "x1", "c"], "y", ("c",)).fit(df)
    for t in model.nodes.values():
        if t.feature is not None:
            a, b = model.nodes[2 * t.node], model.nodes[2 * t.node + 1]
            assert (a.n + b.n, a.n1 + b.n1) == (t.n, t.n1)
    counts = {r.leaf: r["count"] for r in df.groupBy(model.node_of().alias("leaf")).count().collect()}
    assert counts == {t.node: t.n for t in model.nodes.values() if t.feature is None}


def test_nulls_ties_and_single_classes(spark):
    rows = data(9, 60) + [(900, None, 1.0, 1.0, 1.0), (901, float("nan"), 1.0, 1.0, 0.0), (902, 1.0, 1.0, 1.0, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    model = DecisionTree(["x0", "x1", "c"], "y", ("c",)).fit(df)
    assert model.nodes[1].n == 60
    assert model.transform(df).count() == 61                   # a label is not needed to predict
    one = DecisionTree(["x0"], "y").fit(df.where("y = 1"))
    assert list(one.nodes) == [1] and {r.prediction for r in one.transform(df).collect()} == {1.0}
    tie = DecisionTree(["x0"], "y").fit(spark.createDataFrame([(1, 1.0, 0.0, 0.0, 1.0), (2, 1.0, 0.0, 0.0, 0.0)], SCHEMA))
    assert tie.nodes[1].feature is None and {r.prediction for r in tie.transform(df).collect()} == {0.0}
    none = DecisionTree(["x0"], "y").fit(df.limit(0))
    assert not none.nodes and none.transform(df).first().prediction == 0.0 and none.table(spark).count() == 0


def test_first_feature_wins_a_tie(spark):
    rows = [(i, float(i), float(i), 0.0, float(i > 4)) for i in range(10)]
    t = DecisionTree(["x1", "x0"], "y").fit(spark.createDataFrame(rows, SCHEMA)).nodes[1]
    assert (t.feature, t.threshold) == ("x1", 4.0)
