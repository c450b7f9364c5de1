import functools
import random
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from affinity.operators import communities as C
from affinity.operators import sidebyside as S

EDGES = "u1 long, u2 long, w long"


def frame(spark, edges):
    return spark.createDataFrame(edges, EDGES)


def greedy(edges, units, k):
    """One merger at a time, always the closest pair: the tree's heights and
    the groups when ``k`` are left (or no edge joins any two)."""
    total = Counter()
    for a, b, w in edges:
        if a != b and w is not None:
            total[min(a, b), max(a, b)] += w
    total = {p: w for p, w in total.items() if w > 0}
    groups = {u: {u} for u in units | {u for p in total for u in p}}
    heights, left = [], None
    while True:
        if len(groups) <= k and left is None:
            left = {u: g for g, members in groups.items() for u in members}
        if not total:
            break
        pair = min(total, key=lambda p: (-(total[p] / (len(groups[p[0]]) * len(groups[p[1]]))), *p))
        heights.append(total[pair] / (len(groups[pair[0]]) * len(groups[pair[1]])))
        a, b = pair
        groups[a] |= groups.pop(b)
        new = Counter()
        for (x, y), w in total.items():
            x, y = (a if x == b else x), (a if y == b else y)
            if x != y:
                new[min(x, y), max(x, y)] += w
        total = dict(new)
    return heights, left or {u: g for g, members in groups.items() for u in members}


@pytest.mark.parametrize("seed,density", [(1, 0.9), (2, 0.25), (3, 0.1)])
def test_rounds_give_the_tree_of_single_mergers(spark, seed, density):
    """Random scores without ties: any k gives the groups of the greedy order."""
    rnd = random.Random(seed)
    n = 24
    edges = [(a, b, rnd.randrange(1, 10 ** 9)) for a, b in combinations(range(n), 2) if rnd.random() < density]
    edges += [(b, a, rnd.randrange(1, 10 ** 9)) for a, b, _ in edges[::3]]
    tree = C.merge_tree(frame(spark, edges))
    rows = tree.collect()
    assert sorted(round(r.height, 3) for r in rows) == sorted(round(h, 3) for h in greedy(edges, set(range(n)), 1)[0])
    assert len({r.b for r in rows}) == len(rows) and all(r.a < r.b for r in rows)
    units = spark.range(n).toDF("unit")
    for k in (1, 3, 8, n):
        got = {r.unit: r.community for r in C.cut_tree(units, tree, k).collect()}
        assert got == greedy(edges, set(range(n)), k)[1]


def test_ties_go_by_ids_and_never_block(spark):
    """All scores equal: every pair ties, the smallest ids merge first."""
    edges = [(a, b, 5) for a, b in combinations(range(1, 8), 2)]
    rows = sorted((r.round, r.a, r.b, r.na, r.nb, r.height) for r in C.merge_tree(frame(spark, edges)).collect())
    assert rows[0] == (0, 1, 2, 1, 1, 5.0) and len(rows) == 6 and {r[5] for r in rows} == {5.0}
    got = C.communities(frame(spark, edges), spark.range(1, 8).toDF("unit"), 3).collect()
    assert len({r.community for r in got}) == 3
    # a ring of equal scores: each would choose the next one without one order for all
    ring = [(i, (i + 1) % 6, 7) for i in range(6)]
    assert len(C.merge_tree(frame(spark, ring)).collect()) == 5


def test_missing_edges_count_as_zero(spark):
    """1-2 close, 3 tied to 1 only: the merger of 1 and 2 halves it."""
    edges = [(1, 2, 100), (1, 3, 60), (3, 4, 50)]
    rows = sorted((r.a, r.b, r.height) for r in C.merge_tree(frame(spark, edges)).collect())
    assert rows == [(1, 2, 100.0), (1, 3, 15.0), (3, 4, 50.0)]


def test_parts_without_edges_stay_apart(spark):
    edges = [(1, 2, 5), (3, 4, 6), (9, 9, 7), (5, 6, 0), (7, 8, None)]
    units = spark.createDataFrame([(1,), (2,), (10,), (None,)], "unit long")
    got = {r.unit: r.community for r in C.communities(frame(spark, edges), units, 1).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 3, 10: 10}
    assert C.communities(frame(spark, []), units, 2).count() == 3
    assert C.merge_tree(frame(spark, [])).count() == 0


def test_blocks_are_found(spark):
    rnd = random.Random(5)
    home = {u: u % 4 for u in range(40)}
    edges = [(a, b, rnd.randrange(600, 900) if home[a] == home[b] else rnd.randrange(1, 200)) for a, b in combinations(range(40), 2)]
    found = C.communities(frame(spark, edges), spark.range(40).toDF("unit"), 4)
    known = spark.createDataFrame([(u, f"g{g}") for u, g in home.items()], "unit long, grp string")
    r = C.agreement(C.contingency(found, known)).first()
    assert (r.n_units, r.n_left, r.n_right, r.rand_index, r.adjusted_rand) == (40, 4, 4, 1.0, 1.0)


def brute_agreement(rows):
    same_both = same_left = same_right = agree = 0
    for (a, x), (b, y) in combinations(rows, 2):
        same_left += a == b
        same_right += x == y
        same_both += a == b and x == y
        agree += (a == b) == (x == y)
    n = len(rows) * (len(rows) - 1) // 2
    chance = same_left * same_right / n
    return same_both, same_left, same_right, agree / n, (same_both - chance) / ((same_left + same_right) / 2 - chance)


def test_agreement_against_all_pairs(spark):
    rnd = random.Random(11)
    rows = [(rnd.randrange(5), rnd.choice(["a", "b", None, "c"])) for _ in range(60)]
    found = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(rows)] + [(99, 1)], "unit long, community long")
    known = spark.createDataFrame([(i, g) for i, (_, g) in enumerate(rows)] + [(98, "a")], "unit long, grp string")
    r = C.agreement(C.contingency(found, known)).first()
    assert r.n_units == 60 and r.n_right == 4
    got = (r.same_both, r.same_left, r.same_right, r.rand_index, r.adjusted_rand)
    assert got == pytest.approx(brute_agreement(rows))


def test_agreement_of_trivial_and_empty_groupings(spark):
    one = spark.createDataFrame([(1, 1, "a")], "unit long, community long, grp string")
    r = C.agreement(C.contingency(one, one)).first()
    assert (r.n_units, r.rand_index, r.adjusted_rand) == (1, None, None)
    r = C.agreement(C.contingency(one.limit(0), one)).first()
    assert (r.n_units, r.n_left, r.same_both, r.adjusted_rand) == (0, 0, 0, None)


@pytest.mark.parametrize("seed,density,scores", [(2, 0.3, 5), (3, 0.1, 2)])
def test_parts_in_one_task_give_the_rounds_of_jobs(spark, seed, density, scores):
    """With many ties, parts of several sizes and any bound on a task's edges."""
    rnd = random.Random(seed)
    edges = [(a, b, rnd.randrange(1, scores)) for a, b in combinations(range(14), 2) if rnd.random() < density]
    edges += [(100 + a, 100 + b, 1) for a, b in combinations(range(5), 2)] + [(200 + 2 * i, 201 + 2 * i, 3) for i in range(9)]
    e = frame(spark, edges)
    by_jobs = sorted(C.merge_tree(e, local_edges=0).collect())
    for bound in (10, 10 ** 6):
        assert sorted(C.merge_tree(e, local_edges=bound).collect()) == by_jobs


def test_small_parts_need_no_round_of_jobs(spark, monkeypatch):
    """Parts of a chain of mergers, each below the bound, together above it."""
    def refuse(e):
        raise AssertionError("a round of jobs")
    monkeypatch.setattr(C, "mutual_choices", refuse)
    chain = [(100 * p + i, 100 * p + i + 1, 10 + i) for p in range(4) for i in range(12)]
    assert C.merge_tree(frame(spark, chain), local_edges=12).count() == 48


def test_text_ids_in_one_task(spark):
    e = spark.createDataFrame([("b", "a", 5), ("é", "z", 5), ("a", "z", 1)], "u1 string, u2 string, w long")
    assert sorted(C.merge_tree(e).collect()) == sorted(C.merge_tree(e, local_edges=0).collect())


def test_layers_of_changed_edges_give_the_rounds_of_one_task(spark, monkeypatch):
    """Rounds that write changed edges only, with ties, against local rounds;
    parts are looked for once, however many rounds a large part takes."""
    rnd = random.Random(5)
    edges = [(a, b, rnd.randrange(1, 4)) for a, b in combinations(range(9), 2) if rnd.random() < 0.5]
    edges += [(100 + a, 101 + a, 50 + a) for a in range(3)]
    e, layers, looked = frame(spark, edges), [], []
    in_one_task = sorted(C.merge_tree(e).collect())
    add, parts = C.Layers.add, C.parts
    monkeypatch.setattr(C.Layers, "add", lambda self, *a: (layers.append(1), add(self, *a))[1])
    monkeypatch.setattr(C, "parts", lambda *a: (looked.append(1), parts(*a))[1])
    assert sorted(C.merge_tree(e, local_edges=4, layer_share=1).collect()) == in_one_task
    assert layers and len(looked) == 1


def refuse(*_):
    raise AssertionError("a round of jobs")


@pytest.mark.parametrize("seed,density,scores,text", [(1, 0.4, 10 ** 9, False), (3, 0.5, 2, True)])
def test_tasks_side_by_side_give_the_rounds_of_one_task(spark, monkeypatch, seed, density, scores, text):
    """A large part goes on in barrier stages, not in rounds of jobs."""
    rnd = random.Random(seed)
    ids = [f"u{i}" if text else 7 * i for i in range(26)]
    edges = [(ids[a], ids[b], rnd.randrange(1, scores)) for a, b in combinations(range(26), 2) if rnd.random() < density]
    e = spark.createDataFrame(edges, "u1 string, u2 string, w long" if text else EDGES)
    in_one_task = sorted(C.merge_tree(e).collect())
    stages, together = [], S.together
    monkeypatch.setattr(C, "mutual_choices", refuse)
    monkeypatch.setattr(S, "TASK_ENTRIES", 60)
    monkeypatch.setattr(S, "ALONE_ENTRIES", 40)
    monkeypatch.setattr(C, "partial", lambda f, **given: (stages.append(f is together), functools.partial(f, **given))[1])
    assert sorted(C.merge_tree(e, local_edges=4, side_edges=0).collect()) == in_one_task
    assert any(stages)


def test_side_by_side_after_rounds_of_jobs(spark, monkeypatch):
    """Edges beyond the tasks' memory take rounds of jobs until they fit; then
    communities have sizes above one."""
    rnd = random.Random(4)
    edges = [(a, b, rnd.randrange(1, 50)) for a, b in combinations(range(16), 2)]
    e, rounds = frame(spark, edges), []
    in_one_task = sorted(C.merge_tree(e).collect())
    choices = C.mutual_choices
    monkeypatch.setattr(C, "mutual_choices", lambda e: (rounds.append(1), choices(e))[1])
    monkeypatch.setattr(C, "barrier_slots", lambda _: 2)
    monkeypatch.setattr(S, "MOST_ENTRIES", 40)
    monkeypatch.setattr(S, "TASK_ENTRIES", 20)
    monkeypatch.setattr(S, "ALONE_ENTRIES", 10)
    assert sorted(C.merge_tree(e, local_edges=1, side_edges=0).collect()) == in_one_task
    assert 0 < len(rounds) <= max(r.round for r in in_one_task)


@pytest.mark.parametrize("told", [1, 60, S.TOLD])
def test_stages_of_any_length_give_the_rounds(monkeypatch, told):
    """However many entries end a stage, also many parts and ties at once."""
    monkeypatch.setattr(S, "TOLD", told)
    rnd = random.Random(told)
    pairs = [(a, b) for a, b in combinations(range(70), 2) if a // 40 == b // 40 and rnd.random() < 0.3]
    a, b = np.array(pairs).T
    total, one = np.array([rnd.randrange(1, 6) for _ in pairs]), np.ones(len(pairs), dtype=np.int64)
    edges = pa.table({k: pa.chunked_array([v]) for k, v in (("a", a), ("b", b), ("total", total), ("na", one), ("nb", one))})
    nodes = np.unique(np.concatenate([a, b]))
    x, c, t = (np.concatenate(v) for v in ((a, b, nodes), (b, a, nodes), (total, total, np.ones(len(nodes), dtype=np.int64))))
    rows = pa.record_batch([x << 32 | c, t], names=["key", "total"])
    columns = ["round", "a", "b", "na", "nb", "height"]
    got = pa.Table.from_batches(list(S.alone([rows], 70, 0))).select(columns).to_pylist()
    assert sorted(map(str, got)) == sorted(map(str, C.local_rounds(edges, 0).to_pylist()))
