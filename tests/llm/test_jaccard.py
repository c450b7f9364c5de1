import random
import re
import string
from collections import Counter, defaultdict

import numpy as np
from conftest import SF001
from llm_cases import DOCS, ODD, rows_of, with_clashes

from affinity.llm import jaccard
from affinity.llm.components import components

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def brute(rows, k=4, pct=85):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for j, n in Counter(j for g in s for j in holders[g]).items():
            if 100 * n >= pct * (len(s) + len(sets[j]) - n):
                root[find(i)] = find(j)
        for g in s:
            holders[g].append(i)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(s), least.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def families(seed, n=30):
    rng = random.Random(seed)
    rows = []
    for _ in range(6):
        base = [rng.choice(string.ascii_lowercase) for _ in range(rng.choice([60, 120, 200]))]
        for _ in range(n):
            w = base[:]
            for _ in range(rng.randrange(9)):
                w[rng.randrange(len(w))] = rng.choice("QRSTUVW")
            if rng.random() < 0.3:
                w = w[:int(len(w) * rng.uniform(0.7, 1))]
            rows.append((len(rows) * 7 % 997, " ".join(w)))
    return rows


def test_families_of_near_copies(spark):
    rows = families(2)
    rows += [(None, rows[3][1]), (None, "x y"), (2001, "X y"), (2002, None), (2003, " \n"), (2004, ""),
             (rows[9][0], rows[9][1]), (3000, "z")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    assert rows_of(jaccard.near_duplicates(d)) == want
    assert rows_of(jaccard.near_duplicates(d.repartition(5))) == want


def test_hubs_find_the_same_components(spark, monkeypatch):
    for seed, small, worth in ((3, 2, 0.1), (4, 1, 0.0), (5, 5, 0.9)):
        rows = families(seed, 25)
        d = spark.createDataFrame(rows, "doc_id long, text string")
        monkeypatch.setattr(jaccard, "SMALL", small)
        monkeypatch.setattr(jaccard, "WORTH", worth)
        assert rows_of(jaccard.near_duplicates(d)) == brute(rows), seed


def test_difference_prefixes_keep_every_link():
    """Nodes that link share a difference from the hub inside their prefixes."""
    rng = np.random.default_rng(6)
    seen = 0
    for _ in range(4000):
        hub = set(range(60))

        def near(k, base):
            s = set(base)
            for x in rng.choice(60, k, replace=False):
                s.discard(int(x))
            return s | {100 + int(x) for x in rng.choice(30, int(rng.integers(0, k + 1)), replace=False)}
        x = near(int(rng.integers(4, 10)), hub)
        y = near(int(rng.integers(1, 4)), x) if rng.random() < 0.5 else near(int(rng.integers(1, 10)), hub)

        def links(a, b):
            return 100 * len(a & b) >= 85 * len(a | b)
        if links(x, hub) or x == y or not links(x, y) or y == hub:
            continue
        seen += 1
        dx, dy = ([*sorted(s - hub), *sorted(hub - s)] for s in (x, y))
        short_x, long_x = jaccard.difference_prefixes(len(hub), len(x), len(dx), 85)
        short_y, _ = jaccard.difference_prefixes(len(hub), len(y), len(dy), 85)
        first = set(dx[:long_x]) if links(y, hub) else set(dx[:short_x])
        assert first & set(dy[:short_y])
    assert seen > 100


def test_whole_table(spark):
    d = spark.read.parquet(f"{SF001}/documents.parquet")
    assert rows_of(jaccard.near_duplicates(d)) == brute([(r.doc_id, r.text) for r in d.collect()])


def test_odd_rows_and_keepers(spark):
    d = spark.createDataFrame(ODD, DOCS)
    assert rows_of(jaccard.near_duplicates(with_clashes(d))) == brute([(r[0], r[1]) for r in ODD])
    kept = jaccard.keep_one(with_clashes(d))
    assert kept.columns == with_clashes(d).columns
    # the repeated rows are one group; texts without a word all stay
    assert kept.count() == len(ODD) - 1
    assert jaccard.near_duplicates(d.limit(0)).count() == 0
    assert jaccard.keep_one(d.limit(0)).count() == 0


def test_prefix_choice_keeps_every_link():
    """Prefixes of any two linked sets share as many shingles as the smaller L."""
    rng = np.random.default_rng(5)
    for _ in range(200):
        n = int(rng.integers(4, 60))
        a = np.sort(rng.choice(1000, n, replace=False)).astype(np.uint64)
        b = np.unique(np.concatenate([a[rng.random(n) > 0.06], rng.choice(1000, 2).astype(np.uint64)]))
        shared = len(np.intersect1d(a, b))
        if 100 * shared < 85 * (len(a) + len(b) - shared):
            continue
        cost = rng.random(1000).astype(np.float32) * 50
        pick = []
        for s in (a, b):
            o = np.lexsort((s, cost[s.astype(int)]))
            l, length = jaccard.prefix_choice(cost[s.astype(int)][o], len(s), 85)
            pick.append((l, set(s[o[:length]].tolist())))
        assert len(pick[0][1] & pick[1][1]) >= min(pick[0][0], pick[1][0])


def test_components(spark):
    links = [(i, i + 1) for i in range(10, 40)] + [(100, 90), (90, 95), (7, 7), (200, 100)]
    got = {r.node: r.comp for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[i] == 10 for i in range(10, 41))
    assert {got[i] for i in (90, 95, 100, 200)} == {90}
