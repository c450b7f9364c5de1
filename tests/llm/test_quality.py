import zlib

import numpy as np
import pytest
from conftest import SF01
from llm_cases import DOCS, ODD, with_clashes

from affinity.llm import quality


def test_held_out_accuracy(spark):
    got = {r.doc_id: r for r in quality.quality_query(spark, SF01).collect()}
    labels = spark.read.parquet(f"{SF01}/labels.parquet").collect()
    held = [(r.quality, got[r.doc_id]) for r in labels if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(held) > 50 and all(g.held_out for _, g in held)
    assert all(0 <= g.score <= 1 and g.predicted == int(g.score >= 0.3) for g in got.values())
    assert np.mean([q == g.predicted for q, g in held]) > 0.95


def test_scores_do_not_depend_on_ids_or_partitions(spark):
    d = spark.read.parquet(f"{SF01}/documents.parquet")
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    one = {r.doc_id: r.score for r in quality.score_documents(d, labels).collect()}
    two = {r.doc_id: r.score for r in quality.score_documents(d.repartition(3), labels).collect()}
    assert one == two


def test_odd_rows(spark):
    d = spark.createDataFrame(ODD, DOCS)
    labels = spark.createDataFrame([(9001, 1, 0), (9003, 0, 0), (9003, 0, 0), (9005, None, 0), (77, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    got = quality.score_documents(with_clashes(d), labels).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out is False for r in got if r.doc_id is None)
    assert quality.score_documents(d.limit(0), labels).count() == 0
    assert {r.score for r in quality.score_documents(d, labels.limit(0)).collect()} == {0.5}
    kept = quality.keep_good(with_clashes(d), labels.limit(0))
    assert kept.columns == with_clashes(d).columns and kept.count() == len(ODD)


def test_flat_trees_walk_like_nested_ones():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(2000, 6)).astype(np.float32)
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] * x[:, 3] > 0)).astype(float)
    model = quality.fit(x, y, trees=120)

    def walk(row):
        total = model.base
        for f, b, leaf in zip(model.feature, model.border, model.leaf):
            i = 0
            while i < len(f):
                i = 2 * i + (2 if row[f[i]] > b[i] else 1)
            total += leaf[i - len(f)]
        return 1 / (1 + np.exp(-total))
    s = model.score(x)
    assert s[:50] == pytest.approx([walk(r) for r in x[:50]])
    assert np.mean((s > 0.5) == y) > 0.93


def test_statistics_of_a_text(spark):
    d = spark.createDataFrame([(1, "Aa bb\nAa bb\n!!! ##")], "doc_id long, text string")
    x = dict(zip(quality.STATISTICS, quality.unpack([quality.statistics(d).first().stats])[0].tolist()))
    assert x["log_words"] == pytest.approx(np.log1p(6))
    assert x["distinct_words"] == pytest.approx(4 / 6)
    assert x["distinct_lines"] == pytest.approx(2 / 3)
    assert x["word_max"] == 3


def test_splits_are_the_best_of_all_borders():
    """Every split of the boosted trees against a search over all borders,
    by sums over the rows themselves."""
    rng = np.random.default_rng(11)
    x = rng.normal(size=(300, 4)).astype(np.float32)
    x[:, 3] = np.round(x[:, 3])                       # a statistic of few values
    y = ((x[:, 0] + 0.5 * x[:, 3] > 0.2) ^ (x[:, 1] > 0.8)).astype(float)
    depth, trees = 3, 5
    model = quality.fit(x, y, trees=trees, depth=depth)
    borders = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, quality.BINS + 1)[1:-1])).astype(np.float32) for j in range(4)]
    margin = np.full(len(x), model.base)
    split = 0
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)

        def part(mask):
            return g[mask].sum() ** 2 / (h[mask].sum() + quality.L2)
        node = np.zeros(len(x), dtype=int)
        for i in range(2 ** depth - 1):
            here = node == i
            best, at = 1e-6, None
            for j, edges in enumerate(borders):
                for b in edges:
                    left, right = here & (x[:, j] <= b), here & (x[:, j] > b)
                    if h[left].sum() >= quality.MIN_WEIGHT and h[right].sum() >= quality.MIN_WEIGHT:
                        gain = part(left) + part(right) - part(here)
                        if gain > best + 1e-9:
                            best, at = gain, (j, b)
            if at is None:
                assert model.border[t, i] == np.inf
            else:
                split += 1
                j, b = model.feature[t, i], model.border[t, i]
                assert part(here & (x[:, j] <= b)) + part(here & (x[:, j] > b)) - part(here) == pytest.approx(best)
            node[here] = 2 * i + 1 + (x[here, model.feature[t, i]] > model.border[t, i])
        for leaf in range(2 ** depth):
            mine = node == 2 ** depth - 1 + leaf
            assert model.leaf[t, leaf] == pytest.approx(-quality.RATE * g[mine].sum() / (h[mine].sum() + quality.L2), abs=1e-12)
        margin += model.leaf[t, node - (2 ** depth - 1)]
    assert split > 20
