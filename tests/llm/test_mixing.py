import re
from collections import defaultdict

import pytest
from conftest import SF001
from llm_cases import DOCS, ODD, with_clashes

from affinity.llm import mixing


def targets(rows, weights=(1, 2, 3), most=3):
    size = defaultdict(int)
    for r in rows:
        size[r[3]] += len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    names = sorted(size, key=lambda s: (s is None, [ord(c) for c in s or ""]))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out, free, left = {}, set(names), sum(size.values())
    while free:
        unit = left / sum(w[s] for s in free)
        full = {s for s in free if most * size[s] <= unit * w[s]}
        if not full:
            out.update({s: unit * w[s] for s in free})
            break
        for s in full:
            out[s] = float(most * size[s])
            left -= most * size[s]
        free -= full
    return size, out


def check(rows, got):
    size, target = targets(rows)
    assert len(got) == len(rows)
    taken, largest = defaultdict(int), defaultdict(int)
    by_id = defaultdict(list)
    for r in rows:
        by_id[r[0]].append((r[3], len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))))
    for g in got:
        same = [s for s, n in by_id[g["doc_id"]] if n == g["size"] and size[s] == g["source_size"]]
        assert same
        s = same[0]
        assert g["target"] == pytest.approx(target[s])
        assert g["taken"] in {g["size"] * i for i in range(4)}
        taken[g["source_size"], round(g["target"], 6)] += g["taken"]
        largest[g["source_size"], round(g["target"], 6)] = max(largest[g["source_size"], round(g["target"], 6)], g["size"])
    return size, target, taken, largest


def test_mixture_reaches_targets(spark):
    d = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = [tuple(r) for r in d.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    got = mixing.mix_sources(d).collect()
    size, target, taken, largest = check(rows, got)
    assert sum(g["taken"] for g in got) <= sum(size.values()) + 0.5
    for (source_size, t), n in taken.items():
        same = sum(1 for s in size if size[s] == source_size and round(target[s], 6) == t)
        assert abs(n - same * t) <= same * 2 * max(largest.values())
    again = mixing.mix_sources(d.repartition(3)).collect()
    assert sorted((g["doc_id"], g["taken"]) for g in got) == sorted((g["doc_id"], g["taken"]) for g in again)


def test_odd_rows(spark):
    d = spark.createDataFrame(ODD, DOCS)
    check(ODD, mixing.mix_sources(with_clashes(d)).collect())
    assert mixing.mix_sources(d.limit(0)).count() == 0
    out = mixing.mixed_documents(with_clashes(d))
    assert out.columns == with_clashes(d).columns
    assert out.count() >= 1


def test_buckets_do_not_change_the_order(spark, monkeypatch):
    d = spark.read.parquet(f"{SF001}/documents.parquet")
    one = sorted((g["doc_id"], g["taken"]) for g in mixing.mix_sources(d).collect())
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 5)
    assert one == sorted((g["doc_id"], g["taken"]) for g in mixing.mix_sources(d).collect())


def test_sequence_is_fair_queueing(spark):
    """The rows taken, and their order, against a plain queue: sources advance
    by size over target, each in the order of its shuffle."""
    from pyspark.sql import functions as F
    docs = [(i, "w " * (1 + i * 7 % 11), "en", [None, "a", "b", "c"][min(3, i % 7)], 0) for i in range(120)]
    docs += [(5, "w " * 3, "en", "a", 0), (200, None, "en", "b", 0), (201, "", "en", "lone", 0)]
    d = spark.createDataFrame(docs, DOCS)
    sizes = mixing.document_sizes(mixing.stable(d))
    t = {r.source: r for r in mixing.source_targets(sizes).collect()}
    seq = [(r.row, r.epoch, r.position) for r in mixing.mixture(sizes, mixing.source_targets(sizes)).orderBy("position", "row").collect() if r["size"]]
    shuffled = sizes.withColumn("h", F.shiftrightunsigned(F.xxhash64(F.lit(mixing.SEED), "doc_id"), 1)).collect()
    _, target = targets(docs)
    queue = []
    for s in target:
        mine = sorted((r for r in shuffled if r.source == s), key=lambda r: (r.h, r.doc_id, r.row))
        total = sum(r["size"] for r in mine)
        assert t[s].target == pytest.approx(target[s])
        for epoch in range(1, 4) if total else ():
            done = 0
            for r in mine:
                done += r["size"]
                queue.append((((epoch - 1) * total + done) / t[s].target, t[s].source_rank, r.h, r.row, epoch, r["size"]))
    want, at, budget = [], 0, sum(target.values())
    for finish, _, _, row, epoch, size in sorted(queue):
        at += size
        if at > budget + 0.5:
            break
        if size:
            want.append((row, epoch, at))
    assert seq == want and len(want) > 100
