import hashlib
import zlib

import pytest
from conftest import SF001
from llm_cases import DOCS, ODD, with_clashes

from affinity.llm import merkle


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(level):
    levels = [level]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([digest(*below[i:i + 16]) for i in range(0, len(below), 16)])
    return levels


def way(levels, at):
    out = []
    for level in levels[:-1]:
        lo = at // 16 * 16
        out.append(("".join(level[lo:at]), "".join(level[at + 1:lo + 16])))
        at //= 16
    return out


def brute(rows):
    """The manifest of (doc_id, source, lang, n_chars, text) by plain recursion."""
    def leaf(row, text):
        return digest(*map(field, row[:4]), field(text))

    def lower(text):
        return text and "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    names = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    members = {s: sorted((r for r in rows if r[1] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4]))) for s in names}
    trees = {s: tree([leaf(r, r[4]) for r in members[s]]) for s in names}
    top = tree([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for i, r in enumerate(members[s]):
            path = way(trees[s], i) + way(top, k)
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            x = leaf(r, lower(r[4])) if bad else trees[s][0][i]
            for left, right in path:
                x = digest(left, x, right)
            out.append((r[0], trees[s][0][i], trees[s][-1][0], top[-1][0], digest(*(a + b for a, b in path)), x, x == top[-1][0]))
    return sorted(out, key=str)


def check(spark, rows):
    d = spark.createDataFrame([(i, t, lang, s, n) for i, s, lang, n, t in rows], DOCS)
    got = merkle.merkle_manifest(with_clashes(d))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


@pytest.mark.parametrize("sizes", [(1,), (1, 1), (16, 17, 1), (256, 257, 15), (4097, 3), (2,) * 18])
def test_trees_of_any_size(spark, sizes):
    """Single leaves, full and short runs, one and several storeys."""
    check(spark, [(i * 7 % 5003, f"s{k}", "en", i, f"Text {i} É") for k, n in enumerate(sizes) for i in range(n)])


def test_many_sources(spark):
    """More sources than a block holds."""
    check(spark, [(i, f"s{i % 300}", None, i, "A" if i % 2 else "a") for i in range(700)])


def test_odd_rows(spark):
    check(spark, [(i, s, lang, n, t) for i, t, lang, s, n in ODD] + [(9005, "s1", "", 1, "Tie"), (9005, "s1", "", 1, "Tie"), (7, "é", "x", None, "")])


def test_whole_table_and_empty_table(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    assert sorted(map(tuple, merkle.merkle_manifest(docs).collect()), key=str) == brute(rows)
    assert merkle.merkle_manifest(docs.limit(0)).count() == 0


def test_no_python_and_no_join_of_leaves(spark):
    """Ranks are joined by partition, blocks by block; no other join."""
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    plan = merkle.merkle_manifest(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_any_change_of_a_text_is_found(spark):
    rows = [(i, "s", "en", 1, "ABC" if i % 3 else "abc") for i in range(100)]
    got = merkle.merkle_manifest(spark.createDataFrame([(i, t, lang, s, n) for i, s, lang, n, t in rows], DOCS)).collect()
    for r in got:
        tampered = zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and r.doc_id % 3
        assert r.verified == (not tampered)
