import re
from collections import Counter

import pytest
from conftest import SF01
from llm_cases import DOCS, ODD, with_clashes

from affinity.llm import rules


def base(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    g = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    n = Counter(g)
    covered = {j for i, x in enumerate(g) if n[x] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered),
            len(w) < 50 or 100 * len(covered) > 50 * len(w))


def check(rows, got):
    assert sorted(str((i, *base(t))) for i, t in rows) == sorted(
        str((g.doc_id, g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words, g.base_failed)) for g in got)
    assert not any(g.kept and g.base_failed for g in got)


def test_whole_table(spark):
    d = spark.read.parquet(f"{SF01}/documents.parquet")
    got = rules.quality_rules(d).collect()
    check([(r.doc_id, r.text) for r in d.collect()], got)
    # clean documents stay wherever they come from
    assert all(g.kept for g in got if g.n_failed == 0)


def test_odd_rows(spark):
    d = spark.createDataFrame(ODD, DOCS)
    check([(r[0], r[1]) for r in ODD], rules.quality_rules(with_clashes(d)).collect())
    assert rules.quality_rules(d.limit(0)).count() == 0


def test_repeats_by_hand(spark):
    rows = [(1, "a b c a b c"), (2, "a a a a a"), (3, "a b c d a b c e"), (4, "x\n\nx\n \ny\nx"), (5, "a b"), (6, "a b c")]
    d = spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id long, text string, source string")
    got = rules.quality_rules(d).collect()
    check(rows, got)
    assert {g.doc_id: g.n_repeat_words for g in got} == {1: 6, 2: 5, 3: 6, 4: 0, 5: 0, 6: 0}


def test_hosts_are_shrunk_and_bad_ones_judged_harder(spark):
    rows = []
    for host, bad in (("good", 5), ("poor", 95), ("tiny", 100)):
        for i in range(2 if host == "tiny" else 100):
            words = [f"{host}w{i}x{j}" for j in range(60)]
            if i < bad:
                words[:12] = ["#####"] * 3 + [f"#{j}" for j in range(9)]
            rows.append((len(rows), " ".join(words), host))
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = rules.quality_rules(d).collect()
    by = {h: [g for g, r in zip(sorted(got, key=lambda g: g.doc_id), rows) if r[2] == h] for h in ("good", "poor", "tiny")}
    assert by["good"][0].host_rate == pytest.approx(0.05, abs=0.03) and not by["good"][0].host_bad
    assert by["poor"][0].host_bad and 0.5 < by["tiny"][0].host_rate < 1      # drawn towards the others
    assert all(g.kept for g in by["good"])                    # one failed rule is tolerated there
    assert [g.kept for g in by["poor"]] == [g.n_failed == 0 for g in by["poor"]]


def test_no_python_in_the_plan(spark):
    d = spark.read.parquet(f"{SF01}/documents.parquet")
    for q in (rules.measures(d), rules.quality_rules(d)):
        plan = q._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
