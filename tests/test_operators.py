import itertools
import math
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from affinity.operators.edges import (border_effect, connectivity_index, drop_self_pairs, same_group_pairs,
                                      same_prefix, score_with_coords, unit_score)
from affinity.operators.matching import contains_join
from affinity.operators.plotdata import histogram, histogram_edges, scatter_series


def brute_index(links, scale=1e9):
    links = set(links)
    groups, units = {}, {}
    for g, u in links:
        groups.setdefault(g, set()).add(u)
        units.setdefault(u, set()).add(g)
    out = {}
    for a, b in itertools.product(units, units):
        c = len(units[a] & units[b])
        if c:
            out[(a, b)] = math.floor(scale * c / (len(units[a]) * len(units[b])))
    return out


def test_connectivity_index_matches_brute_force(spark):
    rnd = random.Random(7)
    links = [(rnd.randrange(40), rnd.randrange(12)) for _ in range(300)]
    links += links[:50]  # duplicates collapse
    df = spark.createDataFrame(links, "g long, u long")
    got = {(r.u1, r.u2): r.w for r in connectivity_index(df, "g", "u").collect()}
    assert got == brute_index(links)
    # symmetric, and the diagonal is scale / n
    assert all(got[(b, a)] == w for (a, b), w in got.items())
    no_self = drop_self_pairs(connectivity_index(df, "g", "u")).collect()
    assert all(r.u1 != r.u2 for r in no_self) and len(no_self) == len(got) - 12


def test_connectivity_index_hot_group(spark):
    # one group holding a third of the links; the result must stay exact
    links = [(0, u) for u in range(60)] + [(g, g % 60) for g in range(1, 121)]
    df = spark.createDataFrame(links, "g long, u long")
    got = {(r.u1, r.u2): r.w for r in connectivity_index(df, "g", "u").collect()}
    assert got == brute_index(links)


def test_connectivity_index_split_hot_groups(spark):
    # thresholds lowered so the hot-group path runs: groups 0 and 1 are hot
    # and are split into several buckets per side
    rnd = random.Random(9)
    links = [(0, u) for u in range(50)] + [(1, u) for u in range(10, 45)]
    links += [(g, rnd.randrange(50)) for g in range(2, 200) for _ in range(3)]
    df = spark.createDataFrame(links, "g long, u long")
    got = {(r.u1, r.u2): r.w for r in
           connectivity_index(df, "g", "u", hot_group_units=20, hot_bucket_units=7).collect()}
    assert got == brute_index(links)


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_connectivity_index_does_not_join_links_with_themselves(spark):
    """Ordinary groups: arrays of units, made distinct once for their two
    readers; the empty list of hot groups leaves no join by group."""
    rnd = random.Random(3)
    links = [(rnd.randrange(60), rnd.randrange(15)) for _ in range(400)]
    df = spark.createDataFrame(links * 2 + [(None, 1), (5, None)], "g long, u long").repartition(3)
    out = connectivity_index(df, "g", "u")
    assert {(r.u1, r.u2): r.w for r in out.collect()} == brute_index(links)
    assert not re.search(r"Join \[g#", _final_plan(out))
    assert "ReusedExchange" in _final_plan(out)


def test_connectivity_index_hot_groups_with_repeated_rows(spark):
    """A group is kept out of the arrays for its rows, and split by its
    distinct units: one that repeats few units, one that holds many."""
    links = [(0, u) for u in range(50)] + [(1, u % 3) for u in range(60)] + [(g, g % 50) for g in range(2, 90)]
    links += [(g, (g * 7) % 50) for g in range(2, 90)]
    df = spark.createDataFrame(links + links[:70] + [(0, None), (None, 3)], "g long, u long")
    out = connectivity_index(df, "g", "u", hot_group_units=20, hot_bucket_units=7)
    rows = [tuple(r) for r in out.collect()]
    assert len(rows) == len(set(rows)) and {(a, b): w for a, b, w in rows} == brute_index(links)


def test_unit_score_and_coords(spark):
    e = spark.createDataFrame([(1, 2, 10), (1, 3, 30), (2, 1, 5)], "u1 long, u2 long, w long")
    c = spark.createDataFrame([(1, 30.0, -90.0), (2, 55.0, -90.0), (3, 30.0, -90.0)], "unit long, lat double, lon double")
    assert {r.unit: r.avg_score for r in unit_score(e, "avg").collect()} == {1: 20.0, 2: 5.0}
    assert {r.unit: r.max_score for r in unit_score(e, "max").collect()} == {1: 30, 2: 5}
    assert [tuple(r) for r in score_with_coords(e, c, "avg").collect()] == [(1, -90.0, 30.0, 20.0)]


def test_groups_and_border_effect(spark):
    e = spark.createDataFrame([(1, 2, 10), (1, 3, 30), (2, 1, 6), (3, 1, 2), (2, 3, 8)], "u1 long, u2 long, w long")
    g = spark.createDataFrame([(1, "A"), (2, "A"), (3, "B")], "unit long, grp string")
    assert sorted(tuple(r) for r in same_group_pairs(e, g).collect()) == [(1, 2, 10), (2, 1, 6)]
    be = {r.unit: r for r in border_effect(e, g).collect()}
    assert be[1].avg_same == 10.0 and be[1].avg_cross == 30.0 and be[1].n_same == 1 and be[1].n_cross == 1
    assert be[3].avg_same is None and be[3].n_cross == 1
    s = spark.createDataFrame([("01001", "01003"), ("01001", "02001")], "a string, b string")
    assert [r[0] for r in s.select(same_prefix("a", "b")).collect()] == [True, False]
    from affinity.operators.edges import same_prefix_pairs
    e = spark.createDataFrame([("02013", "02020", 5), ("02013", "01001", 6)], "u1 string, u2 string, w long")
    assert [tuple(r) for r in same_prefix_pairs(e).collect()] == [("02013", "02020", 5)]


@settings(max_examples=15, deadline=None)
@given(texts=st.lists(st.tuples(st.sampled_from(["A", "B"]), st.text(alphabet="ab1 ", max_size=8)), max_size=8),
       pats=st.lists(st.tuples(st.sampled_from(["A", "B", "C"]), st.text(alphabet="ab1 ", max_size=4)), max_size=6))
def test_contains_join_equals_nested_loop(spark, texts, pats):
    t = spark.createDataFrame([(i, k, s) for i, (k, s) in enumerate(texts)], "tid int, state string, title string")
    p = spark.createDataFrame([(j, k, s) for j, (k, s) in enumerate(pats)], "pid int, grp string, name string")
    got = sorted((r.tid, r.pid) for r in contains_join(t, p, "title", "name", on=[("state", "grp")]).collect())
    want = sorted((i, j) for i, (k, s) in enumerate(texts) for j, (k2, q) in enumerate(pats) if k == k2 and q in s)
    assert got == want


def test_contains_join_without_keys_and_multimatch(spark):
    t = spark.createDataFrame([("Level: Unit 12, N1",), ("Level: Unit 1, N1",)], "title string")
    p = spark.createDataFrame([("Unit 1",), ("Unit 12",), ("Unit 3",)], "name string")
    got = sorted(tuple(r) for r in contains_join(t, p, "title", "name").select("title", "name").collect())
    assert got == [("Level: Unit 1, N1", "Unit 1"), ("Level: Unit 12, N1", "Unit 1"), ("Level: Unit 12, N1", "Unit 12")]


def test_contains_join_plan_has_no_cross_product(spark):
    t = spark.createDataFrame([("NA", "x Unit 1")], "state string, title string")
    p = spark.createDataFrame([("NA", "Unit 1")], "grp string, name string")
    plan = contains_join(t, p, "title", "name", on=[("state", "grp")])._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_histogram_edges_semantics(spark):
    vals = [0.5, 1.0, 1.5, 2.0, 2.999, 3.0, 3.5, float("nan"), None]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    h = {r.bucket: r["count"] for r in histogram(df, "x", 1.0, 3.0, 1.0).collect()}
    # [1,2) -> 1.0, 1.5 ; [2,3] -> 2.0, 2.999, 3.0 (last bucket closed); out of range ignored
    assert h == {0: 2, 1: 3}
    h2 = {r.bucket: r["count"] for r in histogram_edges(df, "x", [1.0, 2.0, 3.0]).collect()}
    assert h2 == h
    h3 = {r.bucket: r["count"] for r in histogram(df, "x", 0.0, 10.0, 2.5).collect()}
    assert h3 == {0: 4, 1: 3, 2: 0, 3: 0}  # empty buckets reported as 0


def test_histogram_step_that_does_not_divide_the_range(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 2.9, 3.0, 8.9, 9.0, 9.5, 10.0)], "x double")
    rows = [tuple(r) for r in histogram(df, "x", 0.0, 10.0, 3.0).orderBy("bucket").collect()]
    # edges 0, 3, 6, 9: the last bucket ends at 9, closed; 9.5 and 10 are beyond
    assert rows == [(0, 0.0, 3.0, 2), (1, 3.0, 6.0, 1), (2, 6.0, 9.0, 2)]
    from affinity.operators.plotdata import bucket_count
    assert bucket_count(1.0, 70_000_000.0, 1_000_000.0) == 69       # last edge 69,000,001
    assert bucket_count(0.0, 0.3, 0.1) in (2, 3) and bucket_count(0.0, 1.0, 2.0) == 0


def test_histogram_every_value_in_one_bucket(spark):
    rnd = random.Random(3)
    vals = [rnd.uniform(1000, 1_000_000) for _ in range(2000)] + [1000.0, 1_000_000.0, 2000.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    h = histogram(df, "x", 1000.0, 1_000_000.0, 1000.0)
    assert h.count() == 999 and h.agg(F.sum("count")).first()[0] == len(vals)


def test_scatter_series_long_form(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0)], "x double, a double, b double")
    got = sorted(tuple(r) for r in scatter_series(df, "x", {"obs": "a", "pred": "b"}).collect())
    assert got == [(1.0, 2.0, "obs"), (1.0, 3.0, "pred")]


def test_hot_group_split_equals_plain_path_on_real_links(spark):
    from conftest import SF01
    li = spark.read.parquet(f"{SF01}/lineitem.parquet").select(F.col("l_orderkey").alias("g"),
                                                                F.col("l_suppkey").alias("u"))
    hot = spark.read.parquet(f"{SF01}/supplier.parquet").select(F.lit(-1).cast("bigint").alias("g"),
                                                                 F.col("s_suppkey").alias("u"))
    inc = li.unionByName(hot)  # order -1 holds every supplier: 100 units, 10,000 pairs
    split = connectivity_index(inc, "g", "u", hot_group_units=50, hot_bucket_units=20)
    plain = connectivity_index(inc, "g", "u", hot_group_units=10 ** 9)
    assert split.count() == plain.count() == 10000
    assert split.exceptAll(plain).count() == 0
