from pyspark.sql import functions as F

from affinity.functions.numeric import safe_ln
from affinity.operators import pairs as P
from affinity.plans.binding import Binding
from conftest import SF01


def pair_features_chain(edges, coords, rate, results, attitude):
    """The same table as four edge-sized relations joined on (u1, u2)."""
    parts = [P.pair_distance(edges, coords).select("u1", "u2", safe_ln("w").alias("ln_w"), safe_ln("dist_km").alias("ln_km"))]
    att = attitude.select("unit", (F.col("never") + F.col("rarely")).alias("att"))
    for units, value in ((rate, "rate"), (results, "result"), (att, "att")):
        parts.append(P.pair_gap(edges, units, value, f"gap_{value}").drop("w"))
    out = parts[0]
    for p in parts[1:]:
        out = out.join(p, ["u1", "u2"])
    return out.where(F.col("ln_w").isNotNull() & F.col("ln_km").isNotNull())


def test_wide_form_equals_chain_with_duplicated_units(spark):
    b = Binding(spark, SF01, keep=False)
    rate = b.rate  # title matches give some units several rates
    assert rate.groupBy("unit").count().where("count > 1").count() > 0
    wide = P.pair_features(b.edges, P.wide_units(b.coords, rate, b.results, b.attitudes))
    chain = pair_features_chain(b.edges, b.coords, rate, b.results, b.attitudes)
    cols = ["u1", "u2", "ln_w", "gap_att", "gap_result", "ln_km", "gap_rate"]
    w = wide.select(*[F.round(c, 9).alias(c) if c not in ("u1", "u2") else c for c in cols])
    c = chain.select(*[F.round(c, 9).alias(c) if c not in ("u1", "u2") else c for c in cols])
    assert w.count() == c.count()
    assert w.exceptAll(c).count() == 0 and c.exceptAll(w).count() == 0


def test_edge_pairs_are_unique(spark):
    b = Binding(spark, SF01, keep=False)
    assert b.edges.groupBy("u1", "u2").count().where("count > 1").count() == 0


def test_gap_correlation_bounds(spark):
    b = Binding(spark, SF01, keep=False)
    row = P.gap_correlation(P.pair_features(b.edges, P.wide_units(b.coords, b.rate, b.results, b.attitudes))).first()
    for v in (row.corr_ln_km, row.corr_gap_att, row.corr_gap_result, row.corr_gap_rate):
        assert -1.0 <= v <= 1.0


def test_shuffle_fallback_equals_broadcast_path(spark, monkeypatch):
    """Unit tables above the broadcast bound are joined by shuffle; the rows
    are the same, and the plan then has no broadcast of the unit side."""
    from affinity.plans import binding, catalog
    from conftest import SF001
    b = Binding(spark, SF001, keep=False)
    small = catalog.run("pair_features", b)
    assert b.small_units
    monkeypatch.setattr(binding, "is_small", lambda df: False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        big = catalog.run("pair_features", Binding(spark, SF001, keep=False))
        plan = big._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
        assert big.count() == small.count() and big.exceptAll(small).count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_contains_join_shuffle_fallback(spark):
    from affinity.operators.units import match_titles
    b = Binding(spark, SF01, keep=False)
    titled = b.dictionary.join(b.region_names, "srd").select("sid", "title", "state")
    want = match_titles(titled, b.names, small=True)
    got = match_titles(titled, b.names, small=False)
    assert got.count() == want.count() == 206 and got.exceptAll(want).count() == 0


def test_chain_of_bucketed_pair_tables_moves_no_edges(spark):
    """Three joins on (u1, u2) without an exchange of an edge-sized side, and
    the same rows as the wide form."""
    from affinity.plans.binding import Binding
    from affinity.plans.catalog import run
    from conftest import SF01
    b = Binding(spark, SF01)
    df = run("pair_chain", b)
    rows = sorted(map(tuple, df.collect()))
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "Final Plan" in text
    text = text.split("Initial Plan")[0]
    assert text.count("SortMergeJoin") + text.count("ShuffledHashJoin") == 3
    assert "Exchange hashpartitioning(u1" not in text and "Bucketed: true" in text
    assert rows == sorted(map(tuple, run("pair_features", b).collect())) and len(rows) > 5000
    table = b._pair_table
    b.release()
    assert not spark.catalog.tableExists(table)


def test_rate_gaps_equal_all_pairs_of_rates():
    import numpy as np
    rnd = np.random.default_rng(5)
    left = [np.sort(np.round(rnd.random(k), 1)) for k in (1, 3, 0, 7, 1, 2)]
    right = [np.sort(np.round(rnd.random(k), 1)) for k in (1, 4, 2, 5, 6, 0)]
    first = [np.concatenate([[0], np.cumsum([len(x) for x in side])]) for side in (left, right)]
    total, squares = P.rate_gaps(first[0], np.concatenate(left), first[1], np.concatenate(right))
    gaps = [np.abs(a[:, None] - b[None, :]) for a, b in zip(left, right)]
    assert np.allclose(total, [g.sum() for g in gaps]) and np.allclose(squares, [(g * g).sum() for g in gaps])


def test_gap_correlation_makes_no_row_for_each_pair_of_matches(spark):
    """Units with many rates (nulls among them), repeated unit rows: the same
    correlations as from the written out pairs, but no join gives more rows
    than there are pairs of distinct unit rows."""
    rates = [(1, 0.1 * i, float(i % 7)) for i in range(40)] + [(2, 0.3 * i, 2.0) for i in range(30)] + [(3, 0.5, 1.0), (3, None, 1.0), (4, 0.9, 4.0), (5, None, 3.0)]
    units = [(u, 30.0 + u, -100.0 + 2 * u * u, r, 0.1 * u, None if u == 5 else 0.02 * u * u) for u, r, _ in rates] + [(4, 34.0, -68.0, 0.9, 0.4, 0.32)]
    wide = spark.createDataFrame(units, "unit long, lat double, lon double, rate double, result double, att double")
    edges = spark.createDataFrame([(a, b, 1000 * a + 37 * b * b) for a in range(1, 6) for b in range(1, 6) if a != b], "u1 long, u2 long, w long")
    want = P.gap_correlation(P.pair_features(edges, wide)).first()
    got = P.unit_gap_correlation(edges, wide).first()
    assert got.n_pairs == want.n_pairs > 2000
    for c in P.GAPS:
        assert abs(got[c] - want[c]) < 1e-9
    empty = P.unit_gap_correlation(edges.limit(0), wide).first()
    assert empty.n_pairs == 0 and all(empty[c] is None for c in P.GAPS)


def test_gap_correlation_query_joins_one_row_a_unit(spark):
    """The query's joins get one row a unit, not one a title match."""
    from affinity.plans import catalog
    plan = catalog.run("gap_correlation", Binding(spark, SF01, keep=False))._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" in plan


def test_chain_joins_every_pair_once(spark):
    """The table of the chain holds one direction of each pair; the query's
    rows are those of the chain over both directions, matches of titles too."""
    from affinity.plans import catalog
    from conftest import SF01
    b = Binding(spark, SF01)
    got = catalog.run("pair_chain", b)
    assert b.pair_buckets.count() * 2 == b.edges.count() > 0
    f = P.pair_chain(b.edges, b.pair_coords, b.rate, b.results, b.attitudes, small=b.small_units)
    want = f.select("u1", "u2", *[catalog._r(c) for c in ("ln_w", "gap_att", "gap_result", "ln_km", "gap_rate")])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    b.release()
