"""The binding reproduces the measured facts of FIXTURES.md (sf0.01)."""

from pyspark.sql import functions as F

from affinity.plans.binding import Binding
from affinity.operators.units import units_in_box
from affinity.operators.edges import same_group_pairs
from conftest import SF01


def test_measured_facts_sf001(spark):
    b = Binding(spark, SF01, keep=False)
    e = b.edges
    stats = e.agg(F.count(F.lit(1)).alias("n"), F.min("w").alias("lo"), F.avg("w").alias("mean"),
                  F.max("w").alias("hi")).first()
    assert stats.n == 9900 and stats.lo == 28587 and stats.hi == 112157 and round(stats.mean) == 66403
    assert b.coords.where(F.col("lat").isNotNull()).count() == 96
    assert units_in_box(b.coords).count() == 83
    assert same_group_pairs(e, b.names).count() == 412
    assert b.level.count() == 103 and b.level.select("unit").distinct().count() == 100
    assert b.series.count() == 9661
    share = b.attitudes.agg(F.avg((F.col("never") + F.col("rarely") + F.col("sometimes") > 0.6)
                                  .cast("double"))).first()[0]
    assert round(share, 2) == 0.48
    # shares of one unit add to 1
    tot = b.attitudes.select((F.col("never") + F.col("rarely") + F.col("sometimes") + F.col("freq")
                              + F.col("always")).alias("t"))
    assert tot.agg(F.max(F.abs(F.col("t") - 1.0))).first()[0] < 1e-12


def test_index_is_symmetric(spark):
    b = Binding(spark, SF01, keep=False)
    e = b.edges
    mirrored = e.select(F.col("u2").alias("u1"), F.col("u1").alias("u2"), "w")
    assert e.exceptAll(mirrored).count() == 0


def test_edges_keep_half_of_the_index(spark):
    from affinity.plans.catalog import run
    from conftest import SF001
    b = Binding(spark, SF001, keep=True)
    level = run("edge_level", b)
    assert "raw_index" not in b.__dict__ and b.half_index.storageLevel.useMemory and b.half_index.storageLevel.useDisk
    assert b.half_index.where(F.col("u1") > F.col("u2")).count() == 0
    n = level.count()
    mirrored = b.edges.select(F.col("u2").alias("u1"), F.col("u1").alias("u2"), "w")
    assert b.edges.exceptAll(mirrored).count() == 0 and b.raw_index.exceptAll(b.edges).where("u1 != u2").count() == 0
    half = b.half_index
    b.release()
    assert not half.storageLevel.useMemory
    again = Binding(spark, SF001, keep=True)
    assert again.raw_index.count() > 0
    assert run("edge_level", again).count() == n and not again.half_index.storageLevel.useMemory
    again.release()


def test_durable_index_cuts_lineage(spark):
    from conftest import SF001
    cached = Binding(spark, SF001, keep=False).raw_index
    durable = Binding(spark, SF001, durable=True).raw_index
    assert cached.exceptAll(durable).count() == 0 and durable.exceptAll(cached).count() == 0
    plan = durable._jdf.queryExecution().optimizedPlan().toString()
    assert "lineitem" not in plan  # read back from the checkpoint folder, not recomputed
    # bucketed by u1: the per-unit aggregation needs no exchange of the index
    from affinity.operators.edges import unit_score
    agg_plan = unit_score(durable, "avg")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(u1" not in agg_plan


def test_longest_title_match_gives_one_level_per_unit(spark):
    from affinity.operators.units import level_by_unit
    b = Binding(spark, SF01, keep=False)
    lv = level_by_unit(b.series, b.dictionary, b.region_names, b.names, b.params.level_year, match="longest")
    assert lv.count() == 100 and lv.select("unit").distinct().count() == 100
    # and each unit got its own series: the level equals its own annual level
    own = (b.series.where((F.col("year") == b.params.level_year) & (F.col("period") == "M13") & F.col("sid").endswith("06"))
           .select(F.substring("sid", 1, 6).cast("bigint").alias("unit"), F.col("value").alias("own")))
    assert lv.join(own, "unit").where(F.col("level") != F.col("own")).count() == 0


def test_scale_sf01_edge_count(spark):
    b = Binding(spark, "/root/testdata/sf0.1", keep=False)
    assert b.edges.count() == 907176


def test_durable_mode_gives_the_same_results(spark):
    from affinity.plans import catalog
    from conftest import SF001
    cached, durable = Binding(spark, SF001, keep=True), Binding(spark, SF001, durable=True)
    for name in ("avg_connectivity_coords", "border_effect", "pair_features", "hist_weight"):
        a, b = catalog.run(name, cached), catalog.run(name, durable)
        assert a.count() == b.count() and a.exceptAll(b).count() == 0, name


def test_bucketed_index_joins_large_unit_table_without_moving_edges(spark):
    from affinity.operators import edges as E
    from conftest import SF001
    b = Binding(spark, SF001, durable=True)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        j = E.attach_endpoint(b.edges, b.coords, "u1", "1", cols=["lat"])
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan
        assert plan.count("Exchange hashpartitioning") == 1  # only the unit side moves
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_two_durable_bindings_share_one_table(spark):
    from conftest import SF001
    a, b = Binding(spark, SF001, durable=True), Binding(spark, SF001, durable=True)
    n = a.raw_index.count()
    assert b.raw_index.count() == n and a.raw_index.count() == n   # not written again under the reader
    table = a._index_table
    a.release()
    assert b.raw_index.count() == n
    b.release()
    while spark.catalog.tableExists(table):                        # users of other tests, if any
        from affinity.plans.binding import drop_bucketed
        drop_bucketed(spark, table)
    assert not spark.catalog.tableExists(table)


def test_ids_beyond_six_digits_stay_whole(spark):
    """Units 123456 and 1234567 in one group: a cut id would join them."""
    from affinity.operators.units import level_by_unit
    sid = Binding._sid
    units = [(123456, 1.0), (1234567, 2.0), (42, 3.0)]
    u = spark.createDataFrame(units, "unit long, value double")
    series = u.select(sid(F.col("unit"), "06").alias("sid"), F.lit(1998).alias("year"), F.lit("M13").alias("period"), "value")
    titles = u.select(sid(F.col("unit"), "06").alias("sid"), F.lit("F").alias("area_type"), F.lit("1").alias("srd"),
                      F.concat(F.lit("Level: Unit "), F.col("unit").cast("string"), F.lit(", A")).alias("title"))
    names = u.select("unit", F.concat(F.lit("Unit "), F.col("unit").cast("string"), F.lit(",")).alias("name"), F.lit("A").alias("grp"))
    regions = spark.createDataFrame([("1", "A")], "srd string, state string")
    got = {tuple(r) for r in level_by_unit(series, titles, regions, names, 1998).collect()}
    assert got == set(units)
    assert {r.sid for r in series.collect()} == {"12345606", "123456706", "00004206"}


def test_annual_values_equal_those_of_the_series(spark):
    from affinity.operators.units import MEASURE_LEVEL, MEASURE_RATE
    from conftest import SF001
    b = Binding(spark, SF001, keep=False)
    for m in (MEASURE_LEVEL, MEASURE_RATE):
        want = b.series.where((F.col("year") == b.params.level_year) & (F.col("period") == "M13") & F.col("sid").endswith(m))
        got = b._annual(m).select(*want.columns)
        assert got.exceptAll(want).count() == 0 and got.count() == want.count() > 0
    plan = b._annual(MEASURE_LEVEL)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_shipdate" in plan      # the year reaches the scan
