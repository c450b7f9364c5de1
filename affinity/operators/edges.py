"""Edge-table operators.

An edge table is ``(u1, u2, w)``: directed unit pairs with an integer
connectivity score.  It is the only large relation; everything attached to
it is unit-sized.  Operators here never shuffle edges for attributes, and
group them by ``u1`` at most once per query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinity.functions.geo import BOX_CONTIGUOUS, Box, in_box
from affinity.operators.sizing import maybe_broadcast

SCORE_SCALE = 1_000_000_000

# Groups with more distinct units than this are split across tasks in the
# pair self-join (a plain group emits at most HOT_GROUP_UNITS^2 / 2 = 2e6
# pairs from one task); a split group emits about HOT_BUCKET_UNITS^2 per task.
HOT_GROUP_UNITS = 2_000
HOT_BUCKET_UNITS = 1_000


def distinct_links(incidence: DataFrame, group_col: str, unit_col: str) -> DataFrame:
    """Distinct ``(g, u)`` of incidence rows with both ends."""
    return (incidence
            .select(F.col(group_col).alias("g"), F.col(unit_col).alias("u"))
            .where(F.col("g").isNotNull() & F.col("u").isNotNull())
            .distinct())


def connectivity_index(incidence: DataFrame, group_col: str, unit_col: str,
                       scale: float = SCORE_SCALE, include_self: bool = True,
                       hot_group_units: int = HOT_GROUP_UNITS,
                       hot_bucket_units: int = HOT_BUCKET_UNITS, small_units: bool = False) -> DataFrame:
    """Connectivity index from raw links.

    ``incidence`` holds (group, unit) rows, e.g. (order, supplier): a unit
    "uses" a group.  ``n_i`` = distinct groups of unit i, ``c_ij`` = groups
    shared by i and j, and ``w_ij = floor(scale * c_ij / (n_i * n_j))``.
    With ``include_self`` the diagonal (``c_ii = n_i``) is kept, as in a
    complete published index; :func:`drop_self_pairs` removes it.
    """
    return both_directions(half_index(incidence, group_col, unit_col, scale, include_self,
                                      hot_group_units, hot_bucket_units, small_units))


def half_index(incidence: DataFrame, group_col: str, unit_col: str,
               scale: float = SCORE_SCALE, include_self: bool = True,
               hot_group_units: int = HOT_GROUP_UNITS,
               hot_bucket_units: int = HOT_BUCKET_UNITS, small_units: bool = False) -> DataFrame:
    """The rows of :func:`connectivity_index` with u1 <= u2; the index is
    symmetric, so :func:`both_directions` gives the rest without a shuffle.

    Plan: links are dealt by group once; a group's distinct units become one
    sorted array, and these arrays are dealt once more, so that making links
    distinct is not repeated by their two readers.  From them come the unit
    degrees and, by exploding an array against its own rest, each pair once
    (u1 < u2), without a join of the links with themselves.  Pair counts are
    combined map-side, keyed by the pair alone; degrees are attached to the
    counted pairs.  The diagonal comes from the degrees.  ``small_units``
    says that the degrees fit a broadcast (see
    :mod:`affinity.operators.sizing`).

    Hot groups: a group with m units yields m^2 / 2 pairs, and its units
    would be one row.  Groups with more than ``hot_group_units`` incidence
    rows are therefore kept out of the arrays and split: both sides are hashed
    into S = ceil(m / hot_bucket_units) buckets by unit, each row is
    replicated across the other side's buckets, and the join key becomes
    (group, bucket1, bucket2).  Every pair is still produced exactly once,
    by one of S^2 tasks.  m counts distinct links, so S follows the pairs.
    """
    links = incidence.select(F.col(group_col).alias("g"), F.col(unit_col).alias("u")).where(
        F.col("g").isNotNull() & F.col("u").isNotNull())
    # rows are no fewer than distinct units, so no array exceeds the bound.
    # Dealt by both columns the hot list is a stage of its own: AQE then sees
    # its true size, and an empty list drops the joins and the split branch.
    hot = (links.groupBy("g").agg(F.count(F.lit(1)).alias("rows"))
           .where(F.col("rows") > F.lit(hot_group_units)).repartition("g", "rows").select("g"))
    dealt = links.repartition("g")

    # ordinary groups: an array of units each, at most hot_group_units long
    # (dealt anew by a hash of g, as by g they lie already), in a fixed number
    # of partitions: AQE merges small ones by bytes, but arrays grow to pairs,
    # and a task's map-side counts have to fit its memory
    n = int(incidence.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sets = (dealt.join(hot, "g", "left_anti").groupBy("g").agg(F.sort_array(F.collect_set("u")).alias("us"))
            .repartition(n, F.xxhash64("g")).select("us"))
    pairs = (sets.select("us", F.posexplode("us").alias("i", "u1"))
             .select("u1", F.explode(F.slice("us", F.col("i") + 2, F.size("us"))).alias("u2")))

    # hot groups: (group, bucket1, bucket2) cells, each pair in exactly one
    many = dealt.join(hot, "g", "left_semi").distinct()
    cells = many.groupBy("g").agg(F.ceil(F.count(F.lit(1)) / F.lit(hot_bucket_units)).cast("int").alias("s"))
    split = many.join(cells, "g")
    every = F.explode(F.sequence(F.lit(0), F.col("s") - 1))
    bucket = F.pmod(F.xxhash64("u"), F.col("s")).cast("int")
    left = split.select("g", F.col("u").alias("u1"), bucket.alias("b1"), every.alias("b2"))
    right = split.select("g", F.col("u").alias("u2"), every.alias("b1"), bucket.alias("b2"))
    hot_pairs = left.join(right, ["g", "b1", "b2"]).where(F.col("u1") < F.col("u2"))

    # units are few beside pairs: fewer, larger maps leave fewer partial counts
    degree = (sets.coalesce(-(-n // 8)).select(F.explode("us").alias("u")).unionByName(many.select("u"))
              .groupBy("u").agg(F.count(F.lit(1)).alias("n")))
    counted = (pairs.unionByName(hot_pairs.select("u1", "u2"))
               .groupBy("u1", "u2").agg(F.count(F.lit(1)).alias("c")))
    # in double: n1 * n2 may exceed 64 bits for very hot units; below 2^53
    # it equals the exact product
    def score(c, n1, n2):
        return F.floor(F.lit(float(scale)) * F.col(c)
                       / (F.col(n1).cast("double") * F.col(n2).cast("double"))).cast("bigint").alias("w")
    for end, n in (("u1", "n1"), ("u2", "n2")):
        of_end = degree.select(F.col("u").alias(end), F.col("n").alias(n))
        counted = counted.join(maybe_broadcast(of_end, small_units), end)
    edges = counted.select("u1", "u2", score("c", "n1", "n2"))
    if not include_self:
        return edges
    return edges.unionByName(degree.select(F.col("u").alias("u1"), F.col("u").alias("u2"), score("n", "n", "n")))


def both_directions(pairs: DataFrame, u1: str = "u1", u2: str = "u2") -> DataFrame:
    """Rows of pairs in one direction, each in both; self pairs stay single."""
    there = F.struct(F.col(u1), F.col(u2))
    back = F.struct(F.col(u2).alias(u1), F.col(u1).alias(u2))
    ends = F.when(F.col(u1) == F.col(u2), F.array(there)).otherwise(F.array(there, back))
    return pairs.select(F.inline(ends), *[F.col(c) for c in pairs.columns if c not in (u1, u2)])


def drop_self_pairs(edges: DataFrame, u1: str = "u1", u2: str = "u2") -> DataFrame:
    """Remove self pairs (``u1 != u2``; pairs with a null end drop too)."""
    return edges.where(F.col(u1) != F.col(u2))


def unit_score(edges: DataFrame, how: str = "avg", unit: str = "u1", w: str | Column = "w",
               alias: str | None = None, more: tuple[Column, ...] = ()) -> DataFrame:
    """Per source unit: mean (``avg``) or maximum (``max``) score, and what
    ``more`` aggregates.  One partial + final aggregation; the shuffle carries
    one row per unit per map task, not the edges."""
    fn = {"avg": F.avg, "max": F.max, "min": F.min, "sum": F.sum}[how]
    return edges.groupBy(F.col(unit).alias("unit")).agg(fn(w).alias(alias or f"{how}_score"), *more)


def unit_sums(edges: DataFrame) -> DataFrame:
    """(unit, total, n): per source unit, the sum of its scores (in double, as
    a mean adds them up) and their number.  Unit means and the mean over all
    edges both follow from it, so the edges are read once for the two."""
    return unit_score(edges, "sum", w=F.col("w").cast("double"), alias="total", more=(F.count("w").alias("n"),))


def unit_means(sums: DataFrame, alias: str = "avg_score") -> DataFrame:
    """Mean score per unit, from :func:`unit_sums`."""
    return sums.select("unit", F.try_divide("total", "n").alias(alias))


def mean_score(sums: DataFrame) -> DataFrame:
    """One row: the mean score of all edges, from :func:`unit_sums`."""
    return sums.agg(F.try_divide(F.sum("total"), F.sum("n")).alias("mean"))


def score_with_coords(edges: DataFrame, coords: DataFrame, how: str = "avg",
                      box: Box | None = BOX_CONTIGUOUS, alias: str | None = None) -> DataFrame:
    """Map data: per source unit, its mean / max score and coordinates,
    keeping units inside ``box``.  The box filter is on the coordinate side
    only, so Catalyst applies it before the join."""
    col = alias or f"{how}_score"
    return with_coords(unit_score(edges, how=how, alias=col), coords, col, box)


def with_coords(stats: DataFrame, coords: DataFrame, col: str, box: Box | None = BOX_CONTIGUOUS) -> DataFrame:
    """Unit scores (unit, ``col``) with coordinates, inside ``box``."""
    c = coords.select("unit", "lon", "lat")
    if box is not None:
        c = c.where(in_box("lon", "lat", box))
    return stats.join(c, "unit").select("unit", "lon", "lat", col)


def one_unit_fanout(edges: DataFrame, coords: DataFrame, unit, box: Box | None = BOX_CONTIGUOUS
                    ) -> DataFrame:
    """All partners of one unit with their coordinates and the pair score."""
    if unit is None:
        raise ValueError("one_unit_fanout needs a unit (params.fanout_unit)")
    e = edges.where(F.col("u1") == F.lit(unit)).select("u2", "w")
    c = coords.select(F.col("unit").alias("u2"), "lon", "lat")
    if box is not None:
        c = c.where(in_box("lon", "lat", box))
    return e.join(c, "u2").select("u2", "lon", "lat", "w")


def attach_endpoint(edges: DataFrame, units: DataFrame, end: str, suffix: str,
                    key: str = "unit", cols: list[str] | None = None, small: bool = False) -> DataFrame:
    """Attach a unit table to one endpoint of each edge (inner join),
    renaming its attribute columns with ``suffix``.

    With ``small`` (the caller has checked the size of the unit source, see
    :mod:`affinity.operators.sizing`) the unit side is broadcast, so the edge
    table is joined where it lies and never shuffled for attributes.
    Otherwise the planner and AQE choose the join.
    """
    cols = cols if cols is not None else [c for c in units.columns if c != key]
    u = units.select(F.col(key).alias(end), *[F.col(c).alias(f"{c}{suffix}") for c in cols])
    return edges.join(maybe_broadcast(u, small), end)


def attach_both_endpoints(edges: DataFrame, units: DataFrame, key: str = "unit",
                          cols: list[str] | None = None, small: bool = False) -> DataFrame:
    """Same unit table on both endpoints: columns ``<c>1`` and ``<c>2``."""
    cols = cols if cols is not None else [c for c in units.columns if c != key]
    once = attach_endpoint(edges, units, "u1", "1", key, cols, small)
    return attach_endpoint(once, units, "u2", "2", key, cols, small)


def same_group_pairs(edges: DataFrame, groups: DataFrame, group_col: str = "grp", small: bool = False) -> DataFrame:
    """Edges whose two endpoints are in the same group."""
    g = attach_both_endpoints(edges, groups.select("unit", group_col), cols=[group_col], small=small)
    return g.where(F.col(f"{group_col}1") == F.col(f"{group_col}2")).select("u1", "u2", "w")


def same_prefix(u1: str | Column, u2: str | Column, n: int = 2) -> Column:
    """Group equality for text ids whose first ``n`` characters name the
    group (FIPS: state = first two digits)."""
    a = F.col(u1) if isinstance(u1, str) else u1
    b = F.col(u2) if isinstance(u2, str) else u2
    return F.substring(a, 1, n) == F.substring(b, 1, n)


def same_prefix_pairs(edges: DataFrame, n: int = 2) -> DataFrame:
    """Edges whose two ids begin with the same ``n`` characters.  No join, so
    no unit is lost for want of a group row."""
    return edges.where(same_prefix(F.col("u1").cast("string"), F.col("u2").cast("string"), n)).select("u1", "u2", "w")


def border_effect(edges: DataFrame, groups: DataFrame, group_col: str = "grp", small: bool = False) -> DataFrame:
    """Per source unit: mean score to partners in its own group vs. in other
    groups, with pair counts and their ratio.  One aggregation over edges
    with conditional aggregates (no second pass)."""
    g = attach_both_endpoints(edges, groups.select("unit", group_col), cols=[group_col], small=small)
    same = F.col(f"{group_col}1") == F.col(f"{group_col}2")
    out = g.groupBy(F.col("u1").alias("unit")).agg(
        F.avg(F.when(same, F.col("w"))).alias("avg_same"),
        F.avg(F.when(~same, F.col("w"))).alias("avg_cross"),
        F.count_if(same).alias("n_same"),
        F.count_if(~same).alias("n_cross"),
    )
    return out.withColumn("ratio", F.try_divide(F.col("avg_same"), F.col("avg_cross")))


def border_effect_overall(edges: DataFrame, groups: DataFrame, group_col: str = "grp", small: bool = False) -> DataFrame:
    """Whole-table version of :func:`border_effect` (one row)."""
    g = attach_both_endpoints(edges, groups.select("unit", group_col), cols=[group_col], small=small)
    same = F.col(f"{group_col}1") == F.col(f"{group_col}2")
    out = g.agg(
        F.avg(F.when(same, F.col("w"))).alias("avg_same"),
        F.avg(F.when(~same, F.col("w"))).alias("avg_cross"),
        F.count_if(same).alias("n_same"),
        F.count_if(~same).alias("n_cross"),
    )
    return out.withColumn("ratio", F.try_divide(F.col("avg_same"), F.col("avg_cross")))
