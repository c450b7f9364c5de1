"""Pair-level analyses: distances, attribute gaps, the regression feature
table and gap correlations.

All of them use the *wide unit* form: attribute tables are joined once into
one unit table, and that table is attached to both endpoints of each edge
(two joins against a unit-sized side).  Edges are never joined to edges.
The composite-key chain of four edge-sized relations gives the same rows
when edge pairs are unique (held against it in tests).
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinity.functions.geo import great_circle_km
from affinity.functions.numeric import safe_ln
from affinity.operators.edges import attach_both_endpoints


def pair_distance(edges: DataFrame, coords: DataFrame, small: bool = False) -> DataFrame:
    """Great-circle distance (km) per edge; pairs with a missing coordinate
    drop out (inner joins + null filter)."""
    c = coords.select("unit", "lat", "lon").where(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    p = attach_both_endpoints(edges, c, cols=["lat", "lon"], small=small)
    return p.select("u1", "u2", "w", great_circle_km("lat1", "lon1", "lat2", "lon2").alias("dist_km"))


def pair_gap(edges: DataFrame, units: DataFrame, value: str, alias: str = "gap", small: bool = False) -> DataFrame:
    """|value(u1) - value(u2)| per edge."""
    u = units.select("unit", value).where(F.col(value).isNotNull())
    p = attach_both_endpoints(edges, u, cols=[value], small=small)
    return p.select("u1", "u2", "w", F.abs(F.col(f"{value}1") - F.col(f"{value}2")).alias(alias))


def wide_units(coords: DataFrame, rate: DataFrame, results: DataFrame, attitude: DataFrame,
               attitude_expr=None) -> DataFrame:
    """One row per unit (per match, if an attribute table has several rows
    for a unit) with every attribute the pair features need."""
    att = attitude.select("unit", (attitude_expr if attitude_expr is not None
                                   else F.col("never") + F.col("rarely")).alias("att"))
    return (coords.select("unit", "lat", "lon")
            .where(F.col("lat").isNotNull() & F.col("lon").isNotNull())
            .join(rate.select("unit", "rate"), "unit")
            .join(results.select("unit", "result"), "unit")
            .join(att, "unit"))


def pair_features(edges: DataFrame, units: DataFrame, small: bool = False) -> DataFrame:
    """Regression table keyed by (u1, u2)::

        ln_w       = ln(w)             ln_km      = ln(great-circle km)
        gap_att    = |att1 - att2|     gap_result = |result1 - result2|
        gap_rate   = |rate1 - rate2|

    Pairs with w <= 0 or distance 0 have no logarithm and are dropped.
    """
    p = attach_both_endpoints(edges, units, cols=["lat", "lon", "rate", "result", "att"], small=small)
    km = great_circle_km("lat1", "lon1", "lat2", "lon2")
    out = p.select(
        "u1", "u2",
        safe_ln(F.col("w")).alias("ln_w"),
        F.abs(F.col("att1") - F.col("att2")).alias("gap_att"),
        F.abs(F.col("result1") - F.col("result2")).alias("gap_result"),
        safe_ln(km).alias("ln_km"),
        F.abs(F.col("rate1") - F.col("rate2")).alias("gap_rate"),
    )
    return out.where(F.col("ln_w").isNotNull() & F.col("ln_km").isNotNull())


def pair_chain(edges: DataFrame, coords: DataFrame, rate: DataFrame, results: DataFrame, attitude: DataFrame,
               small: bool = False, attitude_expr=None) -> DataFrame:
    """The same table as :func:`pair_features`, as a chain: one pair relation
    per attribute, lined up by three joins on ``(u1, u2)``.  The pairs of
    ``edges`` have to be unique.  If ``edges`` is a table bucketed by (u1, u2)
    and the unit tables are broadcast, no edge-sized relation is exchanged.
    Worth it where the relations come from different sources or are kept;
    else the wide form reads the edges once."""
    att = attitude.select("unit", (attitude_expr if attitude_expr is not None else F.col("never") + F.col("rarely")).alias("att"))
    chain = pair_distance(edges, coords, small=small)
    for alias, units, value in (("gap_rate", rate, "rate"), ("gap_result", results, "result"), ("gap_att", att, "att")):
        chain = chain.join(pair_gap(edges, units, value, alias, small=small).drop("w"), ["u1", "u2"])
    out = chain.select("u1", "u2", safe_ln(F.col("w")).alias("ln_w"), "gap_att", "gap_result",
                       safe_ln(F.col("dist_km")).alias("ln_km"), "gap_rate")
    return out.where(F.col("ln_w").isNotNull() & F.col("ln_km").isNotNull())


def gap_correlation(features: DataFrame, target: str = "ln_w",
                    gaps: Mapping[str, str] | None = None) -> DataFrame:
    """Pearson correlation of the target with each gap, one row."""
    gaps = gaps or {"corr_ln_km": "ln_km", "corr_gap_att": "gap_att", "corr_gap_result": "gap_result",
                    "corr_gap_rate": "gap_rate"}
    return features.agg(*[F.corr(target, c).alias(a) for a, c in gaps.items()],
                        F.count(F.lit(1)).alias("n_pairs"))


# ------------------------------- correlation without writing out the matches

# A unit that matches several titles has several rates, and a pair of such
# units has a row for each pair of rates.  Number, sum and squares of these
# rows' gaps follow from the two sorted lists of rates, so the rows themselves
# need not be made: their number grows with the square of the matches.

GAPS = {"corr_ln_km": "ln_km", "corr_gap_att": "gap_att", "corr_gap_result": "gap_result", "corr_gap_rate": "gap_rate"}
_MOMENTS = ("n", "mx", "my", "sx", "sy", "sxy")   # rows, means, and sums of products about the means


def rate_gaps(first1: np.ndarray, r1: np.ndarray, first2: np.ndarray, r2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each pair of ascending lists r1[first1[i]:first1[i + 1]] and
    r2[first2[i]:first2[i + 1]]: sum of |a - b| and of (a - b)^2 over all a of
    the one and b of the other."""
    n = len(first1) - 1
    k1, k2 = np.diff(first1), np.diff(first2)
    row1, row2 = np.repeat(np.arange(n), k1), np.repeat(np.arange(n), k2)
    if len(r1) + len(r2):
        low = np.concatenate([r1, r2]).min()
        r1, r2 = r1 - low, r2 - low
    values = np.unique(np.concatenate([r1, r2]))
    width = len(values) + 1
    # place of every a among the list of b: both ordered by (pair, value)
    at = np.searchsorted(row2 * width + np.searchsorted(values, r2), row1 * width + np.searchsorted(values, r1))
    sums = np.concatenate([[0.0], np.cumsum(r2)])
    below, sum_below, sum_all = at - first2[row1], sums[at] - sums[first2[row1]], (sums[first2[1:]] - sums[first2[:-1]])[row1]
    total = np.bincount(row1, r1 * below - sum_below + (sum_all - sum_below) - r1 * (k2[row1] - below), minlength=n)

    def spread(r, row, k):
        mean = np.bincount(row, r, minlength=n) / np.maximum(k, 1)
        return mean, np.bincount(row, (r - mean[row]) ** 2, minlength=n)
    (m1, s1), (m2, s2) = spread(r1, row1, k1), spread(r2, row2, k2)
    squares = k2 * s1 + k1 * s2 + k1 * k2 * (m1 - m2) ** 2
    one = (k1 == 1) & (k2 == 1)
    gap = np.abs(r1[first1[:-1][one]] - r2[first2[:-1][one]])
    total[one], squares[one] = gap, gap * gap
    return np.maximum(total, 0.0), squares


def _moments(weight: np.ndarray, x: np.ndarray, y: np.ndarray, yy: np.ndarray) -> tuple:
    """Moments of rows that come in runs of ``weight`` with one ``x``, whose
    ``y`` add up to ``y`` and their squares to ``yy``."""
    use = weight > 0
    w, x, y, yy = weight[use].astype(np.float64), x[use], y[use], yy[use]
    n = w.sum()
    if not n:
        return 0.0, 0.0, 0.0, 0.0, 0.0, 0.0
    x0, y0 = x[0], y[0] / w[0]             # about one value of each, so that equal values leave nothing
    dx, dy = x - x0, y - w * y0
    ax, ay = (w * dx).sum() / n, dy.sum() / n
    sx = (w * (dx - ax) ** 2).sum()
    sy = (yy - 2 * y0 * y + w * y0 * y0).sum() - n * ay * ay
    return n, x0 + ax, y0 + ay, sx, max(sy, 0.0), (dx * dy).sum() - n * ax * ay


def _batch_moments(b: pa.RecordBatch) -> list[tuple]:
    """(gap, moments) of a batch of pairs of units."""
    x = b.column("ln_w").to_numpy(zero_copy_only=False)
    rows = (b.column("m1").to_numpy(zero_copy_only=False) * b.column("m2").to_numpy(zero_copy_only=False))
    out = [("rows", float(rows.sum()), 0.0, 0.0, 0.0, 0.0, 0.0)]
    for c in ("ln_km", "gap_att", "gap_result"):
        w = np.where(b.column(c).is_valid().to_numpy(zero_copy_only=False), rows, 0)
        y = pc.fill_null(b.column(c), 0.0).to_numpy(zero_copy_only=False)
        out.append((c, *_moments(w, x, w * y, w * y * y)))
    lists = []
    for c in ("rates1", "rates2"):
        lists += [np.concatenate([[0], np.cumsum(pc.list_value_length(b.column(c)).to_numpy(zero_copy_only=False))]).astype(np.int64),
                  b.column(c).flatten().to_numpy(zero_copy_only=False)]
    out.append(("gap_rate", *_moments(np.diff(lists[0]) * np.diff(lists[2]), x, *rate_gaps(*lists))))
    return out


def unit_gap_correlation(edges: DataFrame, units: DataFrame, small: bool = False) -> DataFrame:
    """:func:`gap_correlation` of :func:`pair_features`, from one row per unit
    with the list of its rates.  Pairs of units with one row each are
    aggregated where they lie; the others go through :func:`rate_gaps`."""
    keys = ["unit", "lat", "lon", "result", "att"]
    u = units.groupBy(*keys).agg(F.count(F.lit(1)).alias("m"), F.sort_array(F.collect_list("rate")).alias("rates"))
    p = attach_both_endpoints(edges, u, cols=["lat", "lon", "result", "att", "m", "rates"], small=small)

    def features(p: DataFrame, *more: str) -> DataFrame:
        f = p.select(safe_ln(F.col("w")).alias("ln_w"), safe_ln(great_circle_km("lat1", "lon1", "lat2", "lon2")).alias("ln_km"),
                     F.abs(F.col("att1") - F.col("att2")).alias("gap_att"), F.abs(F.col("result1") - F.col("result2")).alias("gap_result"), *more)
        return f.where(F.col("ln_w").isNotNull() & F.col("ln_km").isNotNull())
    one = features(p.where((F.col("m1") == 1) & (F.col("m2") == 1)), F.abs(F.get("rates1", F.lit(0)) - F.get("rates2", F.lit(0))).alias("gap_rate"))
    zero = F.lit(0.0)

    def moments(c: str) -> Column:
        y = F.col(c)
        x = F.when(y.isNotNull(), F.col("ln_w"))
        n = F.count(y).cast("double")
        got = [n, F.avg(x), F.avg(y), F.var_pop(x) * n, F.var_pop(y) * n, F.covar_pop(x, y) * n]
        return F.struct(F.lit(c).alias("gap"), *[F.coalesce(v, zero).alias(k) for k, v in zip(_MOMENTS, got)])
    rows = F.struct(F.lit("rows").alias("gap"), F.count(F.lit(1)).cast("double").alias("n"), *[zero.alias(k) for k in _MOMENTS[1:]])
    ones = one.agg(F.array(rows, *[moments(c) for c in GAPS.values()]).alias("a")).select(F.inline("a"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [r for b in batches if b.num_rows for r in _batch_moments(b)]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*found)], names=["gap", *_MOMENTS])
    many = features(p.where((F.col("m1") != 1) | (F.col("m2") != 1)), "m1", "m2", "rates1", "rates2")
    many = many.mapInArrow(run, "gap string, " + ", ".join(f"{c} double" for c in _MOMENTS))
    return merged_correlation(ones.unionByName(many))


def merged_correlation(moments: DataFrame) -> DataFrame:
    """One row from moments of parts of the rows: the correlations and n_pairs."""
    d = moments.where((F.col("n") > 0) | (F.col("gap") == "rows"))
    low = d.groupBy("gap").agg(F.min("mx").alias("x0"), F.min("my").alias("y0"))
    dx, dy, n = F.col("mx") - F.col("x0"), F.col("my") - F.col("y0"), F.col("n")
    d = d.join(low, "gap").groupBy("gap").agg(
        F.sum("n").alias("n"), F.sum(n * dx).alias("dx"), F.sum(n * dy).alias("dy"), F.sum(F.col("sx") + n * dx * dx).alias("sx"),
        F.sum(F.col("sy") + n * dy * dy).alias("sy"), F.sum(F.col("sxy") + n * dx * dy).alias("sxy"))
    x, y = (F.col(f"s{a}") - F.try_divide(F.col(f"d{a}") * F.col(f"d{a}"), n) for a in "xy")
    both = F.col("sxy") - F.try_divide(F.col("dx") * F.col("dy"), n)
    corr = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.try_divide(both, F.sqrt(x * y))))
    d = d.select("gap", "n", F.when(n > 1, corr).alias("corr"))
    return d.agg(*[F.max(F.when(F.col("gap") == c, F.col("corr"))).alias(a) for a, c in GAPS.items()],
                 F.coalesce(F.max(F.when(F.col("gap") == "rows", n)), F.lit(0.0)).cast("bigint").alias("n_pairs"))
