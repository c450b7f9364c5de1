"""Unit-level relations: series -> unit level through dictionary joins and
name matching, attribute tables, and the per-unit profile."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinity.functions.geo import BOX_CONTIGUOUS, Box, in_box
from affinity.functions.numeric import to_double
from affinity.operators.edges import unit_score, with_coords
from affinity.operators.matching import contains_join

# Series measure codes (suffix of the series id) as used by
# the reference: 06 = labor force level, 03 = unemployment rate; period
# M13 = annual average.
MEASURE_LEVEL = "06"
MEASURE_RATE = "03"
PERIOD_ANNUAL = "M13"
AREA_TYPE_UNIT = "F"
# The five attitude shares.
SHARES = ("never", "rarely", "sometimes", "freq", "always")


def parse_coordinates(centers: DataFrame, lat: str = "lat_s", lon: str = "lon_s") -> DataFrame:
    """Text coordinates -> doubles (``NA`` and other text -> null)."""
    return centers.select("unit", to_double(lat).alias("lat"), to_double(lon).alias("lon"))


def units_in_box(coords: DataFrame, box: Box = BOX_CONTIGUOUS) -> DataFrame:
    return coords.where(in_box("lon", "lat", box)).select("unit", "lat", "lon")


def series_at(values: DataFrame, year: int, period: str, measure: str) -> DataFrame:
    """Values of one measure in one year/period (filters reach the scan)."""
    return (values.where((F.col("year") == F.lit(year)) & (F.col("period") == F.lit(period))
                         & F.col("sid").endswith(measure))
            .select("sid", "value"))


def series_titles(values: DataFrame, dictionary: DataFrame, region_names: DataFrame,
                  area_type: str = AREA_TYPE_UNIT) -> DataFrame:
    """values -> series dictionary (unit-level series only) -> region
    dictionary: ``(value, title, state)``."""
    d = dictionary.where(F.col("area_type") == F.lit(area_type)).select("sid", "title", "srd")
    v = values.join(d, "sid").select("value", "title", "srd")
    return v.join(region_names.select("srd", "state"), "srd").select("value", "title", "state")


def match_titles(titled: DataFrame, names: DataFrame, match: str = "all", small: bool = False) -> DataFrame:
    """Units whose name occurs in a series title of the same state/group.

    ``match='all'`` keeps every match, as the inner join does: one unit can
    match several titles (``Unit 1`` is inside ``Unit 12``).  ``'longest'``
    keeps, per title, only the matches with the longest name, which removes
    such prefix matches.  The ranking window is partitioned by title, a
    group holding only that title's few matches.
    """
    n = names.select("unit", "name", F.col("grp"))
    out = contains_join(titled, n, "title", "name", on=[("state", "grp")], small=small)
    if match == "all":
        return out
    if match != "longest":
        raise ValueError("match must be 'all' or 'longest'")
    keys = [c for c in titled.columns]
    best = F.max(F.length("name")).over(Window.partitionBy(*keys))
    return out.withColumn("_best", best).where(F.length("name") == F.col("_best")).drop("_best")


def level_by_unit(values: DataFrame, dictionary: DataFrame, region_names: DataFrame,
                  names: DataFrame, year: int, measure: str = MEASURE_LEVEL,
                  period: str = PERIOD_ANNUAL, alias: str = "level", match: str = "all",
                  small: bool = False) -> DataFrame:
    """Star chain: series values -> dictionary -> region -> unit names,
    ending at ``(unit, <alias>)``."""
    titled = series_titles(series_at(values, year, period, measure), dictionary, region_names)
    return match_titles(titled, names, match, small).select("unit", F.col("value").alias(alias))


def unit_profile(edges: DataFrame, coords: DataFrame, level: DataFrame, attitudes: DataFrame,
                 results: DataFrame, box: Box = BOX_CONTIGUOUS, means: DataFrame | None = None) -> DataFrame:
    """Per unit: mean score, coordinates (inside the box), level, result
    share and the five attitude shares.  All inner joins on ``unit``.
    ``means`` are the unit means (unit, avg), if they are at hand already."""
    means = means if means is not None else unit_score(edges, "avg", alias="avg")
    avg = with_coords(means, coords, "avg", box)
    prof = (avg.join(level, "unit")
            .join(attitudes.select("unit", *SHARES), "unit")
            .join(results.select("unit", "result"), "unit"))
    return prof.select("unit", "lon", "lat", "avg", "level", "result", *SHARES)


def attitude_class(profile: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Label 0.0 ('low compliance') when never+rarely+sometimes > threshold,
    else 1.0; the five shares are dropped."""
    low = F.col("never") + F.col("rarely") + F.col("sometimes") > F.lit(threshold)
    return (profile.withColumn("attitude_class", F.when(low, F.lit(0.0)).otherwise(F.lit(1.0)))
            .drop(*SHARES))


def connectivity_class(profile: DataFrame, threshold=15000.0) -> DataFrame:
    """Label 0.0 ('weak') when the mean score is below ``threshold`` (a
    number or a scalar Column), else 1.0; ``avg`` is dropped."""
    thr = threshold if not isinstance(threshold, (int, float)) else F.lit(float(threshold))
    weak = F.col("avg") < thr
    return (profile.withColumn("conn_class", F.when(weak, F.lit(0.0)).otherwise(F.lit(1.0)))
            .drop("avg"))
