"""Geographic expressions: great-circle distance and the bounding-box test."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference for equal results:
# Earth radius in kilometres used by its distance formula.
EARTH_RADIUS_KM = 6378.8
# Degrees per radian, written as the reference divides (x / (180 / pi)).
DEG_PER_RAD = 180.0 / math.pi


@dataclass(frozen=True)
class Box:
    """Open box: lon_min < lon < lon_max and lat_min < lat < lat_max."""

    lon_min: float
    lon_max: float
    lat_min: float
    lat_max: float


# The reference's contiguous-US box (strict on all sides).
BOX_CONTIGUOUS = Box(lon_min=-130.0, lon_max=-60.0, lat_min=20.0, lat_max=50.0)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def in_box(lon, lat, box: Box = BOX_CONTIGUOUS) -> Column:
    """Strict real-valued box test; a null coordinate fails it."""
    lon, lat = _c(lon), _c(lat)
    return ((lon < F.lit(box.lon_max)) & (lon > F.lit(box.lon_min))
            & (lat > F.lit(box.lat_min)) & (lat < F.lit(box.lat_max)))


def great_circle_km(lat1, lon1, lat2, lon2, radius_km: float = EARTH_RADIUS_KM) -> Column:
    """Spherical law of cosines: acos(sin p1 sin p2 + cos p1 cos p2 cos dl) * R.

    The acos argument is clamped to [-1, 1]: rounding can push it a hair
    past 1 for identical or very close points, where acos gives NaN.
    """
    k = F.lit(DEG_PER_RAD)
    p1, p2 = _c(lat1) / k, _c(lat2) / k
    l1, l2 = _c(lon1) / k, _c(lon2) / k
    arg = F.sin(p1) * F.sin(p2) + F.cos(p1) * F.cos(p2) * F.cos(l2 - l1)
    arg = F.least(F.lit(1.0), F.greatest(F.lit(-1.0), arg))
    return F.acos(arg) * F.lit(radius_km)
