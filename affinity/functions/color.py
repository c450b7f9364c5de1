"""Colour-scale classes for map-ready outputs.

A colour scale is an ascending list of stops.  ``color_stop`` gives the
index of the stop interval a value falls in (values below the first stop
map to 0, at or above the last stop to the last index) and
``color_position`` the fractional position inside that interval, which is
what a renderer needs to blend between the stop colours.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Stop positions of the reference's three colour scales.
STOPS_MEAN = (0.0, 1000.0, 10000.0, 100000.0)
STOPS_ONE_UNIT = (1.0, 10000.0, 200000.0, 5000000.0)
STOPS_MAX = (50000.0, 1000000.0, 20000000.0, 30000000.0)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def color_stop(value, stops=STOPS_MEAN) -> Column:
    v = _c(value)
    expr = F.lit(0)
    for i, s in enumerate(stops[1:], start=1):
        expr = F.when(v >= F.lit(float(s)), F.lit(i)).otherwise(expr)
    return F.when(v.isNotNull(), expr)


def color_position(value, stops=STOPS_MEAN) -> Column:
    """Position in [0, 1] inside the stop interval; 0 below the first stop
    and 1 at or above the last one."""
    v = _c(value)
    expr = F.lit(0.0)
    for lo, hi in zip(stops[:-1], stops[1:]):
        expr = F.when(v >= F.lit(float(lo)), (v - F.lit(float(lo))) / F.lit(float(hi - lo))).otherwise(expr)
    expr = F.when(v >= F.lit(float(stops[-1])), F.lit(1.0)).otherwise(expr)
    return F.when(v.isNotNull(), expr)
